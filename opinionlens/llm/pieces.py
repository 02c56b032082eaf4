"""A SentencePiece BPE model: its vocabulary, pre-tokens and merges.

White space is written as ``▁`` and one ``▁`` is put before a text. No piece of the
vocabulary holds a ``▁`` behind another character, so a text falls apart before each
run of ``▁`` and every part, a pre-token, is encoded for itself. ``PieceModel`` checks
this property and refuses a model without it.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import cached_property

import sentencepiece

SPACE = "▁"
PRE_TOKEN = re.compile(f"{SPACE}*[^{SPACE}]+|{SPACE}+")
NO_PIECE = -1


def read_model(path: str) -> bytes:
    with open(path, "rb") as file:
        return file.read()


def pre_tokens(text: str) -> list[str]:
    """The parts of a text that are encoded independently; none for an empty text."""
    return PRE_TOKEN.findall(SPACE + text.replace(" ", SPACE)) if text else []


class PieceModel:
    def __init__(self, model: bytes):
        self.library = sentencepiece.SentencePieceProcessor(model_proto=model)
        size = self.library.get_piece_size()
        self.bytes_of: dict[int, int] = {}
        self.ids: dict[str, int] = {}
        self.scores: dict[str, float] = {}
        self.unknown = self.library.unk_id()
        for i in range(size):
            piece = self.library.id_to_piece(i)
            if self.library.is_byte(i):
                self.bytes_of[i] = int(piece[3:5], 16)
            elif not (self.library.is_control(i) or self.library.is_unknown(i) or self.library.is_unused(i)):
                self.ids[piece] = i
                self.scores[piece] = self.library.get_score(i)
        if any(SPACE in piece.lstrip(SPACE) for piece in self.ids):
            raise ValueError("a piece reaches over the start of a word; pre-tokens are not independent")
        if self.library.encode("x y") == [] or self.library.encode("  x") == self.library.encode("x"):
            raise ValueError("the model drops white space, which is not supported")

    @cached_property
    def byte_ids(self) -> list[int]:
        return [i for i, _ in sorted(self.bytes_of.items(), key=lambda x: x[1])]

    @cached_property
    def contents(self) -> list[bytes]:
        """The bytes that each id stands for when it is decoded."""
        names = {i: piece.replace(SPACE, " ").encode() for piece, i in self.ids.items()}
        names |= {i: bytes([b]) for i, b in self.bytes_of.items()}
        return [names.get(i, b" \xe2\x81\x87 " if i == self.unknown else b"") for i in range(self.library.get_piece_size())]

    def merges(self, text: str) -> Iterator[tuple[float, list[str]]]:
        """The score of each byte-pair merge and the parts of ``text`` after it.

        Of all neighbours that form a piece the best one is merged, leftmost first.
        """
        parts, scores = list(text), self.scores
        while len(parts) > 1:
            best, at = None, -1
            for i in range(len(parts) - 1):
                score = scores.get(parts[i] + parts[i + 1])
                if score is not None and (best is None or score > best):
                    best, at = score, i
            if best is None:
                return
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
            yield best, parts

    def merge(self, text: str) -> list[str]:
        parts = list(text)
        for _, parts in self.merges(text):
            pass
        return parts

    def encode_pre_tokens(self, tokens: list[str]) -> list[list[int]]:
        """Ids of pre-tokens by the library, which puts the leading ``▁`` there itself."""
        encoded = self.library.encode([t[1:] for t in tokens], num_threads=1)
        lone = [self.ids[SPACE]] if SPACE in self.ids else []
        return [lone if t == SPACE else ids for t, ids in zip(tokens, encoded)]
