"""SentencePiece encoding by suffix-array matching, and decoding.

A slice of texts is cut into pre-tokens, and the text of its distinct, not yet known
pre-tokens is concatenated. All suffixes of that text are sorted by as many leading
characters as the longest piece has; a binary search for every piece of the vocabulary
gives the range of suffixes that start with it, hence all its occurrences. These edges
are sorted by position and relaxed from left to right.

For a BPE model the relaxation keeps one token per position, the last one of the
encoding that ends there: merges inside an encoding never reach over the border of two
final tokens, so the encoding of a prefix that ends between tokens is a prefix of the
encoding. An edge extends the token before it if the two, merged together, stay the two.
Each position is reached by exactly one such edge.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, StructField

from opinionlens.llm.common import add_from_text, others
from opinionlens.llm.pieces import NO_PIECE, PieceModel, pre_tokens, read_model

# Pre-tokens whose ids a task remembers, and pairs of tokens whose merge it has tried.
CACHE_SIZE = 100_000
PAIR_CACHE_SIZE = 250_000

_UNREACHED = -2
_BORDER = 0x110000  # no code point: separates the pre-tokens
_FEW = 8  # active tokens below which the relaxation goes position by position
_SLOT_BITS = 20
_MIX = np.uint64(0x9E3779B97F4A7C15)


class SuffixMatcher:
    """Occurrences of all pieces in a text, by a suffix array of bounded depth."""

    def __init__(self, model: PieceModel):
        pieces = sorted(model.ids)
        self.letters = np.array(sorted({ord(c) for piece in pieces for c in piece}))
        self.lengths = np.array([len(p) for p in pieces])
        self.depth = int(self.lengths.max())
        self.ids = np.array([model.ids[p] for p in pieces], np.int32)
        self.spelt = np.zeros((len(pieces), self.depth), np.int64)
        for row, piece in enumerate(pieces):
            self.spelt[row, : len(piece)] = np.searchsorted(self.letters, [ord(c) for c in piece]) + 1

    def occurrences(self, text: np.ndarray) -> np.ndarray:
        """The piece of each length (row, from one) at each position of ``text``, or NO_PIECE.

        ``text`` holds code points. At a position there is at most one piece of a length,
        so filling this table is the sort of the edges by position.
        """
        table = np.full((self.depth, len(text)), NO_PIECE, np.int32)
        # The letters that occur, numbered from 1; 0 is everything that no piece has.
        at = np.minimum(np.searchsorted(self.letters, text), len(self.letters) - 1)
        usable = self.letters[at] == text
        number = np.zeros(len(self.letters) + 1, np.int64)
        present = np.unique(at[usable])
        number[present + 1] = np.arange(1, len(present) + 1)
        bits = max(1, len(present).bit_length())
        per_word = 62 // bits
        words = -(-self.depth // per_word)
        codes = np.zeros(len(text) + words * per_word, np.int64)
        codes[: len(text)] = np.where(usable, number[at + 1], 0)

        def packed(word: int, letter) -> np.ndarray:
            key = letter(word * per_word)
            for i in range(word * per_word + 1, (word + 1) * per_word):
                key = key << bits | letter(i)
            return key

        keys = [packed(w, lambda i: codes[i : i + len(text)].copy()) for w in range(words)]
        order = np.argsort(keys[0])
        ranked = keys[0][order]
        if words > 1:  # suffixes that agree in the first word are sorted by the others
            same = np.concatenate([[False], ranked[1:] == ranked[:-1]])
            tied = np.flatnonzero(same | np.concatenate([same[1:], [False]]))
            group, chosen = np.cumsum(~same)[tied], order[tied]
            order[tied] = chosen[np.lexsort([k[chosen] for k in keys[:0:-1]] + [group])]

        spelt = number[self.spelt]
        inside = np.arange(self.depth) < self.lengths[:, None]
        whole = np.flatnonzero(((spelt > 0) | ~inside).all(axis=1))
        spelt, inside = spelt[whole], inside[whole]
        blank = np.zeros((len(whole), words * per_word - self.depth), np.int64)
        least = np.hstack([spelt, blank])
        most = np.hstack([np.where(inside, spelt, (1 << bits) - 1), blank + (1 << bits) - 1])
        low = np.searchsorted(ranked, packed(0, lambda i: least[:, i]), "left")
        high = np.searchsorted(ranked, packed(0, lambda i: most[:, i]), "right")
        for w in range(1, words):
            later = keys[w][order]
            first, last = packed(w, lambda i: least[:, i]), packed(w, lambda i: most[:, i])
            for p in np.flatnonzero((self.lengths[whole] > w * per_word) & (high > low)):
                part = later[low[p] : high[p]]
                low[p], high[p] = low[p] + np.searchsorted(part, [first[p], last[p] + 1])

        found = high - low
        piece = np.repeat(np.arange(len(found)), found)
        within = np.arange(len(piece)) - np.repeat(np.cumsum(found) - found, found)
        start = order[np.repeat(low, found) + within]
        table[self.lengths[whole][piece] - 1, start] = self.ids[whole][piece]
        return table


class Encoder:
    def __init__(self, model: bytes):
        self.model = PieceModel(model)
        if len(self.model.byte_ids) != 256:
            raise ValueError("the model has no byte pieces for characters outside its vocabulary")
        self.matcher = SuffixMatcher(self.model)
        self.byte_ids = np.array(self.model.byte_ids, np.int32)
        self.piece_of = {i: p for p, i in self.model.ids.items()}
        self.size = self.model.library.get_piece_size()
        self.known: dict[str, bytes] = {}
        self.histories: dict[int, tuple[list[float], list[str], list[str]]] = {}
        self.tried: dict[int, bool] = {}
        # A direct-mapped table before that dictionary, for whole arrays of pairs.
        self.slots = np.full(1 << _SLOT_BITS, -1, np.int64)
        self.answers = np.zeros(1 << _SLOT_BITS, bool)

    def _history(self, piece: int) -> tuple[list[float], list[str], list[str]]:
        """Scores of the merges that make a piece; what stands at its left and right meanwhile."""
        if piece not in self.histories:
            text = self.piece_of[piece]
            scores, left, right = [], [text[0]], [text[-1]]
            for score, parts in self.model.merges(text):
                scores.append(score)
                left.append(parts[0])
                right.append(parts[-1])
            self.histories[piece] = [*scores, -math.inf], left, right
        return self.histories[piece]

    def _extends(self, pair: int) -> bool:
        """Whether a token goes on after another, none at a start: merged, they stay the two.

        The merges inside both are done in the order of their scores, leftmost first. The
        two stay apart if the pair over their border is never the next one to merge.
        """
        before, piece = pair // self.size - 1, pair % self.size
        scores_b, left, _ = self._history(piece)
        if left[-1] != self.piece_of[piece]:
            return False  # the piece is not what its own characters merge to
        if before == NO_PIECE:
            return True
        scores_a, _, right = self._history(before)
        find, i, j = self.model.scores.get, 0, 0
        while True:
            a, b, border = scores_a[i], scores_b[j], find(right[i] + left[j], -math.inf)
            if a >= border and a >= b and a > -math.inf:
                i += 1
            elif border >= b and border > -math.inf:
                return False
            elif b > -math.inf:
                j += 1
            else:
                return True

    def _fits(self, before: np.ndarray, pieces: np.ndarray) -> np.ndarray:
        pairs = (before.astype(np.int64) + 1) * self.size + pieces
        slot = (pairs.astype(np.uint64) * _MIX >> np.uint64(64 - _SLOT_BITS)).astype(np.int64)
        answer = self.answers[slot]
        missed = np.flatnonzero(self.slots[slot] != pairs)
        if len(missed):
            unseen, where = np.unique(pairs[missed], return_inverse=True)
            tried = self.tried
            for pair in unseen.tolist():
                if pair not in tried:
                    tried[pair] = self._extends(pair)
            answer[missed] = np.array([tried[p] for p in unseen.tolist()])[where]
            self.slots[slot[missed]], self.answers[slot[missed]] = pairs[missed], answer[missed]
        return answer

    def _learn(self, tokens: list[str]) -> None:
        """Encode pre-tokens: one suffix array for all, then relax the edges position by position."""
        tokens = sorted(tokens, key=len, reverse=True)
        sizes = np.array([len(t) for t in tokens])
        base = np.cumsum(sizes + 1) - sizes - 1
        joined = np.frombuffer("\0".join([*tokens, ""]).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
        joined[base + sizes] = _BORDER
        table = self.matcher.occurrences(joined)
        last = np.full(len(joined), _UNREACHED, np.int32)
        back = np.zeros(len(joined), np.int32)
        last[base] = NO_PIECE
        depth = self.matcher.depth
        for at in range(sizes[0]):
            active = int(np.searchsorted(-sizes, -at, "left"))  # tokens longer than ``at``
            if active <= _FEW:
                for i in range(active):
                    self._walk(table, last, back, int(base[i]) + at, int(base[i] + sizes[i]))
                break
            here = base[:active] + at
            before = last[here]
            reached = before != _UNREACHED
            here, before = here[reached], before[reached]
            lone = here[table[0, here] == NO_PIECE]
            last[lone + 1], back[lone + 1] = NO_PIECE, 1
            for length in range(1, depth + 1):
                piece = table[length - 1, here]
                edge = np.flatnonzero(piece != NO_PIECE)
                edge = edge[last[here[edge] + length] == _UNREACHED]
                edge = edge[self._fits(before[edge], piece[edge])] if len(edge) else edge
                end = here[edge] + length
                last[end], back[end] = piece[edge], length

        at, cuts = base + sizes, []
        while len(at):
            cuts.append(at)
            at = at - back[at]
            at = at[back[at] > 0]
        cuts = np.sort(np.concatenate(cuts))
        ids, character = last[cuts], joined[cuts - 1]
        outside = ids == NO_PIECE
        width = np.where(outside, 1 + (character >= 0x80) + (character >= 0x800) + (character >= 0x10000), 1)
        spelt = np.repeat(ids, width)
        first = np.cumsum(width) - width
        for k in range(4):  # the UTF-8 bytes of characters without a piece
            chosen = outside & (width > k)
            value = character[chosen] >> (6 * (width[chosen] - 1 - k))
            byte = np.array([0, 0, 0xC0, 0xE0, 0xF0])[width[chosen]] | value if k == 0 else 0x80 | value & 0x3F
            spelt[first[chosen] + k] = self.byte_ids[byte]
        content = spelt.astype(np.int32).tobytes()
        stops = np.concatenate([first, [len(spelt)]])[np.searchsorted(cuts, base + sizes) + 1]
        stops = (4 * stops).tolist()
        self.known.update(zip(tokens, map(content.__getitem__, map(slice, [0, *stops], stops))))

    def _walk(self, table: np.ndarray, last: np.ndarray, back: np.ndarray, start: int, stop: int) -> None:
        """The same relaxation for the rest of one long token, one position at a time."""
        columns, tried = table[:, start:stop].T.tolist(), self.tried
        for at in range(start, stop):
            before = int(last[at])
            if before == _UNREACHED:
                continue
            edges = columns[at - start]
            if edges[0] == NO_PIECE:
                last[at + 1], back[at + 1] = NO_PIECE, 1
            for length, piece in enumerate(edges, 1):
                if piece != NO_PIECE and last[at + length] == _UNREACHED:
                    pair = (before + 1) * self.size + piece
                    if pair not in tried:
                        tried[pair] = self._extends(pair)
                    if tried[pair]:
                        last[at + length], back[at + length] = piece, length

    def encode(self, texts: Sequence[str]) -> list[bytes]:
        """The ids of each text as the bytes of 32-bit numbers."""
        if len(self.known) > CACHE_SIZE:
            self.known.clear()
        if len(self.tried) > PAIR_CACHE_SIZE:
            self.tried.clear()
        split = [pre_tokens(t) for t in texts]
        new = {t for tokens in split for t in tokens}.difference(self.known)
        if new:
            self._learn(list(new))
        find = self.known.__getitem__
        return [b"".join(map(find, tokens)) for tokens in split]


def encode(docs: DataFrame, model_path: str, text: str = "text", ids: str = "ids") -> DataFrame:
    """``docs`` with the array column ``ids``, the pieces of each whole text.

    Equal to the library's own encoding without begin, end or added special tokens. A
    null or empty text has no ids. Repeated rows are encoded alike; a column that is
    already called ``ids`` is replaced.
    """
    shipped = docs.sparkSession.sparkContext.broadcast(read_model(model_path))

    def factory():
        encoder = Encoder(shipped.value)

        def compute(column: pa.Array) -> Sequence[pa.Array]:
            encoded = encoder.encode([t or "" for t in column.to_pylist()])
            offsets = np.concatenate([[0], np.cumsum([len(x) // 4 for x in encoded])])
            numbers = pa.array(np.frombuffer(b"".join(encoded), np.int32))
            return [pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), numbers)]

        return compute

    return add_from_text(docs, [StructField(ids, ArrayType(IntegerType()))], factory, text)


def decode(encoded: DataFrame, model_path: str, ids: str = "ids", text: str = "decoded") -> DataFrame:
    """``encoded`` with the string column ``text`` that the pieces in ``ids`` spell.

    The ``▁`` put before the text at encoding is taken off; a ``▁`` inside it becomes a
    space, as in the library. Null ids give null, an empty list an empty text. Ids outside
    the vocabulary and null elements spell nothing; a column called ``text`` is replaced.
    Native expressions: the vocabulary is one literal, looked up by position.
    """
    contents = PieceModel(read_model(model_path)).contents
    pieces = F.split(F.lit(",".join(c.hex() for c in contents)), ",", -1)
    spelt = F.array_join(F.transform(F.col(ids), lambda i: F.coalesce(F.get(pieces, i), F.lit(""))), "")
    whole = F.make_valid_utf8(F.unhex(spelt).cast("string"))
    kept = encoded.select(*others(encoded, [text]), whole.alias(text))
    return kept.withColumn(text, F.when(F.col(text).startswith(" "), F.substring(text, 2, F.length(text))).otherwise(F.col(text)))
