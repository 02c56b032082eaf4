"""Byte-level BPE by an automaton over tokens.

The merges are compiled one by one, in order. The automaton starts with one state that
every byte leads back to: any sequence of bytes is a path. The gadget of a merge of ``a``
and ``b`` into ``c`` forbids ``b`` behind ``a`` and offers ``c`` instead: ``a`` now leads to
a copy of its state without ``b``, each state with an arc for ``a`` gets one for ``c``, and
``c`` leads where ``b`` led. All arcs of one token lead to one state, so the result is
deterministic, and its paths are exactly the encodings: each string has one of them.

Only what a state lacks is stored. A token that was merged later starts with the one it is
made of, so it has an arc wherever that one had, and tokens numbered along this tree lie
side by side: every gadget takes one interval of numbers from a state.

A word is read byte by byte. What may be under way at a byte, places in the trie of the
tokens' bytes with the states that they started from, is a state of a second table, whose
transitions are worked out when they are met first; each one gives the last token of the
encoding so far. Going back over these from the end of the word gives its encoding.
"""

from __future__ import annotations

import json
import pickle
import re
import sys
import unicodedata
from array import array
from bisect import bisect_left, bisect_right
from collections.abc import Sequence
from functools import cache, cached_property

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql.types import ArrayType, IntegerType, LongType, StringType, StructField, StructType

from opinionlens.llm.common import add_from_text, others

# What a task remembers before it starts afresh: transitions, and words up to a length.
MOST_TRANSITIONS = 400_000
MOST_WORDS, MOST_PARTS = 100_000, 500_000
LONGEST_REMEMBERED = 64


# A space that may be inside a word of white space.
INSIDE_SPACE = re.compile(r"\s (?!\S)")
# Signs that are words of their own behind letters.
SIGNS = frozenset(",.;:!?")
# Fixed value: how byte-level BPE cuts a text into words.
WORD = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


@cache
def disputed_letters() -> frozenset[str]:
    """Characters whose class in ``WORD`` depends on the edition of Unicode.

    The pattern's library knows a late edition and Python an early one as well. What has one
    class in both has it in those between, of which the tokenizers library has one.
    """
    import regex

    early, every = unicodedata.ucd_3_2_0, "".join(map(chr, (*range(0xD800), *range(0xE000, sys.maxunicode + 1))))
    kinds = {"L": set(regex.findall(r"\p{L}", every)), "N": set(regex.findall(r"\p{N}", every)), "Z": set(regex.findall(r"\p{Z}", every))}
    return frozenset(c for c in every for k in (early.category(c)[0],) if any((k == name) != (c in own) for name, own in kinds.items()))


def byte_letters() -> list[str]:
    """The letter that stands for each byte in a byte-level vocabulary.

    Printable bytes stand for themselves, the others follow one another from U+0100 on.
    """
    plain = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    rest = iter(range(0x100, 0x200))
    return [chr(b) if b in plain else chr(next(rest)) for b in range(256)]


class Vocabulary:
    """Tokens, merges and special strings of a byte-level BPE file of the tokenizers library."""

    def __init__(self, content: str):
        file = json.loads(content)
        model, split = file["model"], file["pre_tokenizer"] or {}
        plain = (
            model["type"] == "BPE" and not any(model.get(k) for k in ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "byte_fallback", "ignore_merges"))
            and file["normalizer"] is None and split.get("type") == "ByteLevel" and split.get("use_regex", True) and not split.get("add_prefix_space")
        )
        special = file.get("added_tokens") or []
        if not plain or any(t[k] for t in special for k in ("single_word", "lstrip", "rstrip", "normalized")):
            raise ValueError("only plain byte-level BPE is supported")
        letters = byte_letters()
        byte_of = {c: i for i, c in enumerate(letters)}
        ids: dict[str, int] = model["vocab"]
        self.special = {t["content"]: t["id"] for t in special}
        self.labels: list[bytes] = [b""] * (max([*ids.values(), *self.special.values()]) + 1)
        for name, i in [*ids.items(), *self.special.items()]:
            known = all(c in byte_of for c in name)
            self.labels[i] = bytes(byte_of[c] for c in name) if known else name.encode()
        self.bytes = [ids[c] for c in letters]
        pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        self.merges = [(ids[a], ids[b], ids[a + b]) for a, b in pairs]
        age = dict.fromkeys(self.bytes, -1)
        for rank, (a, b, c) in enumerate(self.merges):
            if a not in age or b not in age or c in age:
                raise ValueError("a merge comes before its parts, or makes a token twice")
            age[c] = rank


class Automaton:
    """The compiled merges: for each token its state, and for each state the tokens it lacks."""

    def __init__(self, vocabulary: Vocabulary):
        merges = vocabulary.merges
        size = len(vocabulary.labels)
        children: dict[int, list[tuple[int, int]]] = {}
        for rank, (a, _, c) in enumerate(merges):
            children.setdefault(a, []).append((rank, c))

        # Numbers along the tree, the latest child first: those made after a rank come first.
        number, stop = np.full(size, -1, np.int32), np.zeros(size, np.int32)
        following = 0
        stack = [(t, False) for t in reversed(vocabulary.bytes)]
        while stack:
            token, done = stack.pop()
            if done:
                stop[token] = following
                continue
            number[token] = following
            following += 1
            stack.append((token, True))
            stack += [(c, False) for _, c in children.get(token, [])]
        lacking: list[tuple[int, int]] = []  # of each gadget, the interval of numbers that it takes away
        for rank, (_, b, _) in enumerate(merges):
            own = children.get(b, [])
            older = bisect_left(own, (rank, -1)) - 1
            lacking.append((int(number[b]), int(number[own[older][1]]) if older >= 0 else int(stop[b])))

        state = dict.fromkeys(vocabulary.bytes, 0)
        starts: list[list[int]] = [[]]  # of the intervals that a state lacks, which do not touch
        stops: list[list[int]] = [[]]
        users = [len(vocabulary.bytes)]
        for rank, (a, b, c) in enumerate(merges):
            if a not in state or b not in state or self._lacks(starts[state[a]], stops[state[a]], int(number[b])):
                continue  # the pair never stands side by side, so the token is never made
            before, after = state[a], state[b]
            if users[before] > 1 or a == b:
                users[before] -= 1
                starts.append(starts[before][:])
                stops.append(stops[before][:])
                users.append(1)
                state[a] = len(starts) - 1
            self._take(starts[state[a]], stops[state[a]], *lacking[rank])
            state[c] = after
            users[after] += 1
        self.number, self.state = number, np.full(size, -1, np.int32)
        self.state[list(state)] = list(state.values())
        sizes = np.array([len(x) for x in starts])
        self.first = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
        self.starts = np.fromiter((x for own in starts for x in own), np.int32, int(sizes.sum()))
        self.stops = np.fromiter((x for own in stops for x in own), np.int32, int(sizes.sum()))

    @staticmethod
    def _lacks(starts: list[int], stops: list[int], number: int) -> bool:
        i = bisect_right(starts, number) - 1
        return i >= 0 and number < stops[i]

    @staticmethod
    def _take(starts: list[int], stops: list[int], start: int, stop: int) -> None:
        """Add an interval to those that a state lacks, joined with what it touches."""
        i, j = bisect_left(stops, start), bisect_right(starts, stop)
        if i < j:
            start, stop = min(start, starts[i]), max(stop, stops[j - 1])
        starts[i:j], stops[i:j] = [start], [stop]



class Encoder:
    """Words to tokens by transitions over bytes; those of the automaton are met on demand."""

    def __init__(self, vocabulary: Vocabulary, automaton: Automaton, most_transitions: int = MOST_TRANSITIONS):
        self.most = most_transitions
        self.sizes = [len(x) for x in vocabulary.labels]
        self.number, self.first = automaton.number.tolist(), automaton.first.tolist()
        self.starts, self.stops = automaton.starts.tolist(), automaton.stops.tolist()
        self.after = automaton.state.tolist()
        self.trie: list[dict[int, int]] = [{}]
        self.ends = [-1]  # the token that ends at a node
        for token, state in enumerate(self.after):
            if state < 0:
                continue
            node = 0
            for b in vocabulary.labels[token]:
                if b not in self.trie[node]:
                    self.trie[node][b] = len(self.trie)
                    self.trie.append({})
                    self.ends.append(-1)
                node = self.trie[node][b]
            self.ends[node] = token
        # Tokens in the order of their bytes: those below a node of the trie lie side by side.
        known = sorted((t for t, state in enumerate(self.after) if state >= 0), key=vocabulary.labels.__getitem__)
        self.in_order = automaton.number[known]
        self.below = self._ranges()
        self.lacking = automaton.first, automaton.starts, automaton.stops
        self._reset()

    def _ranges(self) -> list[tuple[int, int]]:
        """For each node the range of the tokens that go on behind it."""
        below, at, stack = [(0, 0)] * len(self.trie), 0, [(0, -1)]
        while stack:
            node, begin = stack.pop()
            if begin >= 0:
                below[node] = begin, at
                continue
            at += self.ends[node] >= 0
            stack.append((node, at))
            stack += [(self.trie[node][b], -1) for b in sorted(self.trie[node], reverse=True)]
        return below

    def _reset(self) -> None:
        self.rows: dict[tuple, dict] = {}
        self.alike: dict[tuple[int, int], int] = {}
        self.first_like: dict[tuple[int, bytes], int] = {}
        self.met = 0

    def goes_on(self, state: int, token: int) -> bool:
        """Whether the state has an arc for the token."""
        number, low = self.number[token], self.first[state]
        i = bisect_right(self.starts, number, low, self.first[state + 1]) - 1
        return i < low or number >= self.stops[i]

    def _like(self, node: int, state: int) -> int:
        """A state with arcs for the same tokens behind a node, one for all such states; -1 if there are none."""
        found = self.alike.get((node, state))
        if found is None:
            (low, high), (first, starts, stops) = self.below[node], self.lacking
            numbers, own = self.in_order[low:high], slice(first[state], first[state + 1])
            i = starts[own].searchsorted(numbers, "right") - 1
            lacks = (i >= 0) & (numbers < stops[own][i]) if len(starts[own]) else np.zeros(len(numbers), bool)
            found = -1 if lacks.all() else self.first_like.setdefault((node, lacks.tobytes()), state)
            self.alike[node, state] = found
        return found

    def _row(self, under_way: tuple) -> dict:
        row = self.rows.get(under_way)
        if row is None:
            row = self.rows[under_way] = {-1: under_way}
        return row

    def _meet(self, row: dict, byte: int) -> tuple[dict, int]:
        """The transition of a row, worked out and kept."""
        going, found = [], []
        for node, state in row[-1]:
            node = self.trie[node].get(byte)
            if node is None:
                continue
            token = self.ends[node]
            if token >= 0 and self.goes_on(state, token):
                found.append(token)
            if self.trie[node] and (state := self._like(node, state)) >= 0:
                going.append((node, state))
        if len(found) != 1:
            raise ValueError("the automaton is not deterministic")
        going.append((0, self.after[found[0]]))
        if self.met >= self.most:
            self._reset()
        self.met += 1
        row[byte] = self._row(tuple(going)), found[0]
        return row[byte]

    def encode(self, word: bytes) -> array:
        row, last, sizes = self._row(((0, 0),)), [] if len(word) < 10_000 else array("I"), self.sizes
        add = last.append
        for byte in word:
            row, token = row.get(byte) or self._meet(row, byte)
            add(token)
        found, end = array("I"), len(word)
        while end:
            token = last[end - 1]
            found.append(token)
            end -= sizes[token]
        found.reverse()
        return found


class Codec:
    """Whole texts to ids and back, with what a task remembers of words."""

    def __init__(self, content: str, vocabulary: Vocabulary, automaton: Automaton, disputed: frozenset[str]):
        import regex

        self.content, self.vocabulary, self.automaton, self.disputed = content, vocabulary, automaton, disputed
        self.find = regex.compile(WORD).findall
        self.encoder = Encoder(vocabulary, automaton)
        self.known: dict[str, bytes] = {}
        self.behind_space: dict[str, bytes] = {}

    @cached_property
    def _by_library(self):
        from tokenizers import Tokenizer

        return Tokenizer.from_str(self.content).pre_tokenizer.pre_tokenize_str

    def split(self, text: str) -> list[str]:
        """The words of a text, by the library where the editions of Unicode differ."""
        if text.isascii() or self.disputed.isdisjoint(text):
            return self.find(text)
        return [text[start:end] for _, (start, end) in self._by_library(text)]

    def _word(self, word: str) -> bytes:
        found = self.encoder.encode(word.encode()).tobytes()
        if len(word) <= LONGEST_REMEMBERED:
            if len(self.known) >= MOST_WORDS:
                self.known = {}
            self.known[word] = found
        return found

    def _part(self, part: str) -> bytes:
        """The ids of a space and what follows it: a word, one and a sign behind it, or anything else."""
        if part.isalpha():
            found = self.encoder.encode(b" " + part.encode()).tobytes()
        elif part[-1:] in SIGNS and part[:-1].isalpha():
            sign = part[-1]
            found = (self.behind_space.get(part[:-1]) or self._part(part[:-1])) + (self.known.get(sign) or self._word(sign))
        else:
            known = self.known
            found = b"".join([known.get(w) or self._word(w) for w in self.find(" " + part)])
        if len(part) <= LONGEST_REMEMBERED:
            if len(self.behind_space) >= MOST_PARTS:
                self.behind_space = {}
            self.behind_space[part] = found
        return found

    def _plain(self, text: str) -> list[bytes]:
        """The ids of a text, by words or, where that is the same, by what stands between spaces.

        Words begin before every space but those with white space, or an end, on both sides.
        """
        known = self.known
        if not (text.isascii() or self.disputed.isdisjoint(text)) or INSIDE_SPACE.search(text):
            return [known.get(w) or self._word(w) for w in self.split(text)]
        first, *parts = text.split(" ")
        behind = self.behind_space
        return [*[known.get(w) or self._word(w) for w in self.find(first)], *[behind.get(p) or self._part(p) for p in parts]]

    def encode(self, text: str) -> bytes:
        """The ids as unsigned integers of four bytes, the least first."""
        parts = [text]
        for name, i in self.vocabulary.special.items():
            if name in text:
                own = np.array([i], "<u4").tobytes()
                pieces = [p.split(name) if isinstance(p, str) else [p] for p in parts]
                parts = [x for piece in pieces for k, p in enumerate(piece) for x in ([own, p] if k else [p])]
        return b"".join(x for p in parts for x in ([p] if isinstance(p, bytes) else self._plain(p)))

    @cached_property
    def _labels(self) -> pa.Array:
        """What each id spells; the last entry, nothing, is for nulls and ids outside the vocabulary."""
        return pa.array([*self.vocabulary.labels, b""], pa.large_binary())

    def decode_all(self, ids: pa.Array, ends: np.ndarray) -> list[str]:
        """The texts of lists of ids that lie one after the other, up to each of ``ends``.

        All labels are laid out side by side at once, so no id becomes an object of its own.
        Bytes that are no UTF-8 are replaced.
        """
        nothing = len(self._labels) - 1
        known = pc.and_(pc.greater_equal(ids, 0), pc.less(ids, nothing))
        spelled = self._labels.take(pc.if_else(pc.fill_null(known, False), ids, nothing))
        _, offsets, content = spelled.buffers()
        # Where the bytes of an id begin, and where those of the last one end.
        places = np.frombuffer(offsets, np.int64)[spelled.offset : spelled.offset + len(spelled) + 1] if len(spelled) else np.zeros(1, np.int64)
        stops = places[ends].tolist()
        content = memoryview(content) if content is not None else b""
        return [str(content[i:j], "utf-8", "replace") for i, j in zip([int(places[0]), *stops], stops)]

    def decode(self, ids: Sequence[int]) -> str:
        """The labels of the ids, one after the other; bytes that are no UTF-8 are replaced."""
        return self.decode_all(pa.array(ids, pa.int32()), np.array([len(ids)]))[0]


def read_vocabulary(path: str) -> str:
    with open(path, encoding="utf-8") as file:
        return file.read()


@cache
def compile_merges(content: str) -> tuple[Vocabulary, Automaton]:
    vocabulary = Vocabulary(content)
    return vocabulary, Automaton(vocabulary)


def _shipped(df: DataFrame, path: str):
    """The compiled tables, whose size the vocabulary bounds, for the tasks: what a codec is made of."""
    content = read_vocabulary(path)
    return df.sparkSession.sparkContext.broadcast({"made of": cloudpickle.dumps((content, *compile_merges(content), disputed_letters()))})


def _codec(shipped) -> Codec:
    """The codec of a Python worker, which later tasks find with all that it has met so far."""
    if "codec" not in shipped.value:
        shipped.value["codec"] = Codec(*pickle.loads(shipped.value["made of"]))
    return shipped.value["codec"]


def encode(docs: DataFrame, path: str, text: str = "text", ids: str = "ids", digest: str | None = None) -> DataFrame:
    """``docs`` with the array column ``ids`` of each whole text, and if named its ``digest``.

    The ids are those of the tokenizers library for the file at ``path`` without tokens at
    the ends; special strings in a text become their own ids. The digest is the SHA-256 of
    the ids as little-endian unsigned 32-bit integers. A null or empty text has no ids.
    Rows, repeats included, are encoded one by one; keys do not matter. Columns called like
    the new ones are replaced.
    """
    shipped = _shipped(docs, path)

    def factory():
        import hashlib

        codec = _codec(shipped)

        def compute(column: pa.Array) -> Sequence[pa.Array]:
            found = [codec.encode(t) if t else b"" for t in column.to_pylist()]
            offsets = np.concatenate([[0], np.cumsum([len(x) // 4 for x in found])]).astype(np.int32)
            values = pa.array(np.frombuffer(b"".join(found), "<u4").astype(np.int32))
            own = pa.ListArray.from_arrays(pa.array(offsets), values)
            return [own, pa.array([hashlib.sha256(x).hexdigest() for x in found])] if digest else [own]

        return compute

    fields = [StructField(ids, ArrayType(IntegerType()))]
    return add_from_text(docs, fields + ([StructField(digest, StringType())] if digest else []), factory, text)


def decode(df: DataFrame, path: str, ids: str = "ids", decoded: str = "decoded") -> DataFrame:
    """``df`` with the text that its ``ids`` spell, special strings included.

    Null ids give null, no ids the empty text; ids outside the vocabulary and nulls in an
    array spell nothing. A column already called ``decoded`` is replaced.
    """
    shipped = _shipped(df, path)
    kept = others(df, [decoded])
    schema = StructType([*df.select(*kept).schema, StructField(decoded, StringType())])
    place, names = kept.index(ids), [*kept, decoded]

    def run(batches):
        codec = _codec(shipped)
        for batch in batches:
            column = batch.column(place)
            sizes = pc.fill_null(pc.list_value_length(column), 0).to_numpy(zero_copy_only=False)
            texts = pa.array(codec.decode_all(column.flatten(), np.cumsum(sizes)), pa.string())
            texts = pc.if_else(column.is_valid(), texts, pa.scalar(None, pa.string()))
            yield pa.RecordBatch.from_arrays([*batch.columns, texts], names=names)

    return df.select(*kept).mapInArrow(run, schema)
