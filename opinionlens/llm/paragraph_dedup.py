"""Repeated paragraphs by MinHash banding, exact check and components.

Lines are paragraphs. As passages are also copied into the middle of lines, a line is
cut further: a paragraph ends with its line, or at the first end of a sentence where it
has ``MIN_WORDS`` words. A sentence that long ends a paragraph wherever the count began,
so the cuts inside a copied passage soon agree with those of its source.

Equal paragraphs are one class from the start. Classes whose shingles have equal minima
in one band are candidates, unless small maps of their shingles prove them different.
Candidates are checked by the exact Jaccard similarity of their shingles. Of a component
of classes the paragraphs in its smallest document stay, all others are removed.

Where passages are copied into lines, ends of sentences may be missing or not agree. Of
lines that stay, words are therefore also compared exactly from anchors on, which the words
themselves set. At the borders of a passage a few words remain.

Words are what white space parts: a line in a script without spaces is one word, and only
equal ones are copies of each other.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from opinionlens.llm.common import slices, small_batches, store, utf8
from opinionlens.llm.components import components

MIN_WORDS = 8
SHINGLE_WORDS = 5
SIMILARITY = 0.8
# One pair of words in so many is an anchor, at which passages that were copied into lines are compared.
ANCHOR_EVERY = 8
# At similarity 0.8 a pair escapes all bands with probability (1 - 0.8 ** 2) ** 5 = 0.006.
BANDS, ROWS = 5, 2
ENTRIES_PER_BUCKET = 1 << 17
_RNG = np.random.default_rng(21)


def _odd(n: int) -> np.ndarray:
    return _RNG.integers(0, 1 << 63, n, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


_LETTERS, _PLACES, _ORDER, _TURN = _odd(256), _odd(64), _odd(4096), _odd(BANDS * ROWS + 1)
# Only paragraphs of one kind are compared.
PIECE, LINE, COPY = 0, 1, 2
_KINDS = np.concatenate([[np.uint64(0)], _odd(2)])
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SPACE = np.isin(np.arange(256), list(b" \t\n\v\f\r"))
# Of each byte, lower-cased, in a word; white space counts nothing.
_OF_BYTE = np.where(_SPACE, np.uint64(0), _LETTERS[_LOWER])
_STOPS = np.isin(np.arange(256), list(b".!?"))


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * _TURN[-1]
    return x ^ (x >> np.uint64(29))


class Paragraphs:
    """Paragraphs of a slice of texts: byte ranges, rows, word ranges and hashes."""

    def __init__(self, content: np.ndarray, offsets: np.ndarray, whole: bool = False):
        space = _SPACE[content]
        edge = np.zeros(len(content) + 1, bool)
        edge[offsets] = True
        inside = ~space
        starts = np.flatnonzero(inside & (np.concatenate([[True], space[:-1]]) | edge[:-1])) if len(content) else np.zeros(0, np.int64)
        ends = np.flatnonzero(inside & (np.concatenate([space[1:], [True]]) | edge[1:])) + 1 if len(content) else starts
        self.starts, self.ends, n = starts, ends, len(starts)
        self.first = self.last = self.row = self.kind = self.line = np.zeros(0, np.int64)
        if not n:
            return
        row = np.searchsorted(offsets, starts, "right") - 1
        lines = np.cumsum(content == 10)
        line = lines[starts]
        line_end = np.concatenate([(line[1:] != line[:-1]) | (row[1:] != row[:-1]), [True]])
        sentence_end = np.flatnonzero(line_end | _STOPS[content[ends - 1]])
        cuts, begin = [], 0
        for at, hard in zip(sentence_end.tolist(), line_end[sentence_end].tolist()):
            if hard or at + 1 - begin >= MIN_WORDS:
                cuts.append(at + 1)
                begin = at + 1
        last = np.array(cuts)
        first = np.concatenate([[0], last[:-1]])
        long_enough = last - first >= MIN_WORDS
        self.first, self.last = first[long_enough], last[long_enough]
        self.kind = self.line = np.zeros(len(self.first), np.int64)
        if whole:
            line_last = np.flatnonzero(line_end) + 1
            line_first = np.concatenate([[0], line_last[:-1]])
            line_of = np.cumsum(line_end) - line_end
            # A short piece ends its line. With the piece before it, if there is one, it is a paragraph, too.
            tail = np.flatnonzero(~long_enough)
            tail = tail[(tail > 0) & (line_of[first[tail]] == line_of[first[tail - 1]])]
            pieces = len(self.first) + len(tail)
            self.first = np.concatenate([line_first, self.first, first[tail - 1]])
            self.last = np.concatenate([line_last, self.last, last[tail]])
            self.kind = np.repeat([LINE, PIECE], [len(line_first), pieces])
            self.line = line_first[line_of[self.first]]
            self.line_first, self.line_last = line_first[line_of], line_last[line_of]
        self.word_row, self.row = row, row[self.first]
        # Word hashes over lower-cased letters.
        place = np.arange(len(content)) - np.repeat(np.append(0, starts), np.diff(np.concatenate([[0], starts, [len(content)]])))
        value = _OF_BYTE[content] * _PLACES[place & 63]
        # Places come round again: behind the first bytes of a word each round counts on its own.
        far = np.flatnonzero(place >= 64)
        far = far[~space[far]]
        value[far] = _mix(value[far] + (place[far] >> 6).astype(np.uint64))
        self.words = _mix(np.add.reduceat(value, starts) + (ends - starts).astype(np.uint64))

    def only(self, chosen: np.ndarray) -> None:
        """Leave out all other paragraphs."""
        self.first, self.last, self.row = self.first[chosen], self.last[chosen], self.row[chosen]
        self.kind, self.line = self.kind[chosen], self.line[chosen]

    def to_copies(self) -> None:
        """Instead of paragraphs, the ``MIN_WORDS`` words from each anchor on, and those up to the next if that is farther.

        Anchors depend on two words only, so those inside a copied passage agree with its source's.
        """
        pairs = _mix(self.words[:-1] * _ORDER[0] + self.words[1:] * _ORDER[1])
        anchor = np.flatnonzero((pairs >> np.uint64(32)) % np.uint64(ANCHOR_EVERY) == 0)
        anchor = anchor[anchor + MIN_WORDS <= self.line_last[anchor]]
        far = np.flatnonzero((np.diff(anchor) > MIN_WORDS) & (self.line_last[anchor[1:]] == self.line_last[anchor[:-1]]))
        self.first = np.concatenate([anchor, anchor[far]])
        self.last = np.concatenate([anchor + MIN_WORDS, anchor[far + 1]])
        self.kind = np.full(len(self.first), COPY)
        self.line, self.row = self.line_first[self.first], self.word_row[self.first]

    def ids(self) -> np.ndarray:
        """A hash of each paragraph's words, in order, and of its kind."""
        sizes = self.last - self.first
        at = np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        word = np.repeat(self.first, sizes) + at
        weighed = _mix(self.words[word] * _ORDER[at & 4095] + (at >> 12).astype(np.uint64))
        return _mix(np.add.reduceat(weighed, np.cumsum(sizes) - sizes) + sizes.astype(np.uint64) + _KINDS[self.kind]).astype(np.int64)

    def shingles(self) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of all shingles of the paragraphs, one after the other, and where each starts."""
        n = len(self.words) - SHINGLE_WORDS + 1
        value = np.zeros(max(n, 0), np.uint64)
        for k in range(SHINGLE_WORDS if n > 0 else 0):
            value += self.words[k : k + n] * _ORDER[k]
        sizes = self.last - self.first - SHINGLE_WORDS + 1
        begin = np.cumsum(sizes) - sizes
        at = np.repeat(self.first - begin, sizes) + np.arange(sizes.sum())
        return _mix(value[at] + np.repeat(_KINDS[self.kind], sizes)), begin


def _signatures(shingles: np.ndarray, begin: np.ndarray) -> tuple[list[np.ndarray], np.ndarray, np.ndarray]:
    """The key of each band, a map of the shingles in 64 bits, and the number of distinct ones."""

    def least(k: int) -> np.ndarray:
        turned = shingles * _TURN[k]
        turned ^= turned >> np.uint64(32)
        return np.minimum.reduceat(turned * _TURN[-1], begin)

    bands = []
    for b in range(BANDS):
        key = np.full(len(begin), b, np.uint64)
        for r in range(ROWS):
            key = _mix(key * _TURN[r] + least(b * ROWS + r))
        bands.append(key)
    bits = np.bitwise_or.reduceat(np.uint64(1) << (shingles >> np.uint64(58)), begin)
    return bands, bits, _distinct(shingles, begin)


def _distinct(shingles: np.ndarray, begin: np.ndarray) -> np.ndarray:
    """The number of distinct shingles of each paragraph.

    One sort of numbers made of the paragraph and the upper part of the hash settles those
    without repeats; the others, which may repeat in that part alone, are sorted by all of it.
    """
    size = np.diff(np.append(begin, len(shingles)))
    owner = np.repeat(np.arange(len(begin)), size)
    width = np.uint64(max(len(begin) - 1, 1).bit_length())
    both = np.sort(owner.astype(np.uint64) << (np.uint64(64) - width) | shingles >> width)
    again = np.unique(both[1:][both[1:] == both[:-1]] >> (np.uint64(64) - width)).astype(np.int64)
    if len(again):
        chosen = np.isin(owner, again)
        owner, shingles = owner[chosen], shingles[chosen]
        order = np.lexsort((shingles, owner))
        owner, shingles = owner[order], shingles[order]
        first = np.concatenate([[True], (shingles[1:] != shingles[:-1]) | (owner[1:] != owner[:-1])])
        size[again] = np.bincount(owner[first], minlength=len(begin))[again]
    return size


_PLACE = "doc bigint, id bigint, start bigint, end bigint, line bigint"


def _paragraphs(docs: DataFrame, whole: bool) -> DataFrame:
    """``doc``, the class ``id``, ``start`` and ``end`` of all paragraphs.

    ``line`` is where the line of a piece starts, and -1 for a whole line.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            owners = batch.column(0).to_numpy(zero_copy_only=False)
            for low, high in slices(batch.column(1)):
                content, offsets = utf8(batch.column(1).slice(low, high - low))
                found = Paragraphs(content, offsets, whole)
                if len(found.first):
                    base = offsets[found.row]
                    line = np.where(found.kind == LINE, -1, found.starts[found.line] - base if whole else 0)
                    columns = (owners[low:high][found.row], found.ids(), found.starts[found.first] - base, found.ends[found.last - 1] - base, line)
                    yield pa.RecordBatch.from_arrays([pa.array(x) for x in columns], ["doc", "id", "start", "end", "line"])

    return docs.mapInArrow(run, _PLACE)


# What a bucket is sent of copied words: id, document, byte where they start, where their line starts, and size.
_COPY = (np.int64, np.int64, np.uint32, np.uint32, np.uint32)


def _packed(bucket: np.ndarray, parts: list[np.ndarray], kinds: tuple) -> Iterator[pa.RecordBatch]:
    """The entries of each bucket as one blob, column by column."""
    order = np.argsort(bucket, kind="stable")
    bucket, parts = bucket[order], [x[order].astype(kind) for x, kind in zip(parts, kinds)]
    borders = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1], [True]]))
    rows = [(int(bucket[i]), b"".join(x[i:j].tobytes() for x in parts)) for i, j in zip(borders[:-1], borders[1:])]
    for i in range(0, len(rows), 512):
        b, x = zip(*rows[i : i + 512])
        yield pa.RecordBatch.from_arrays([pa.array(b, pa.int64()), pa.array(x, pa.binary())], ["bucket", "blob"])


def _unpacked(blobs: list[bytes], kinds: tuple) -> list[np.ndarray]:
    parts: list[list[np.ndarray]] = [[] for _ in kinds]
    size = sum(np.dtype(kind).itemsize for kind in kinds)
    for blob in blobs:
        n, at = len(blob) // size, 0
        for store_in, kind in zip(parts, kinds):
            store_in.append(np.frombuffer(blob, kind, n, at))
            at += n * np.dtype(kind).itemsize
    return [np.concatenate(x) for x in parts]


def _copies(docs: DataFrame, bits: int) -> DataFrame:
    """The places of words at anchors that are found in several documents, like ``_paragraphs``.

    Words that several documents of a batch have are known to be copied: their places go on
    as they are, below a bucket under zero, and the bucket of their id is sent a mark of size
    0. So however common a passage is, a batch sends it to a bucket once.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            owners, parts = batch.column(0).to_numpy(zero_copy_only=False), []
            for low, high in slices(batch.column(1)):
                content, offsets = utf8(batch.column(1).slice(low, high - low))
                found = Paragraphs(content, offsets, whole=True)
                if not len(found.first):
                    continue
                found.to_copies()
                if len(found.first):
                    base, start = offsets[found.row], found.starts[found.first]
                    parts.append((found.ids(), owners[low:high][found.row], start - base, found.starts[found.line] - base, found.ends[found.last - 1] - start))
            if not parts:
                continue
            ids, doc, start, line, size = map(np.concatenate, zip(*parts))
            order = np.lexsort((doc, ids))
            ids, doc, start, line, size = (x[order] for x in (ids, doc, start, line, size))
            first = np.concatenate([[True], ids[1:] != ids[:-1]])
            group = np.cumsum(first) - 1
            begin = np.flatnonzero(first)
            several = (doc[begin] != doc[np.append(begin[1:], len(ids)) - 1])[group]
            own = ids.view(np.uint64) >> np.uint64(64 - bits)
            bucket = np.where(several, -1 - (abs(int(owners[0])) * 40503 >> 4) % (1 << bits), own.astype(np.int64))
            mark = np.flatnonzero(several & first)
            none = np.zeros(len(mark), np.int64)
            columns = [np.concatenate(x) for x in ((ids, ids[mark]), (doc, none), (start, none), (line, none), (size, none))]
            yield from _packed(np.concatenate([bucket, own[mark].astype(np.int64)]), columns, _COPY)

    def meet(table: pa.Table) -> pa.Table:
        ids, doc, start, line, size = _unpacked(table["blob"].to_pylist(), _COPY)
        if table["bucket"][0].as_py() >= 0:
            order = np.lexsort((doc, ids))
            ids, doc, start, line, size = (x[order] for x in (ids, doc, start, line, size))
            begin = np.flatnonzero(np.concatenate([[True], ids[1:] != ids[:-1]]))
            end = np.append(begin[1:], len(ids))
            several = (doc[begin] != doc[end - 1]) | np.logical_or.reduceat(size == 0, begin)
            chosen = np.flatnonzero(np.repeat(several, end - begin) & (size > 0))
            ids, doc, start, line, size = (x[chosen] for x in (ids, doc, start, line, size))
        columns = (doc, ids, start.astype(np.int64), start.astype(np.int64) + size, line.astype(np.int64))
        return pa.table([pa.array(x, pa.int64()) for x in columns], ["doc", "id", "start", "end", "line"])

    return docs.mapInArrow(run, "bucket bigint, blob binary").groupBy("bucket").applyInArrow(meet, _PLACE)


# What a bucket is sent of a class: the low half of a band's key, as the bucket tells enough
# of the other, its id, and the map and number of its shingles.
_ENTRY = (np.uint32, np.int64, np.uint64, np.uint16)
_MANY = 0xFFFF  # stands for this number of shingles or more


def _entries(docs: DataFrame, bits: int, whole: bool) -> DataFrame:
    """The bands of all classes, packed by bucket. A task sends a class once, as far as it remembers.

    Fewer words than a shingle has are one shingle, which only the same words share: such
    classes have none but themselves to meet.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros(0, np.int64)
        for batch in batches:
            packed: list[tuple[np.ndarray, ...]] = []
            for low, high in slices(batch.column(1)):
                found = Paragraphs(*utf8(batch.column(1).slice(low, high - low)), whole)
                found.only(found.last - found.first >= SHINGLE_WORDS)
                if not len(found.first):
                    continue
                ids, once = np.unique(found.ids(), return_index=True)
                once = np.sort(once[~np.isin(ids, seen)])
                if not len(once):
                    continue
                found.only(once)
                ids = found.ids()
                seen = np.concatenate([seen[-500_000:], ids])
                bands, bits_of, size = _signatures(*found.shingles())
                size = np.minimum(size, _MANY).astype(np.uint16)
                packed += [(key, ids, bits_of, size) for key in bands]
            if not packed:
                continue
            key, ids, bits_of, size = (np.concatenate(x) for x in zip(*packed))
            yield from _packed((key >> np.uint64(64 - bits)).astype(np.int64), [key, ids, bits_of, size], _ENTRY)

    return docs.mapInArrow(run, "bucket bigint, blob binary")


def _fits(bits: np.ndarray, size: np.ndarray, a: int | np.ndarray, b: slice | np.ndarray) -> np.ndarray:
    """Which of the classes ``b`` may be similar to ``a``, or each to its own, by the maps of their shingles.

    A bit that only one of two maps has is a shingle that the other class lacks. This bounds
    what they share from above, so no similar pair is turned away.
    """
    mine = size[a] - np.bitwise_count(bits[a] & ~bits[b]).astype(np.int64)
    theirs = size[b] - np.bitwise_count(bits[b] & ~bits[a]).astype(np.int64)
    fits = np.minimum(mine, theirs) * (1 + SIMILARITY) >= SIMILARITY * (size[a] + size[b]) - 1e-9
    return fits | (np.maximum(size[a], size[b]) == _MANY)


# Bands with up to this number of classes are gone through side by side.
_FEW = 12


def _one_or_more(bits: np.ndarray, size: np.ndarray, begin: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The pairs of bands where only one pair may be similar, and the bands where more may be."""
    left, right, more = [], [], [np.flatnonzero(end - begin > _FEW)]
    for n in np.unique(end - begin)[: _FEW - 1]:
        if n > _FEW:
            break
        bands = np.flatnonzero(end - begin == n)
        a, b = (begin[bands][:, None] + x for x in np.triu_indices(n, 1))
        fits = _fits(bits, size, a, b)
        found = fits.sum(axis=1)
        only = fits & (found == 1)[:, None]
        left.append(a[only])
        right.append(b[only])
        more.append(bands[found > 1])
    none = [np.zeros(0, np.int64)]
    return np.concatenate(left or none), np.concatenate(right or none), np.sort(np.concatenate(more))


_CROWD = "crowd bigint, members array<bigint>, maps binary, sizes binary"


def _candidates(entries: DataFrame) -> DataFrame:
    """Pairs ``a``, ``b`` of classes that meet in a band and may be similar, and crowds.

    Of the classes in one band only a forest of such pairs is given. If there are more, the
    classes are given once more as a crowd, from which the other pairs can be found again.
    """

    def meet(table: pa.Table) -> pa.Table:
        key, ids, bits, size = _unpacked(table["blob"].to_pylist(), _ENTRY)
        order = np.lexsort((ids, key))
        key, ids, bits, size = key[order], ids[order], bits[order], size[order]
        fresh = np.concatenate([[True], (key[1:] != key[:-1]) | (ids[1:] != ids[:-1])])
        key, ids, bits, size = key[fresh], ids[fresh], bits[fresh], size[fresh].astype(np.int64)
        borders = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1], [True]]))
        several = np.flatnonzero(np.diff(borders) > 1)
        bucket = table["bucket"][0].as_py()
        one, other, more = _one_or_more(bits, size, borders[several], borders[several + 1])
        left, right, crowds = ids[one].tolist(), ids[other].tolist(), []
        several = several[more]
        for i, j in zip(borders[several].tolist(), borders[several + 1].tolist()):
            tree, found, planted = np.arange(i, j), np.zeros(j - i, bool), 0
            total = 0
            for a in range(i, j - 1):
                b = np.flatnonzero(_fits(bits, size, a, slice(a + 1, j))) + a + 1
                if not len(b):
                    continue
                total += len(b)
                found[a - i], found[b - i] = True, True
                others, first = np.unique(tree[b - i], return_index=True)
                first, others = first[others != tree[a - i]], others[others != tree[a - i]]
                left += [int(ids[a])] * len(first)
                right += ids[b[first]].tolist()
                planted += len(first)
                tree[np.isin(tree, others)] = tree[a - i]
            if total > planted:
                at = np.flatnonzero(found) + i
                crowds.append((bucket << 32 | int(key[i]), ids[at].tolist(), bits[at].tobytes(), size[at].tobytes()))
        none = [None] * len(crowds)
        crowd, members, maps, sizes = zip(*crowds) if crowds else ((), (), (), ())
        pairs = [None] * len(left)
        return pa.table(
            {
                "a": pa.array([*left, *none], pa.int64()),
                "b": pa.array([*right, *none], pa.int64()),
                "crowd": pa.array([*pairs, *crowd], pa.int64()),
                "members": pa.array([*pairs, *members], pa.list_(pa.int64())),
                "maps": pa.array([*pairs, *maps], pa.binary()),
                "sizes": pa.array([*pairs, *sizes], pa.binary()),
            }
        )

    return entries.groupBy("bucket").applyInArrow(meet, f"a bigint, b bigint, {_CROWD}")


def _apart_still(crowds: DataFrame, roots: DataFrame) -> DataFrame:
    """``crowd``, ``id`` and ``root`` of members that may be similar to one in another component.

    These are at most the members of the crowds, however many pairs of them may be similar.
    """
    one = crowds.select("crowd", F.posexplode("members").alias("at", "id"))
    rooted = one.join(roots, one["id"] == roots["node"], "left").select("crowd", "at", F.coalesce("root", "id").alias("root"))
    known = rooted.groupBy("crowd").agg(F.array_sort(F.collect_list(F.struct("at", "root"))).alias("roots"))
    # A crowd of one component has nothing left to find.
    apart = known.filter(F.size(F.array_distinct("roots.root")) > 1).select("crowd", F.col("roots.root").alias("roots"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for crowd, ids, maps, sizes, roots in zip(*[batch.column(k).to_pylist() for k in range(5)]):
                ids, root = np.array(ids), np.array(roots)
                bits, size = np.frombuffer(maps, np.uint64), np.frombuffer(sizes, np.int64)
                open_still = np.zeros(len(ids), bool)
                for a in range(len(ids) - 1):
                    later = slice(a + 1, len(ids))
                    fits = _fits(bits, size, a, later) & (root[later] != root[a])
                    open_still[later] |= fits
                    open_still[a] |= fits.any()
                at = np.flatnonzero(open_still)
                if len(at):
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(at), crowd)), pa.array(ids[at]), pa.array(root[at])], ["crowd", "id", "root"])

    members = crowds.join(apart, "crowd").select("crowd", "members", "maps", "sizes", "roots")
    return members.mapInArrow(run, "crowd bigint, id bigint, root bigint")


def _forest(root: np.ndarray, shingles: np.ndarray, begin: np.ndarray, similarity: float) -> tuple[list[int], list[int]]:
    """Pairs of members of a crowd with at least the Jaccard similarity, enough to join their components.

    Members have sorted distinct shingles. What is similar shares one of the rarest, as many
    as the larger may lack and one more; only members that do are compared, by all shingles.
    """
    size = np.diff(np.append(begin, len(shingles)))
    owner = np.repeat(np.arange(len(begin)), size)
    _, code, times = np.unique(shingles, return_inverse=True, return_counts=True)
    rank = np.empty(len(times), np.int64)
    rank[np.argsort(times, kind="stable")] = np.arange(len(times))
    code = rank[code]
    code = code[np.lexsort((code, owner))]
    rare = size - np.ceil(similarity * size - 1e-9).astype(np.int64) + 1
    early = np.flatnonzero(np.arange(len(code)) - np.repeat(begin, size) < np.repeat(np.minimum(rare, size), size))
    early = early[np.argsort(code[early], kind="stable")]
    holders, bounds = owner[early], np.searchsorted(code[early], np.arange(len(times) + 1))
    root, shared, left, right = root.copy(), np.zeros(len(times), bool), [], []
    for a in range(len(begin) - 1):
        own = code[begin[a] : begin[a] + size[a]]
        chosen = own[: rare[a]]
        b = [holders[i:j] for i, j in zip(bounds[chosen].tolist(), bounds[chosen + 1].tolist()) if j - i > 1]
        if not b:
            continue
        b = np.unique(np.concatenate(b))
        b = b[(b > a) & (root[b] != root[a])]
        b = b[np.minimum(size[b], size[a]) >= similarity * np.maximum(size[b], size[a]) - 1e-9]
        if not len(b):
            continue
        shared[own] = True
        ends = np.cumsum(size[b])
        place = np.arange(ends[-1]) + np.repeat(begin[b] - ends + size[b], size[b])
        both = np.add.reduceat(shared[code[place]], ends - size[b], dtype=np.int64)
        shared[own] = False
        b = b[both >= similarity * (size[a] + size[b] - both) - 1e-9]
        others, first = np.unique(root[b], return_index=True)
        if len(others):
            left += [a] * len(first)
            right += b[first].tolist()
            root[np.isin(root, others)] = root[a]
    return left, right


def _left_over(members: DataFrame, paragraphs: DataFrame, docs: DataFrame, similarity: float, whole: bool) -> DataFrame:
    """Pairs ``a``, ``b`` of similar members of a crowd that join its components; fewer than its members."""

    def join(table: pa.Table) -> pa.Table:
        lists = table["shingles"].combine_chunks()
        ids, root = table["id"].to_numpy(), table["root"].to_numpy()
        begin = np.concatenate([[0], np.cumsum(lists.value_lengths().to_numpy(zero_copy_only=False))[:-1]]).astype(np.int64)
        left, right = _forest(root, lists.flatten().to_numpy(zero_copy_only=False), begin, similarity)
        return pa.table({"a": pa.array(ids[left], pa.int64()), "b": pa.array(ids[right], pa.int64())})

    contents = _contents_of(members.select("id").distinct(), paragraphs, docs, whole)
    return members.join(contents, "id").groupBy("crowd").applyInArrow(join, "a bigint, b bigint")


def _contents(rows: DataFrame, whole: bool) -> DataFrame:
    """Sorted distinct shingles of wanted paragraphs: ``doc``, ``text`` and ``ids`` to ``id``, ``shingles``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low, high in slices(batch.column(0)):
                content, offsets = utf8(batch.column(0).slice(low, high - low))
                found = Paragraphs(content, offsets, whole)
                if not len(found.first):
                    continue
                ids = found.ids()
                wanted = batch.column(1).slice(low, high - low)
                asked_in = np.repeat(np.arange(high - low), wanted.value_lengths().to_numpy(zero_copy_only=False))
                names, asked = np.unique(wanted.flatten().to_numpy(zero_copy_only=False), return_inverse=True)
                known = np.flatnonzero(np.isin(ids, names))
                own = np.searchsorted(names, ids[known]) * (high - low) + found.row[known]
                own, once = np.unique(own, return_index=True)
                once = np.sort(known[once[np.isin(own, asked * (high - low) + asked_in)]])
                if not len(once):
                    continue
                found.only(once)
                shingles, begin = found.shingles()
                lists = [np.unique(shingles[i:j]).astype(np.int64) for i, j in zip(begin, [*begin[1:], len(shingles)])]
                yield pa.RecordBatch.from_arrays([pa.array(ids[once]), pa.array(lists, pa.list_(pa.int64()))], ["id", "shingles"])

    return rows.mapInArrow(run, "id bigint, shingles array<bigint>")


def _contents_of(ends: DataFrame, paragraphs: DataFrame, docs: DataFrame, whole: bool) -> DataFrame:
    """``id`` and ``shingles`` of the classes ``ends``."""
    # The text of a class is taken from its smallest document.
    places = paragraphs.join(ends, "id", "left_semi").groupBy("id").agg(F.min("doc").alias("doc"))
    asked = places.groupBy("doc").agg(F.collect_set("id").alias("ids"))
    return store(_contents(docs.join(asked, "doc").select("text", "ids"), whole).dropDuplicates(["id"]))


def _checked(pairs: DataFrame, paragraphs: DataFrame, docs: DataFrame, similarity: float, whole: bool) -> DataFrame:
    """The pairs whose shingles have at least the Jaccard similarity."""
    ends = pairs.select(F.col("a").alias("id")).unionAll(pairs.select(F.col("b").alias("id"))).distinct()
    contents = _contents_of(ends, paragraphs, docs, whole)

    def named(side: str) -> DataFrame:
        return contents.select(F.col("id").alias(side), F.col("shingles").alias(f"of_{side}"))

    met = pairs.join(named("a"), "a").join(named("b"), "b")
    both = F.size(F.array_intersect("of_a", "of_b"))
    return met.filter(both >= similarity * (F.size("of_a") + F.size("of_b") - both) - 1e-9).select("a", "b")


def similar(paragraphs: DataFrame, entries: DataFrame, docs: DataFrame, similarity: float = SIMILARITY, whole: bool = False) -> DataFrame:
    """``node`` and ``root`` of the components of classes with at least the Jaccard similarity.

    First a forest of the candidates of each band is checked. What it leaves in different
    components is compared crowd by crowd; most of a crowd of near copies is one by then.
    """
    found = store(_candidates(entries))
    links = store(_checked(store(found.filter("a is not null").select("a", "b").distinct()), paragraphs, docs, similarity, whole))
    crowds = found.filter("crowd is not null").select(*[c.split()[0] for c in _CROWD.split(", ")])
    members = store(_apart_still(crowds, components(links)))
    return components(links.unionAll(_left_over(members, paragraphs, docs, similarity, whole)))


def _gone(places: DataFrame, roots: DataFrame) -> DataFrame:
    """``doc``, ``start``, ``end`` and ``kept_in`` of all places but those in the smallest document of a component."""
    own = places.groupBy("id").agg(F.min("doc").alias("least"), F.max("doc").alias("most"))
    # Most classes are alone and in one document.
    rooted = own.join(roots, own["id"] == roots["node"], "left").filter("root is not null or most > least")
    rooted = store(rooted.select("id", "least", "most", "root"))
    linked = rooted.filter("root is not null")
    spread = linked.groupBy("root").agg(F.min("least").alias("kept_in"), F.max("most").alias("most")).filter("most > kept_in")
    alone = rooted.filter("root is null").select("id", F.col("least").alias("kept_in"))
    verdicts = alone.unionAll(linked.join(spread.select("root", "kept_in"), "root").select("id", "kept_in"))
    return places.join(verdicts, "id").filter("doc > kept_in").select("doc", "start", "end", "kept_in").distinct()


_REMOVED = "array<struct<start:bigint,end:bigint,kept_in:bigint>>"


def _apart(removed: DataFrame) -> DataFrame:
    """The ranges of each document in order, none in another: a later one starts where the one before ends."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = []
            for ranges in batch.column(1).to_pylist():
                found: list[list[int]] = []
                for start, end, kept_in in sorted(((r["start"], r["end"], r["kept_in"]) for r in ranges), key=lambda r: (r[0], -r[1], r[2])):
                    before = found[-1] if found else [0, 0, None]
                    if end <= before[1]:
                        continue
                    if start < before[1] and kept_in == before[2]:
                        before[1] = end
                    else:
                        found.append([max(start, before[1]), end, kept_in])
                lists.append([dict(zip(("start", "end", "kept_in"), r)) for r in found])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(lists, batch.schema.field(1).type)], ["doc", "removed"])

    return removed.mapInArrow(run, f"doc bigint, removed {_REMOVED}")


def remove_paragraphs(docs: DataFrame, key: str = "doc_id", text: str = "text", whole: bool = False) -> DataFrame:
    """One row per row of ``docs``: its key, ``n_paragraphs``, ``n_removed`` and ``removed``.

    ``removed`` lists what goes, in order: ``start`` and ``end`` in UTF-8 bytes, and
    ``kept_in``, the document in which the paragraph or a similar one stays. Repeats within
    a document stay. Null texts are empty. Rows with equal keys are one document; rows with
    a null key lose nothing, take nothing from others and have no paragraphs counted.

    Without ``whole``, only pieces of lines are compared: ``n_paragraphs`` counts those of at
    least ``MIN_WORDS`` words, and shorter ones are left alone. With ``whole``, every line
    with a word is a paragraph and counted, and lines are compared with lines first. Then
    the pieces of the lines that stay are compared, also with a short end joined to the
    piece before it, and the words from each anchor on. Ranges that overlap are joined or cut.
    """
    small_batches(docs.sparkSession)
    body = docs.select(F.col(key).cast("bigint").alias("doc"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))
    known = body.filter("doc is not null")
    (total,) = known.agg(F.sum(F.octet_length("text"))).first()
    # A paragraph of about 60 bytes has one entry in each band.
    bits = max(6, ((total or 0) * BANDS // 60 // ENTRIES_PER_BUCKET).bit_length())
    paragraphs = store(_paragraphs(known, whole))
    roots = similar(paragraphs, _entries(known, bits, whole), known, whole=whole)
    if whole:
        counted = paragraphs.filter("line < 0")
        lines = store(_gone(counted, roots))
        # What a line that goes holds is neither kept there nor removed twice.
        rest = paragraphs.filter("line >= 0").unionAll(store(_copies(known, bits)))
        rest = rest.join(lines.select("doc", F.col("start").alias("line")).distinct(), ["doc", "line"], "left_anti")
        gone = lines.unionAll(_gone(rest, roots))
    else:
        counted, gone = paragraphs, _gone(paragraphs, roots)
    removed = gone.groupBy("doc").agg(F.array_sort(F.collect_list(F.struct("start", "end", "kept_in"))).alias("removed"))
    removed = _apart(removed) if whole else removed
    counts = counted.select("doc", "id", "start", "end").repartition("doc").distinct().groupBy("doc").agg(F.count("*").alias("n"))
    found = body.select("doc").join(counts, "doc", "left").join(removed, "doc", "left")
    return found.select(
        F.col("doc").alias(key),
        F.coalesce("n", F.lit(0)).cast("bigint").alias("n_paragraphs"),
        F.coalesce(F.size("removed"), F.lit(0)).cast("bigint").alias("n_removed"),
        F.coalesce("removed", F.array().cast(_REMOVED)).alias("removed"),
    )
