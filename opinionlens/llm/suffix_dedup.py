"""Repeated byte strings across documents, by a sparse suffix array.

A byte of a document is removed if it lies in a string of ``LENGTH`` bytes that also
starts in a document with a smaller id. Sorting every suffix would move each byte
``LENGTH`` times. Instead every string of ``LENGTH`` bytes, a window, is filed under one
of its grams, the one with the smallest hash (its anchor). Equal windows have equal
anchors, and neighbouring windows mostly share theirs: such a run of windows is one
stretch of text.

1. Stretches are compared by hash under their anchor. Of equal stretches, all but the
   one in the smallest document are repeats as a whole. A task settles its own equals
   and sends one of them on.
2. Where different stretches share an anchor, one of each is looked into. Their windows
   are suffixes cut to ``LENGTH`` bytes: sampled splitters deal them to ranges of their
   leading bytes (the anchor's), each range is sorted by a multikey sort that takes eight
   bytes at a time and goes on only among ties, and equal neighbours are compared by
   document. An anchor that fills a range of its own is dealt out window by window.
3. The verdicts meet the texts once more, by document id.

All hashes are functions of content, so equal strings meet wherever they are.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from opinionlens.llm.common import slices, small_batches, store, utf8

LENGTH = 50
GRAM = 20
ENTRIES_PER_BUCKET = 1 << 17  # stretches that a task compares at once
FLUSH = 1_000_000  # stretches that a task gathers before it sends them
WINDOWS_PER_RANGE = 400_000
SAMPLE_DOCS = 1000  # documents from which splitters are drawn
SPAN = LENGTH - GRAM + 1  # grams in a window, and windows in a stretch at most

_KEY_BITS = 48
_POSITION_BITS = 23


def _constants(seed: int, n: int) -> np.ndarray:
    return np.random.default_rng(seed).integers(0, 1 << 63, n, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


class Hashes:
    """Hashes of all grams and windows of a byte array, by doubling."""

    def __init__(self):
        self.letters, self.odd = _constants(11, 256), _constants(12, 16)

    def _join(self, left: np.ndarray, right: np.ndarray, at: int, k: int) -> np.ndarray:
        n = len(right) - at
        if n <= 0:
            return np.zeros(0, np.uint64)
        mixed = left[:n] * self.odd[k] + right[at:]
        mixed ^= mixed >> np.uint64(29)
        return mixed

    def of(self, content: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        powers, size = {1: self.letters[content]}, 1
        while 2 * size <= LENGTH:
            powers[2 * size] = self._join(powers[size], powers[size], size, size.bit_length())
            size *= 2

        def exactly(length: int) -> np.ndarray:
            have, value = 0, None
            for bit in sorted(powers, reverse=True):
                if length & bit:
                    value = powers[bit] if value is None else self._join(value, powers[bit], have, 8 + bit.bit_length())
                    have += bit
            return value * self.odd[15] if len(value) else value

        return exactly(GRAM), exactly(LENGTH)


class Stretches:
    """The stretches of a slice of texts.

    ``first`` and ``last`` windows (positions in ``content``), the ``anchor`` position,
    ``gram`` hash, ``key`` hash of the whole stretch and ``row`` of the text.
    """

    def __init__(self, hashes: Hashes, content: np.ndarray, offsets: np.ndarray):
        self.content = content
        empty = np.zeros(0, np.int64)
        self.first = self.last = self.anchor = self.row = empty
        self.gram = self.key = self.window_hash = np.zeros(0, np.uint64)
        if len(content) < LENGTH:
            return
        gram, window = hashes.of(content)
        mask = np.uint64((1 << _POSITION_BITS) - 1)
        least = (gram & ~mask) | np.arange(len(gram), dtype=np.uint64)
        size = 1
        while 2 * size <= SPAN:
            least = np.minimum(least[:-size], least[size:])
            size *= 2
        if SPAN > size:
            least = np.minimum(least[: len(least) - (SPAN - size)], least[SPAN - size :])
        anchor = (least & mask).astype(np.int64)
        row = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))[: len(anchor)]
        inside = np.flatnonzero(np.arange(len(anchor)) + LENGTH <= offsets[row + 1])
        if not len(inside):
            return
        of = anchor[inside]
        starts = np.concatenate([[True], (of[1:] != of[:-1]) | (inside[1:] != inside[:-1] + 1)])
        begin = np.flatnonzero(starts)
        self.first, self.last = inside[begin], inside[np.append(begin[1:], len(inside)) - 1]
        self.anchor, self.row = of[begin], row[inside[begin]]
        self.gram, self.window_hash = gram[self.anchor], window
        # Both ends together cover the stretch, as it is shorter than two windows.
        mixed = (window[self.first] * hashes.odd[13] + window[self.last]) * hashes.odd[14]
        mixed += (self.last - self.first).astype(np.uint64)
        mixed *= hashes.odd[0]
        self.key = mixed >> np.uint64(64 - _KEY_BITS)


def _parts(column: pa.Array) -> Iterator[tuple[int, int]]:
    """Slices small enough for positions to fit beside the hash; a longer text alone."""
    return slices(column, 1 << 20)


def _stretches(hashes: Hashes, content: np.ndarray, offsets: np.ndarray) -> Iterator[Stretches]:
    """Stretches of a slice; a text that is longer than a slice may be is read in pieces.

    Pieces overlap by a window less one byte, so that each window is in one piece only. A
    stretch that a border cuts is filed under the same anchor with the windows of either side.
    """
    most = (1 << _POSITION_BITS) - LENGTH
    if len(content) <= most:
        yield Stretches(hashes, content, offsets)
        return
    for row, (start, end) in enumerate(zip(offsets[:-1].tolist(), offsets[1:].tolist())):
        for at in range(start, max(start + 1, end - LENGTH + 1), most - LENGTH + 1):
            piece = content[at : min(end, at + most)]
            found = Stretches(hashes, piece, np.array([0, len(piece)]))
            found.row = found.row + row
            found.offset = at
            yield found


def _pack(*arrays: np.ndarray) -> bytes:
    return b"".join(np.ascontiguousarray(a).tobytes() for a in arrays)


def _compare(entries: DataFrame) -> DataFrame:
    """Step 1, where stretches meet: ``doc``, ``key`` and whether it is only to be looked into."""

    def compare(table: pa.Table) -> pa.Table:
        done_doc, done_key, grams, keys, docs = [], [], [], [], []
        for settled, blob in zip(table["settled"].to_pylist(), table["blob"].to_pylist()):
            n = len(blob) // (16 if settled else 24)
            if settled:
                done_doc.append(np.frombuffer(blob, np.int64, n))
                done_key.append(np.frombuffer(blob, np.int64, n, 8 * n))
            else:
                grams.append(np.frombuffer(blob, np.uint64, n))
                keys.append(np.frombuffer(blob, np.int64, n, 8 * n))
                docs.append(np.frombuffer(blob, np.int64, n, 16 * n))
        look_doc, look_key = np.zeros(0, np.int64), np.zeros(0, np.int64)
        if grams:
            gram, key, doc = np.concatenate(grams), np.concatenate(keys), np.concatenate(docs)
            order = np.lexsort((doc, key, gram))
            gram, key, doc = gram[order], key[order], doc[order]
            new_gram = np.concatenate([[True], gram[1:] != gram[:-1]])
            new_class = new_gram | np.concatenate([[True], key[1:] != key[:-1]])
            class_of = np.cumsum(new_class) - 1
            least = doc[np.flatnonzero(new_class)]
            repeats = doc > least[class_of]
            done_doc.append(doc[repeats])
            done_key.append(key[repeats])
            gram_of_class = (np.cumsum(new_gram) - 1)[new_class]
            # Only anchors with different stretches in different documents say more.
            several = np.bincount(gram_of_class) > 1
            starts = np.flatnonzero(np.concatenate([[True], gram_of_class[1:] != gram_of_class[:-1]]))
            apart = np.minimum.reduceat(least, starts) != np.maximum.reduceat(least, starts)
            chosen = (several & apart)[gram_of_class]
            look_doc, look_key = least[chosen], key[np.flatnonzero(new_class)][chosen]
        doc = np.concatenate([*done_doc, look_doc]) if done_doc else look_doc
        key = np.concatenate([*done_key, look_key]) if done_key else look_key
        look = np.arange(len(doc)) >= len(doc) - len(look_doc)
        return pa.table({"doc": pa.array(doc), "key": pa.array(key), "look": pa.array(look)})

    return entries.groupBy("bucket").applyInArrow(compare, "doc bigint, key bigint, look boolean")


def _stretch_entries(docs: DataFrame, bits: int) -> DataFrame:
    """Step 1, in the tasks that read: stretches by bucket of their anchor's hash.

    Of equal stretches in what a task has gathered only the smallest document is sent;
    the others are settled.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, held, count = Hashes(), [], 0

        def flush() -> Iterator[pa.RecordBatch]:
            gram, key, doc = (np.concatenate(x) for x in zip(*held))
            held.clear()
            order = np.lexsort((doc, key, gram))
            gram, key, doc = gram[order], key[order], doc[order]
            new_class = np.concatenate([[True], (gram[1:] != gram[:-1]) | (key[1:] != key[:-1])])
            new_doc = new_class | np.concatenate([[True], doc[1:] != doc[:-1]])
            settled = new_doc & ~new_class
            rows = []
            # What is settled goes by document, so that repeats of one stretch do not meet again.
            for mark, chosen, value in ((False, new_class, gram), (True, settled, doc.view(np.uint64) * hashes.odd[1])):
                at = np.flatnonzero(chosen)
                own = (value[at] >> np.uint64(64 - bits)).astype(np.int64)
                at, own = at[np.argsort(own, kind="stable")], np.sort(own)
                borders = np.concatenate([[0], np.flatnonzero(own[1:] != own[:-1]) + 1, [len(own)]]) if len(own) else [0]
                for i, j in zip(borders[:-1], borders[1:]):
                    part = at[i:j]
                    blob = _pack(doc[part], key[part]) if mark else _pack(gram[part], key[part], doc[part])
                    rows.append((int(own[i]), mark, blob))
            for i in range(0, len(rows), 256):
                b, m, x = zip(*rows[i : i + 256])
                yield pa.RecordBatch.from_arrays([pa.array(b, pa.int64()), pa.array(m), pa.array(x, pa.binary())], ["bucket", "settled", "blob"])

        for batch in batches:
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            for start, end in _parts(batch.column(1)):
                content, offsets = utf8(batch.column(1).slice(start, end - start))
                for found in _stretches(hashes, content, offsets):
                    if len(found.first):
                        held.append((found.gram, found.key.astype(np.int64), ids[start:end][found.row].astype(np.int64)))
                        count += len(found.first)
                if count > FLUSH:
                    yield from flush()
                    count = 0
        if held:
            yield from flush()

    return docs.mapInArrow(run, "bucket bigint, settled boolean, blob binary")


def _gram_bytes(content: np.ndarray, at: np.ndarray) -> np.ndarray:
    rows = content[at[:, None] + np.arange(GRAM)]
    return np.ascontiguousarray(rows).view(f"S{GRAM}").ravel()


def splitters(docs: DataFrame, rows: int, ranges: int) -> np.ndarray:
    """Anchors that cut the suffixes into ranges of similar size, from about SAMPLE_DOCS documents.

    An anchor that is drawn more than once fills a range of its own.
    """
    if ranges < 2:
        return np.zeros(0, f"S{GRAM}")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = Hashes()
        for batch in batches:
            for start, end in _parts(batch.column(0)):
                content, offsets = utf8(batch.column(0).slice(start, end - start))
                for found in _stretches(hashes, content, offsets):
                    few = np.flatnonzero(found.key % np.uint64(16) == 0)
                    if len(few):
                        piece = found.content[found.anchor[few][:, None] + np.arange(GRAM)]
                        yield pa.RecordBatch.from_arrays([pa.array([x.tobytes() for x in piece], pa.binary())], ["gram"])

    share = max(1, rows // SAMPLE_DOCS)
    some = docs.filter(F.pmod(F.xxhash64("doc"), F.lit(share)) == 0).select("text")
    drawn = [r.gram for r in some.mapInArrow(run, "gram binary").orderBy(F.xxhash64("gram")).limit(100_000).collect()]
    drawn = np.sort(np.array(drawn, f"S{GRAM}"))
    if not len(drawn):
        return drawn
    return drawn[np.linspace(0, len(drawn) - 1, ranges + 1).astype(int)[1:-1]]


def _window_entries(wanted: DataFrame, bounds: np.ndarray) -> DataFrame:
    """Step 2, from texts: the stretches to look into, by range of their anchor."""
    hot = np.unique(bounds[1:][bounds[1:] == bounds[:-1]]) if len(bounds) > 1 else bounds[:0]
    ranges = len(bounds) + 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = Hashes()
        for batch in batches:
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            held: dict[int, list] = {}
            settled: list[tuple[np.ndarray, ...]] = []
            for start, end in _parts(batch.column(1)):
                texts, keys = batch.column(1).slice(start, end - start), batch.column(2).slice(start, end - start)
                content, offsets = utf8(texts)
                asked = keys.flatten().to_numpy(zero_copy_only=False)
                asked_row = np.repeat(np.arange(end - start), keys.value_lengths().to_numpy(zero_copy_only=False))
                asked_pair = np.rec.fromarrays([asked_row, asked], names="r,k")
                for found in _stretches(hashes, content, offsets):
                    if not len(found.first):
                        continue
                    own = np.rec.fromarrays([found.row, found.key.astype(np.int64)], names="r,k")
                    # Repeats of a stretch in a text are asked once.
                    _, once = np.unique(own, return_index=True)
                    once = once[np.isin(own[once], asked_pair)]
                    if not len(once):
                        continue
                    first, last = found.first[once], found.last[once]
                    doc, key = ids[start:end][found.row[once]].astype(np.int64), own.k[once]
                    gram = _gram_bytes(found.content, found.anchor[once])
                    place = np.searchsorted(bounds, gram, "right")
                    crowded = np.isin(gram, hot)
                    lone = ~crowded
                    _file(held, found.content, place[lone], doc[lone], key[lone], first[lone], last[lone], np.zeros(lone.sum(), np.int64))
                    if crowded.any():
                        # Window by window, dealt by its hash; equal ones are settled here first.
                        n = (last - first + 1)[crowded]
                        within = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
                        at = np.repeat(first[crowded], n) + within
                        d, k = np.repeat(doc[crowded], n), np.repeat(key[crowded], n)
                        value = found.window_hash[at]
                        order = np.lexsort((d, value))
                        at, d, k, within, value = at[order], d[order], k[order], within[order], value[order]
                        new = np.concatenate([[True], value[1:] != value[:-1]])
                        repeat = d > d[np.flatnonzero(new)][np.cumsum(new) - 1]
                        settled.append((d[repeat], k[repeat], within[repeat]))
                        new &= ~repeat
                        place = ranges + (value % np.uint64(ranges)).astype(np.int64)
                        _file(held, found.content, place[new], d[new], k[new], at[new], at[new], within[new])
            rows = [(p, False, _pack(*map(np.concatenate, zip(*[x[:5] for x in parts]))) , b"".join(x[5] for x in parts)) for p, parts in held.items()]
            rows += [(int(i % (2 * ranges)), True, _pack(*s), b"") for i, s in enumerate(settled) if len(s[0])]
            for i in range(0, len(rows), 256):
                p, m, x, t = zip(*rows[i : i + 256])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(p, pa.int64()), pa.array(m), pa.array(x, pa.binary()), pa.array(t, pa.binary())],
                    ["place", "settled", "blob", "texts"],
                )

    return wanted.mapInArrow(run, "place bigint, settled boolean, blob binary, texts binary")


def _file(held: dict, content: np.ndarray, place, doc, key, first, last, within) -> None:
    order = np.argsort(place, kind="stable")
    borders = np.flatnonzero(np.concatenate([[True], place[order][1:] != place[order][:-1], [True]])) if len(order) else []
    for i, j in zip(borders[:-1], borders[1:]):
        part = order[i:j]
        sizes = last[part] - first[part] + LENGTH
        at = np.repeat(first[part] - (np.cumsum(sizes) - sizes), sizes) + np.arange(sizes.sum())
        held.setdefault(int(place[part[0]]), []).append(
            (doc[part], key[part], within[part], (last - first + 1)[part], sizes, content[at].tobytes())
        )


def multikey_order(words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The order of rows of unsigned words, and the number of the group of equals of each.

    Sorts by the first word, then goes on with the next one among ties only.
    """
    n, width = words.shape
    order = np.argsort(words[:, 0], kind="stable")
    group = np.cumsum(np.concatenate([[0], words[order[1:], 0] != words[order[:-1], 0]]))
    for k in range(1, width):
        same = np.concatenate([[False], group[1:] == group[:-1]])
        tied = np.flatnonzero(same | np.concatenate([same[1:], [False]]))
        if not len(tied):
            break
        value = words[order[tied], k]
        resort = np.lexsort((value, group[tied]))
        order[tied], value = order[tied][resort], value[resort]
        split = np.zeros(n, bool)
        split[tied[1:]] = (value[1:] != value[:-1]) & (group[tied[1:]] == group[tied[:-1]])
        group = group + np.cumsum(split)
    return order, group


def _sort_ranges(entries: DataFrame) -> DataFrame:
    """Step 2, in a range: the windows that start in a smaller document too, as bits of their stretch."""

    def sort(table: pa.Table) -> pa.Table:
        docs, keys, bits = [], [], []
        parts, texts = [], []
        for settled, blob, text in zip(table["settled"].to_pylist(), table["blob"].to_pylist(), table["texts"].to_pylist()):
            if settled:
                d, k, w = np.frombuffer(blob, np.int64).reshape(3, -1)
                docs.append(d), keys.append(k), bits.append(np.left_shift(1, w))
            else:
                parts.append(np.frombuffer(blob, np.int64).reshape(5, -1))
                texts.append(text)
        if parts:
            doc, key, within, n, sizes = np.concatenate(parts, axis=1)
            content = np.frombuffer(b"".join(texts), np.uint8)
            starts = np.cumsum(sizes) - sizes
            entry = np.repeat(np.arange(len(n)), n)
            step = np.arange(len(entry)) - np.repeat(np.cumsum(n) - n, n)
            at = starts[entry] + step
            padded = np.zeros((len(at), -(-LENGTH // 8) * 8), np.uint8)
            padded[:, :LENGTH] = np.lib.stride_tricks.sliding_window_view(content, LENGTH)[at]
            order, group = multikey_order(padded.view(">u8").astype(np.uint64))
            owner = doc[entry[order]]
            least = np.full(int(group[-1]) + 1, np.iinfo(np.int64).max)
            np.minimum.at(least, group, owner)
            repeat = order[owner > least[group]]
            of = entry[repeat]
            value = np.left_shift(1, step[repeat] + within[of])
            marks = np.zeros(len(n), np.int64)
            np.bitwise_or.at(marks, of, value)
            some = np.flatnonzero(marks)
            docs.append(doc[some]), keys.append(key[some]), bits.append(marks[some])
        columns = [np.concatenate(x) if x else np.zeros(0, np.int64) for x in (docs, keys, bits)]
        return pa.table(dict(zip(("doc", "key", "bits"), map(pa.array, columns))))

    return entries.groupBy("place").applyInArrow(sort, "doc bigint, key bigint, bits bigint")


def _apply(rows: DataFrame, keep_text: bool) -> DataFrame:
    """Step 3: cut the marked windows out of the texts that have any."""
    fields = "doc bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string"
    fields += ", kept binary" if keep_text else ""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = Hashes()
        for batch in batches:
            for start, end in _parts(batch.column(1)):
                part = batch.slice(start, end - start)
                content, offsets = utf8(part.column(1))
                marks = part.column(2)
                counts = np.nan_to_num(marks.value_lengths().to_numpy(zero_copy_only=False)).astype(np.int64)
                flat = marks.flatten()
                row = np.repeat(np.arange(len(part)), counts)
                told = np.rec.fromarrays([row, flat.field("key").to_numpy(zero_copy_only=False).astype(np.int64)], names="r,k")
                bits = flat.field("bits").to_numpy(zero_copy_only=False).astype(np.int64)
                order = np.argsort(told, kind="stable")
                told, bits = told[order], bits[order]
                change = np.zeros(len(content) + LENGTH + 1, np.int32)
                for found in _stretches(hashes, content, offsets) if len(told) else ():
                    if not len(found.first):
                        continue
                    shift = getattr(found, "offset", 0)
                    own = np.rec.fromarrays([found.row, found.key.astype(np.int64)], names="r,k")
                    low, high = np.searchsorted(told, own, "left"), np.searchsorted(told, own, "right")
                    hit = np.flatnonzero(high > low)
                    # A stretch may be told more than once: what any of them says holds.
                    mask = np.bitwise_or.reduceat(bits, low[hit]) if len(hit) else bits[:0]
                    several = np.flatnonzero(high[hit] - low[hit] >= 1)
                    for i in several[(high[hit] - low[hit])[several] > 1].tolist():
                        mask[i] = np.bitwise_or.reduce(bits[low[hit[i]] : high[hit[i]]])
                    single = (high[hit] - low[hit]) == 1
                    mask[single] = bits[low[hit]][single]
                    first, n = found.first[hit] + shift, (found.last - found.first + 1)[hit]
                    for k in range(SPAN):
                        marked = (n > k) & ((mask >> k) & 1 == 1)
                        np.add.at(change, first[marked] + k, 1)
                        np.add.at(change, first[marked] + k + LENGTH, -1)
                gone = np.cumsum(change)[: len(content)] > 0
                total = np.concatenate([[0], np.cumsum(gone)])
                begins = gone.copy()
                begins[1:] &= ~gone[:-1]
                # A run that goes on over the border of two texts begins anew.
                borders = offsets[1:-1][offsets[1:-1] < len(content)]
                begins[borders] = gone[borders]
                spans = np.concatenate([[0], np.cumsum(begins)])
                kept, kept_at = content[~gone].tobytes(), offsets - total[offsets]
                pieces = [kept[i:j] for i, j in zip(kept_at[:-1].tolist(), kept_at[1:].tolist())]
                columns = [
                    part.column(0),
                    pa.array(np.diff(offsets)),
                    pa.array(np.diff(total[offsets])),
                    pa.array(np.diff(spans[offsets])),
                    pa.array([hashlib.sha256(x).hexdigest() for x in pieces], pa.string()),
                ]
                if keep_text:
                    columns.append(pa.array(pieces, pa.binary()))
                yield pa.RecordBatch.from_arrays(columns, [f.split()[0] for f in fields.split(", ")])

    return rows.mapInArrow(run, fields)


def remove_repeats(docs: DataFrame, key: str = "doc_id", text: str = "text", keep_text: bool = False) -> DataFrame:
    """One row per row of ``docs``: its key, ``n_bytes``, ``n_removed``, ``n_spans``, ``kept_sha256``.

    Bytes are those of the text in UTF-8, null as empty; strings are judged on the input.
    With ``keep_text`` there is a column ``kept`` with the remaining bytes, which may cut a
    character in two. Rows with equal keys are one document: they never remove from each
    other. A row with a null key loses nothing and takes nothing from others.
    """
    small_batches(docs.sparkSession)
    body = docs.select(F.col(key).cast("bigint").alias("doc"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))
    rows, total = body.agg(F.count("*"), F.sum(F.octet_length("text"))).first()
    # About two anchors in a window's grams: stretches are expected at this rate.
    stretches = (total or 0) * 2 // (SPAN + 1)
    bits = max(5, (stretches // ENTRIES_PER_BUCKET).bit_length())
    known = body.filter("doc is not null")
    told = store(_compare(_stretch_entries(known, bits)))

    looked = told.filter("look")
    asked = looked.groupBy("doc").agg(F.collect_set("key").alias("keys"))
    windows = looked.count() * SPAN // 2
    bounds = splitters(known, rows, max(32, -(-windows // WINDOWS_PER_RANGE)))
    texts = known.repartition("doc")
    wanted = texts.join(asked, "doc").select("doc", "text", "keys")
    partial = _sort_ranges(_window_entries(wanted, bounds))
    whole = told.filter("not look").select("doc", "key", F.lit((1 << SPAN) - 1).cast("bigint").alias("bits"))
    marks = whole.unionAll(partial).groupBy("doc").agg(F.collect_list(F.struct("key", "bits")).alias("marks"))
    met = texts.join(marks, "doc", "left").select("doc", "text", "marks")
    lost = body.filter("doc is null").select("doc", "text", F.lit(None).cast(met.schema["marks"].dataType).alias("marks"))
    return _apply(met.unionAll(lost), keep_text).withColumnRenamed("doc", key)
