"""Ranked lexical search by pipelined term partitioning.

The index holds the terms of the items, each with the documents that have it. Terms are
dealt to owners, rare ones to the first, so that each owner has about as many postings. The
items form bundles, whose terms fit a bounded dictionary. A bundle carries, block of
documents by block, a sparse accumulator for each item from owner to owner: at every stage
it meets the owner's postings of the block in a cogroup, adds what they contribute, in whole
numbers, and goes on. After the last owner each block gives its best documents of each item,
and of these the best of all blocks are chosen.

An accumulator is left behind only where it is lost: where even the most that later owners
could add is less than the score which ``top`` documents of the block have already. Nothing
is gathered over all documents: a block has up to some thousand of them, however common a
term is.
"""

from __future__ import annotations

import math
import uuid
from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from opinionlens.llm.common import small_batches, store

TOP = 10
OWNERS = 4
BUNDLE_BYTES = 4 << 20  # of the items' terms, which tasks hold as a dictionary
PIECE_BYTES = 4 << 20  # of a text, whose terms a task holds at once
ITEMS_AT_ONCE = 256  # of a bundle, whose accumulators a task unpacks at once

# Terms are digits, letters of ASCII, lower-cased, and all beyond ASCII; the rest parts them.
_PART = bytes(b if b >= 128 or chr(b).isalnum() else 32 for b in range(256)).lower()


def terms(text: str | None) -> Iterator[list[bytes]]:
    """The terms of a text in order, repeats included, in lists of bounded size."""
    content = (text or "").encode().translate(_PART)
    start = 0
    while start < len(content):
        end = content.find(b" ", start + PIECE_BYTES)
        end = len(content) if end < 0 else end
        yield content[start:end].split()
        start = end


def term_weight(documents: int, holding: int) -> int:
    """What a term weighs that so many of all documents hold."""
    return math.floor(1000 * math.log((2 * documents + 2) / (2 * holding + 1)))


def contributions(weight: np.ndarray, tf: np.ndarray, n: np.ndarray, documents: int, length: int) -> np.ndarray:
    """What each posting adds to a score. ``n`` terms has its document, ``length`` all of them."""
    m = 100 - 90 + (90 * n * documents) // length
    return weight * ((1_000_000_000 * tf) // (1000 * tf + 8 * m))


class Bundle(NamedTuple):
    """Items, whose terms are numbered. ``of_item`` has the terms of each one."""

    rows: list[int]
    number: dict[bytes, int]
    of_item: list[np.ndarray]


def _bundles(items: DataFrame, most_bytes: int) -> Iterator[Bundle]:
    """All items in bundles of at most so many bytes of terms; one with more is alone."""
    bundles = 1
    while True:
        dealt = items.withColumn("bundle", F.pmod(F.xxhash64("row"), F.lit(bundles)))
        largest = dealt.groupBy("bundle").agg(F.sum("bytes").alias("bytes"), F.count("*").alias("n")).filter("n > 1").agg(F.max("bytes")).first()[0]
        if (largest or 0) <= most_bytes:
            break
        bundles *= 2
    for k in range(bundles):
        number: dict[bytes, int] = {}
        rows, of_item = [], []
        for row, own in dealt.filter(F.col("bundle") == k).select("row", "terms").orderBy("row").collect():
            rows.append(row)
            of_item.append(np.array([number.setdefault(bytes(t), len(number)) for t in own], np.int64))
        if number:
            yield Bundle(rows, number, of_item)


def _with_terms(items: DataFrame, item: str, text: str) -> DataFrame:
    """``item``, ``row``, the distinct ``terms`` and how many ``bytes`` they take."""
    named = items.select(F.col(item).alias("item"), F.monotonically_increasing_id().alias("row"), F.col(text).cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [sorted({t for part in terms(x) for t in part}) for x in batch.column(2).to_pylist()]
            sizes = [sum(map(len, x)) + len(x) for x in found]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:2], pa.array(found, pa.list_(pa.binary())), pa.array(sizes, pa.int64())], ["item", "row", "terms", "bytes"]
            )

    kind = named.schema["item"].dataType.simpleString()
    return store(named.mapInArrow(run, f"item {kind}, row bigint, terms array<binary>, bytes bigint"))


# --- postings -------------------------------------------------------------------

# A block of documents: their keys and numbers of terms, and its postings by term: the terms,
# how many documents hold each, the documents' places in the block and how often they hold it.
_POSTINGS = "block bigint, documents bigint, length bigint, keys array<bigint>, n binary, term binary, df binary, at binary, tf binary"
_NAMES = [x.split()[0] for x in _POSTINGS.split(", ")]


def _postings(docs: DataFrame, shipped, key: str, text: str) -> DataFrame:
    wanted = docs.select(F.col(key).cast("bigint").alias("key"), F.col(text).cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = shipped.value.get
        for batch in batches:
            n, at, found, tf = [], [], [], []
            for i, text in enumerate(batch.column(1)):
                own: Counter = Counter()
                size = 0
                for part in terms(text.as_py()):
                    size += len(part)
                    own.update(map(number, part))
                own.pop(None, None)
                n.append(size)
                at += [i] * len(own)
                found += own.keys()
                tf += own.values()
            if not any(n):
                continue
            term, at, tf, n = (np.array(x, np.int32) for x in (found, at, tf, n))
            order = np.argsort(term, kind="stable")
            term, at, tf = term[order], at[order], tf[order]
            some, df = np.unique(term, return_counts=True)
            # A name that no other try of this task can have; the table keeps one try's.
            block = uuid.uuid4().int >> 65
            row = [block, int((n > 0).sum()), int(n.sum(dtype=np.int64)), batch.column(0).to_pylist(), *[x.tobytes() for x in (n, some, df.astype(np.int32), at, tf)]]
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int64()), *[pa.binary()] * 5)
            yield pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in zip(row, kinds)], _NAMES)

    return store(wanted.mapInArrow(run, _POSTINGS))


def _document_counts(postings: DataFrame, size: int) -> np.ndarray:
    """How many documents hold each of the bundle's ``size`` terms."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size, np.int64)
        for batch in batches:
            for term, df in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                total[np.frombuffer(term, np.int32)] += np.frombuffer(df, np.int32)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], ["term", "df"])

    counted = postings.select("term", "df").mapInArrow(run, "term bigint, df bigint")
    counts = np.zeros(size, np.int64)
    for term, df in counted.groupBy("term").agg(F.sum("df")).collect():
        counts[term] = df
    return counts


def owners_of(weight: np.ndarray, df: np.ndarray, owners: int) -> np.ndarray:
    """The owner of each term: the heaviest to the first, and about as many postings to each."""
    order = np.argsort(-weight, kind="stable")
    before = np.cumsum(df[order]) - df[order]
    owner = np.zeros(len(df), np.int64)
    owner[order] = np.minimum(before * owners // max(int(df.sum()), 1), owners - 1)
    return owner


# --- stages ---------------------------------------------------------------------

_CARRIED = "block bigint, items binary, docs binary, scores binary"


class Plan(NamedTuple):
    """What all stages know of a bundle."""

    of_item: list[np.ndarray]
    weight: np.ndarray
    owner: np.ndarray
    to_come: list[np.ndarray]  # for each stage the most that later owners can add to each item
    documents: int
    length: int
    top: int


def _still_to_come(of_item: list[np.ndarray], weight: np.ndarray, owner: np.ndarray, owners: int) -> list[np.ndarray]:
    most = weight * (1_000_000_000 // 1000)
    return [np.array([int(most[t[owner[t] > stage]].sum()) for t in of_item], np.int64) for stage in range(owners)]


def _add(plan: Plan, stage: int, carried: tuple[np.ndarray, ...], posted: dict | None) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """For each item its documents and scores after a stage, but for lost ones.

    ``carried`` are items, documents and scores so far, sorted by item.
    """
    to_come = plan.to_come[stage]
    items, docs, scores = carried
    if posted is None:
        size, place, starts, added, at = int(docs.max()) + 1 if len(docs) else 0, {}, [0], None, None
    else:
        n, term, df, at, tf = (np.frombuffer(posted[c], np.int32).astype(np.int64) for c in ("n", "term", "df", "at", "tf"))
        size = len(n)
        starts = np.concatenate([[0], np.cumsum(df)]).tolist()
        place = {t: i for i, t in enumerate(term.tolist())}
        added = contributions(np.repeat(plan.weight[term], df), tf, n[at], plan.documents, plan.length)
    for low in range(0, len(plan.of_item), ITEMS_AT_ONCE):
        high = min(low + ITEMS_AT_ONCE, len(plan.of_item))
        held = np.zeros((high - low, size), np.int64)
        i, j = np.searchsorted(items, [low, high])
        held[items[i:j] - low, docs[i:j]] = scores[i:j]
        for item in range(low, high):
            own = held[item - low]
            for t in plan.of_item[item].tolist():
                p = place.get(t)
                if p is not None:
                    own[at[starts[p] : starts[p + 1]]] += added[starts[p] : starts[p + 1]]
            some = np.flatnonzero(own)
            if len(some) > plan.top:
                least = np.partition(own[some], len(some) - plan.top)[len(some) - plan.top]
                some = some[own[some] + to_come[item] >= least]
            if len(some):
                yield item, some, own[some]


def _stage(bundles: DataFrame | None, postings: DataFrame, stage: int, shared) -> DataFrame:
    """The bundles after they met an owner's postings."""

    def own(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        owner = Plan(*shared.value).owner
        for batch in batches:
            for row in batch.to_pylist():
                term, df = np.frombuffer(row["term"], np.int32), np.frombuffer(row["df"], np.int32)
                chosen = owner[term] == stage
                each = np.repeat(chosen, df)
                row |= {"term": term[chosen].tobytes(), "df": df[chosen].tobytes()}
                row |= {c: np.frombuffer(row[c], np.int32)[each].tobytes() for c in ("at", "tf")}
                yield pa.RecordBatch.from_pylist([row], schema=batch.schema)

    def meet(bundle: pa.Table, posted: pa.Table) -> pa.Table:
        plan = Plan(*shared.value)
        carried = [np.zeros(0, np.int32), np.zeros(0, np.int32), np.zeros(0, np.int64)]
        if len(bundle):
            row = bundle.to_pylist()[0]
            carried = [np.frombuffer(row[c], t) for c, t in (("items", np.int32), ("docs", np.int32), ("scores", np.int64))]
        block = (bundle if len(bundle) else posted)["block"][0].as_py()
        found = list(_add(plan, stage, carried, posted.to_pylist()[0] if len(posted) else None))
        items = np.repeat(np.array([x[0] for x in found], np.int32), [len(x[1]) for x in found])
        docs = np.concatenate([x[1] for x in found]).astype(np.int32) if found else np.zeros(0, np.int32)
        scores = np.concatenate([x[2] for x in found]) if found else np.zeros(0, np.int64)
        names = _CARRIED.replace(" bigint", "").replace(" binary", "").split(", ")
        return pa.table([pa.array([block], pa.int64()), *[pa.array([x.tobytes()], pa.binary()) for x in (items, docs, scores)]], names)

    side = postings.select("block", "n", "term", "df", "at", "tf")
    side = side.mapInArrow(own, "block bigint, n binary, term binary, df binary, at binary, tf binary")
    if bundles is None:
        bundles = postings.select("block", *[F.lit(b"").alias(c) for c in ("items", "docs", "scores")])
    return bundles.groupBy("block").cogroup(side.groupBy("block")).applyInArrow(meet, _CARRIED)


def _best(bundles: DataFrame, postings: DataFrame, rows: list[int], top: int) -> DataFrame:
    """``row``, ``key`` and ``score`` of the best documents of each block, equal scores by key, null last."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in batch.to_pylist():
                items, docs, scores = (np.frombuffer(block[c], t) for c, t in (("items", np.int32), ("docs", np.int32), ("scores", np.int64)))
                key = np.array([x or 0 for x in block["keys"]], np.int64)[docs]
                null = np.array([x is None for x in block["keys"]], bool)[docs]
                order = np.lexsort((key, null, -scores, items))
                first = np.searchsorted(items[order], items[order])
                order = order[np.arange(len(order)) - first < top]
                keys = [None if x else k for k, x in zip(key[order].tolist(), null[order].tolist())]
                row = [rows[i] for i in items[order].tolist()]
                yield pa.RecordBatch.from_arrays([pa.array(row, pa.int64()), pa.array(keys, pa.int64()), pa.array(scores[order])], ["row", "key", "score"])

    met = bundles.join(postings.select("block", "keys"), "block")
    return met.select("keys", "items", "docs", "scores").mapInArrow(run, "row bigint, key bigint, score bigint")


def search(
    docs: DataFrame, items: DataFrame, key: str = "doc_id", item: str = "item_id", text: str = "text", item_text: str = "text",
    top: int = TOP, owners: int = OWNERS, bundle_bytes: int = BUNDLE_BYTES,
) -> DataFrame:
    """The ``top`` documents of each item: ``item``, ``rank`` from 1 on, ``key`` and ``score``.

    A term counts once for an item, and as often as it stands in a document. Only documents
    with a score above 0 are given, equal scores by ascending key, null last. Null and empty
    texts have no terms: such items get no rows, such documents no score, and they do not
    count. Every row is an item or a document of its own: equal items get the same rows each,
    equal documents take a rank each. Other columns do not matter.
    """
    spark = docs.sparkSession
    small_batches(spark)
    known = _with_terms(items, item, item_text)
    kind = known.schema["item"].dataType.simpleString()
    best = spark.createDataFrame([], "row bigint, key bigint, score bigint")
    for bundle in _bundles(known, bundle_bytes):
        postings = _postings(docs, spark.sparkContext.broadcast(bundle.number), key, text)
        documents, length = postings.agg(F.sum("documents"), F.sum("length")).first()
        if not documents:
            continue
        df = _document_counts(postings, len(bundle.number))
        weight = np.array([term_weight(documents, x) for x in df.tolist()], np.int64)
        owner = owners_of(weight, df, owners)
        plan = Plan(bundle.of_item, weight, owner, _still_to_come(bundle.of_item, weight, owner, owners), documents, length, top)
        shared = spark.sparkContext.broadcast(tuple(plan))
        bundles = None
        for stage in range(owners):
            bundles = _stage(bundles, postings, stage, shared)
        best = best.unionAll(_best(bundles, postings, bundle.rows, top))
    order = Window.partitionBy("row").orderBy(F.desc("score"), F.asc_nulls_last("key"))
    ranked = best.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)
    named = ranked.join(known.select("row", F.col("item").cast(kind).alias("item")), "row")
    return named.select(F.col("item").alias(item), F.col("rank").cast("int").alias("rank"), F.col("key").alias(key), "score")
