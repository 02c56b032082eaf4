"""K-Means over sparse word vectors in whole numbers, the same for every layout of the input.

Weights are multiples of ``1 / SCALE``. Products and sums of whole numbers do not depend on
their order, so neither partitions nor lost and repeated tasks change a cluster. Posts keep
their place: a step sends, per task, one row for each cluster and word that the task has
seen, and centroids of at most ``k * vocab_size`` numbers come back.
"""

from __future__ import annotations

import sys
from collections.abc import Iterable, Iterator, Sequence
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, IntegerType, LongType, StructField, StructType

from opinionlens import constants as K
from opinionlens.operators.models import topic_words
from opinionlens.operators.words import tfidf_terms
from opinionlens.session import discard, materialize

# Functions that run in tasks are shipped by value: executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

SCALE = 1 << 20
SLICE_ITEMS = 1 << 18  # words that a task works on at once, whatever the Arrow batch holds
SEED_ROUNDS = 5  # rounds of seeding, each of which draws twice as many posts as there are clusters


class Terms(NamedTuple):
    """A vocabulary, at most ``vocab_size`` words, and the inverse document frequency of each."""

    words: list[str]
    idf: list[float]


def vocabulary(words: DataFrame, vocab_size: int = K.VOCAB_SIZE, min_df: float = K.MIN_DF, max_df: float = K.MAX_DF) -> Terms:
    """The terms of the array column ``words`` in order of their number."""
    terms = tfidf_terms(words, vocab_size, min_df, max_df, stops=()).select("word", "idf").collect()
    if not terms:
        raise ValueError(f"no word is in at least {min_df} and at most {max_df} of the posts")
    return Terms([t.word for t in terms], [t.idf for t in terms])


def _lengths(column: pa.Array) -> np.ndarray:
    """How many items each row of a list column, or of one packed as bytes of 64-bit numbers, has."""
    if pa.types.is_list(column.type):
        return pc.fill_null(pc.list_value_length(column), 0).to_numpy(zero_copy_only=False)
    return pc.binary_length(column).to_numpy(zero_copy_only=False) // 8


def _ranges(column: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """The row of each item of a list column, and the items."""
    return np.repeat(np.arange(len(column)), _lengths(column)), column.flatten()


def _numbers(column: pa.Array) -> np.ndarray:
    """The items of a list column of numbers, or of one packed as bytes, one row after the other."""
    if pa.types.is_list(column.type):
        return column.flatten().to_numpy(zero_copy_only=False)
    _, offsets, data = column.buffers()
    ends = np.frombuffer(offsets, np.int32)[column.offset : column.offset + len(column) + 1]
    return np.frombuffer(data, np.int64, (ends[-1] - ends[0]) // 8, ends[0]) if ends[-1] > ends[0] else np.zeros(0, np.int64)


def _slices(batch: pa.RecordBatch, at: int, most: int | None = None) -> Iterator[pa.RecordBatch]:
    """``batch`` in parts whose list column holds up to ``most`` items; a longer row is alone."""
    ends = np.cumsum(_lengths(batch.column(at)), dtype=np.int64)
    start = 0
    while start < len(batch):
        before = ends[start - 1] if start else 0
        stop = max(int(np.searchsorted(ends, before + (most or SLICE_ITEMS), "right")), start + 1)
        yield batch.slice(start, stop - start)
        start = stop


def _vectors(column: pa.Array, names: pa.Array, idf: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, term and weight of the entries of the vectors of a list column of words."""
    row, items = _ranges(column)
    place = pc.fill_null(pc.index_in(items, names), -1).to_numpy(zero_copy_only=False)
    code, tf = np.unique(row[place >= 0].astype(np.int64) * len(idf) + place[place >= 0], return_counts=True)
    row, place = code // len(idf), code % len(idf)
    weight = tf * idf[place]
    length = np.sqrt(np.bincount(row, weight * weight, len(column)))
    return row, place, np.rint(weight / length[row] * SCALE).astype(np.int64)


def sparse_vectors(words: DataFrame, terms: Terms, packed: bool = False) -> DataFrame:
    """``words`` with the arrays ``terms`` and ``weights`` in place of the column ``words``.

    Weights are those of normalised TF-IDF vectors in multiples of ``1 / SCALE``; terms are
    places in the vocabulary, ascending. A post without a known word has empty arrays.
    ``packed`` arrays are bytes of 64-bit numbers, which a pass reads much faster.
    """
    kept = [c for c in words.columns if c not in ("words", "terms", "weights")]
    kinds = [BinaryType(), BinaryType()] if packed else [ArrayType(IntegerType()), ArrayType(LongType())]
    arrays = [StructField(name, kind) for name, kind in zip(("terms", "weights"), kinds)]
    schema = StructType([*words.select(*kept).schema, *arrays])
    shipped = words.sparkSession.sparkContext.broadcast((terms.words, terms.idf))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, idf = pa.array(shipped.value[0]), np.array(shipped.value[1])
        for batch in (part for whole in batches for part in _slices(whole, len(kept))):
            row, place, weight = _vectors(batch.column(len(kept)), names, idf)
            offsets = np.searchsorted(row, np.arange(len(batch) + 1)).astype(np.int32)
            if packed:
                lists = [pa.Array.from_buffers(pa.binary(), len(batch), [None, pa.py_buffer(offsets * np.int32(8)), pa.py_buffer(x)]) for x in (place, weight)]
            else:
                lists = [pa.ListArray.from_arrays(pa.array(offsets), pa.array(x)) for x in (place.astype(np.int32), weight)]
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(kept)], *lists], names=schema.names)

    return words.select(*kept, "words").mapInArrow(run, schema)


def _distances(row: np.ndarray, term: np.ndarray, weight: np.ndarray, rows: int, centroids: np.ndarray) -> np.ndarray:
    """Squared distances in units of ``SCALE ** -2``, less the squared length of the vector itself."""
    found = np.zeros((len(centroids), rows), np.int64)
    begin = np.flatnonzero(np.diff(row, prepend=-1))  # items lie row by row
    products = np.empty(len(term), np.int64)
    for own, centroid in zip(found, centroids):
        if len(begin):
            np.take(centroid, term, out=products, mode="clip")
            own[row[begin]] = np.add.reduceat(np.multiply(products, weight, out=products), begin)
    return (centroids * centroids).sum(axis=1) - 2 * found.T


def _batch(batch: pa.RecordBatch, at: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    row = np.repeat(np.arange(len(batch)), _lengths(batch.column(at)))
    return row, _numbers(batch.column(at)).astype(np.intp, copy=False), _numbers(batch.column(at + 1))


def assign(vectors: DataFrame, centroids: np.ndarray, keep: Sequence[str]) -> DataFrame:
    """The ``keep`` columns and the ``cluster`` of each post; of equally near ones the first."""
    schema = StructType([*vectors.select(*keep).schema, StructField("cluster", IntegerType())])
    shipped = vectors.sparkSession.sparkContext.broadcast(centroids)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (part for whole in batches for part in _slices(whole, len(keep))):
            nearest = _distances(*_batch(batch, len(keep)), len(batch), shipped.value).argmin(axis=1)
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(keep)], pa.array(nearest.astype(np.int32))], names=schema.names)

    return vectors.select(*keep, "terms", "weights").mapInArrow(run, schema)


def kmeans_step(vectors: DataFrame, centroids: np.ndarray) -> DataFrame:
    """What one step makes of the centroids: ``cluster``, ``term``, ``weight`` and ``posts``.

    Every post goes to its nearest centroid; the new ones are the means of their posts,
    rounded down. Only terms with a weight have a row; a cluster without posts has none.
    """
    shipped = vectors.sparkSession.sparkContext.broadcast(centroids)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals = np.zeros_like(shipped.value)
        posts = np.zeros(len(totals), np.int64)
        for batch in (part for whole in batches for part in _slices(whole, 0)):
            row, term, weight = _batch(batch, 0)
            nearest = _distances(row, term, weight, len(batch), shipped.value).argmin(axis=1)
            posts += np.bincount(nearest, minlength=len(totals))
            # Sums of one slice are far below 2 ** 53, where doubles are exact.
            totals += np.bincount(nearest[row] * totals.shape[1] + term, weight, totals.size).astype(np.int64).reshape(totals.shape)
        cluster, term = np.nonzero(totals)
        some = np.flatnonzero(posts)
        columns = (np.concatenate([cluster, some]), np.concatenate([term, np.full(len(some), -1)]), np.concatenate([totals[cluster, term], posts[some]]))
        yield pa.RecordBatch.from_arrays([pa.array(x.astype(np.int64)) for x in columns], names=["cluster", "term", "total"])

    # Sums of tasks are added up as decimals, which no number of posts overflows.
    sums = vectors.select("terms", "weights").mapInArrow(run, "cluster bigint, term bigint, total bigint")
    sums = sums.groupBy("cluster", "term").agg(F.sum(F.col("total").cast("decimal(38,0)")).alias("total"))
    # A join with the rows that hold the sizes would go through all posts once more.
    size = F.max(F.when(F.col("term") < 0, F.col("total"))).over(Window.partitionBy("cluster"))
    means = sums.withColumn("posts", size.cast("bigint")).filter("term >= 0")
    return means.select("cluster", "term", F.expr("cast(floor(total / posts) as bigint)").alias("weight"), "posts")


def as_centroids(rows: Iterable, k: int, size: int) -> np.ndarray:
    """Centroids from rows with ``cluster``, ``term`` and ``weight``."""
    found = np.zeros((k, size), np.int64)
    for r in rows:
        found[r["cluster"], r["term"]] = r["weight"]
    return found


def seeds(vectors: DataFrame, key: str, k: int, size: int, seed: int = K.SEED, rounds: int = SEED_ROUNDS) -> np.ndarray:
    """First centroids, drawn from posts far from those drawn before (k-means||).

    A round draws ``2 * k`` posts, each in proportion to its squared distance from the
    nearest one drawn so far: those of least ``-ln(u) / distance``, where ``u`` is a hash of
    the post's key. Drawn posts are weighed by how many posts they are nearest to, and ``k``
    of them are chosen one after the other, each the one that leaves the least squared
    distances from the drawn posts to those chosen. The driver holds at most ``1 + 2 * k * rounds`` vectors.
    """

    def draw(name: str) -> F.Column:
        digest = F.md5(F.concat(F.lit(f"{seed}:{name}:"), F.col(key).cast("string")))
        return (F.conv(F.substring(digest, 1, 12), 16, 10).cast("double") + 0.5) / float(1 << 48)

    def dense(rows: Sequence) -> np.ndarray:
        found = np.zeros((len(rows), size), np.int64)
        for i, r in enumerate(rows):
            found[i, items(r["terms"])] = items(r["weights"])
        return found

    def items(x: Sequence[int] | bytes) -> Sequence[int]:
        return np.frombuffer(x, np.int64) if isinstance(x, (bytes, bytearray)) else x

    ordered = [draw("first"), F.col(key)]
    length = F.octet_length if isinstance(vectors.schema["terms"].dataType, BinaryType) else F.size
    drawn = dense(vectors.filter(length("terms") > 0).orderBy(*ordered).select("terms", "weights").limit(1).collect())
    for n in range(rounds):
        far = _far(vectors.select(key, (-F.log(draw(str(n)))).alias("toll"), "terms", "weights"), drawn, 2 * k)
        order = [F.col("toll") / F.col("distance"), F.col(key)]
        chosen = far.orderBy(*order).select("terms", "weights").limit(2 * k).collect()
        if not chosen:
            break
        drawn = np.unique(np.concatenate([drawn, dense(chosen)]), axis=0)
    weight = _sizes(vectors, drawn).astype(float)
    lengths = (drawn.astype(float) ** 2).sum(axis=1)
    apart = np.maximum(lengths[:, None] + lengths - 2 * (drawn.astype(float) @ drawn.T), 0)
    gap = np.full(len(drawn), np.inf)
    picked: list[int] = []
    while len(picked) < min(k, len(drawn)):
        left = [i for i in range(len(drawn)) if i not in picked]
        picked.append(min(left, key=lambda i: (float(weight @ np.minimum(gap, apart[i])), i)))
        gap = np.minimum(gap, apart[picked[-1]])
    found = np.zeros((k, size), np.int64)
    found[: len(picked)] = drawn[picked]
    return found


def _far(posts: DataFrame, centroids: np.ndarray, most: int) -> DataFrame:
    """The key, ``toll``, vector and squared ``distance`` from the nearest centroid, for posts away from all of them.

    Of each slice only posts are given that may be among the ``most`` of least toll per
    distance, ties included; those without a toll come before all others.
    """
    schema = StructType([*posts.schema, StructField("distance", LongType())])
    shipped = posts.sparkSession.sparkContext.broadcast(centroids)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (part for whole in batches for part in _slices(whole, 2)):
            row, term, weight = _batch(batch, 2)
            own = np.zeros(len(batch), np.int64)
            np.add.at(own, row, weight * weight)
            distance = _distances(row, term, weight, len(batch), shipped.value).min(axis=1) + own
            far = np.flatnonzero(distance > 0)
            order = batch.column(1).to_numpy(zero_copy_only=False)[far] / distance[far]
            order[np.isnan(order)] = -np.inf
            if len(far) > most:
                far = far[order <= np.partition(order, most - 1)[most - 1]]
            yield pa.RecordBatch.from_arrays([*batch.take(pa.array(far)).columns, pa.array(distance[far])], names=schema.names)

    return posts.mapInArrow(run, schema)


def _sizes(vectors: DataFrame, centroids: np.ndarray) -> np.ndarray:
    """How many posts each centroid is the nearest one of."""
    shipped = vectors.sparkSession.sparkContext.broadcast(centroids)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        posts = np.zeros(len(shipped.value), np.int64)
        for batch in (part for whole in batches for part in _slices(whole, 0)):
            posts += np.bincount(_distances(*_batch(batch, 0), len(batch), shipped.value).argmin(axis=1), minlength=len(posts))
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(posts))), pa.array(posts)], names=["at", "posts"])

    found = np.zeros(len(centroids), np.int64)
    for r in vectors.select("terms", "weights").mapInArrow(run, "at bigint, posts bigint").groupBy("at").agg(F.sum("posts").alias("posts")).collect():
        found[r["at"]] = r["posts"]
    return found


class Clusters(NamedTuple):
    terms: Terms
    centroids: np.ndarray
    steps: int
    clustered: DataFrame


def fit_clusters(
    posts: DataFrame, key: str, k: int = K.KMEANS_K, *, keep: Sequence[str] = ("binary_label",), stops: Iterable[str] | None = None,
    vocab_size: int = K.VOCAB_SIZE, min_df: float = K.MIN_DF, max_df: float = K.MAX_DF, seed: int = K.SEED, max_steps: int = 20,
) -> Clusters:
    """Cluster posts by K-Means on normalised TF-IDF vectors of their words.

    ``key`` names a column that is unique per post; it drives the draws, so the clusters
    are those of the posts, whatever their layout. Steps end when no centroid moves, or
    after ``max_steps``. A cluster that loses all its posts keeps its centroid. Vectors are
    stored while the fit lasts. The result has the ``keep`` columns, ``words`` and ``cluster``.
    """
    words = topic_words(posts, dict.fromkeys([key, *keep]), stops)
    terms = vocabulary(words, vocab_size, min_df, max_df)
    size = len(terms.words)
    table = materialize(sparse_vectors(words.select(key, "words"), terms, packed=True))
    centroids = seeds(table, key, k, size, seed)
    steps = 0
    while steps < max_steps:
        steps += 1
        rows = kmeans_step(table, centroids).select("cluster", "term", "weight").collect()
        moved = as_centroids(rows, k, size)
        empty = sorted(set(range(k)) - {r["cluster"] for r in rows})
        moved[empty] = centroids[empty]
        if (moved == centroids).all():
            break
        centroids = moved
    discard(table)
    with_words = words.select("*", F.col("words").alias("own_words"))
    names = list(dict.fromkeys(keep))
    clustered = assign(sparse_vectors(with_words, terms, packed=True), centroids, [*names, "own_words"])
    return Clusters(terms, centroids, steps, clustered.withColumnRenamed("own_words", "words"))
