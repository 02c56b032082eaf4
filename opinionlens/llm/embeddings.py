"""Near-duplicate vectors by an epsilon grid order join.

Vectors are scaled to length one, so that a cosine limit is a distance limit epsilon.
They are turned to their principal directions and sorted by the cells of a grid of
that width on the leading ones: the epsilon grid order. The sequence of a label is cut
into intervals, and intervals are joined recursively: a pair whose boxes are provably
further apart than epsilon is skipped, others are halved, and short ones are compared
by one matrix product in double precision.

Equal vectors of a label are one row from the start. From each pair of intervals come
at most as many rows as the two hold: how many vectors each one links, and a forest
that connects what is linked. All pairs within a group are never written.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from opinionlens.llm.common import store
from opinionlens.llm.components import components

COSINE = 0.93
LEADING = 6  # principal directions that the grid and the boxes use
INTERVAL = 2048  # vectors of an interval of the sequence
SHORT = 128  # vectors that are compared without halving further
FAN = 32  # intervals below one interval of the level above


def _usable(embedding: Column, label: Column) -> Column:
    """Whether a vector has a direction: components that are all finite, and not all zero."""
    infinite = F.lit(float("inf"))
    finite = F.forall(embedding, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < infinite))
    return label.isNotNull() & embedding.isNotNull() & F.coalesce(finite & F.exists(embedding, lambda x: x != 0), F.lit(False))


def _unit(vectors: np.ndarray) -> np.ndarray:
    vectors = vectors.astype(np.float64)
    # Two steps, so that neither tiny nor huge components leave the range.
    vectors = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return vectors / np.sqrt((vectors * vectors).sum(axis=1, keepdims=True))


def _matrix(column: pa.Array, dimension: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dimension)


def principal_directions(classes: DataFrame, dimension: int, leading: int) -> np.ndarray:
    """The leading principal directions of all unit vectors, as columns.

    Tasks send sums of products, which Spark adds up; the driver sees one matrix of
    ``dimension`` times ``dimension``, whatever the number of vectors.
    """

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, count = np.zeros((dimension + 1, dimension)), 0
        for batch in batches:
            unit = _unit(_matrix(batch.column(0), dimension))
            total[:dimension] += unit.T @ unit
            total[dimension] += unit.sum(axis=0)
            count += len(unit)
        if count:
            place = pa.array(np.arange(total.size + 1))
            yield pa.RecordBatch.from_arrays([place, pa.array(np.append(total.ravel(), count))], ["place", "value"])

    rows = classes.select("embedding").mapInArrow(sums, "place bigint, value double")
    found = dict(rows.groupBy("place").agg(F.sum("value")).collect())
    flat = np.array([found[i] for i in range(len(found))])
    count, flat = flat[-1], flat[:-1].reshape(dimension + 1, dimension)
    mean = flat[dimension] / count
    _, directions = np.linalg.eigh(flat[:dimension] / count - np.outer(mean, mean))
    return directions[:, ::-1][:, :leading]


def _boxes_apart(low_a, high_a, low_b, high_b) -> float:
    gap = np.maximum(0, np.maximum(low_a - high_b, low_b - high_a))
    return float((gap * gap).sum())


def _forest(a: np.ndarray, b: np.ndarray, nodes: int) -> tuple[np.ndarray, np.ndarray]:
    """For links between numbered nodes, a link from each linked node to one of its component."""
    label = np.arange(nodes)
    while True:
        least = np.minimum(label[a], label[b])
        fresh = label.copy()
        np.minimum.at(fresh, a, least)
        np.minimum.at(fresh, b, least)
        fresh = fresh[fresh]
        if (fresh == label).all():
            break
        label = fresh
    child = np.flatnonzero(label != np.arange(nodes))
    return child, label[child]


class _Interval:
    def __init__(self, ids: bytes, sizes: bytes, vectors: bytes, leading: bytes, dimension: int):
        self.ids = np.frombuffer(ids, np.int64)
        self.sizes = np.frombuffer(sizes, np.int64)
        self.unit = _unit(np.frombuffer(vectors, np.float32 if len(vectors) == 4 * dimension * len(self.ids) else np.float64).reshape(-1, dimension))
        self.leading = np.frombuffer(leading, np.float64).reshape(len(self.ids), -1)


def _join(a: _Interval, b: _Interval, same: bool, cosine: float, reach: float) -> tuple[list, list]:
    """Linked positions of two intervals, or within one, by recursive halving."""
    left, right = [], []

    def step(i: int, j: int, k: int, m: int) -> None:
        x, y = a.leading[i:j], b.leading[k:m]
        if _boxes_apart(x.min(0), x.max(0), y.min(0), y.max(0)) > reach:
            return
        if max(j - i, m - k) <= SHORT:
            found = np.argwhere(a.unit[i:j] @ b.unit[k:m].T >= cosine)
            if same and i == k:
                found = found[found[:, 0] < found[:, 1]]
            left.append(found[:, 0] + i)
            right.append(found[:, 1] + k)
            return
        halves_a = [(i, (i + j) // 2), ((i + j) // 2, j)] if j - i > SHORT else [(i, j)]
        halves_b = [(k, (k + m) // 2), ((k + m) // 2, m)] if m - k > SHORT else [(k, m)]
        for p in halves_a:
            for q in halves_b:
                if not (same and p[0] > q[0]):  # within an interval each pair of parts once
                    step(*p, *q)

    step(0, len(a.ids), 0, len(b.ids))
    return np.concatenate(left) if left else np.zeros(0, int), np.concatenate(right) if right else np.zeros(0, int)


def linked(classes: DataFrame, cosine: float = COSINE, leading: int = LEADING) -> DataFrame:
    """For the ends of links, rows of ``a``, and either ``b`` or ``n``.

    ``classes`` has ``id`` (bigint, unique), ``label``, ``size`` and ``embedding`` of one
    dimension. A row with ``b`` is a link of a forest that has the components of all
    links; the sum of ``n`` over the other rows of an ``a`` is the number of vectors that
    it links, copies counted.
    """
    dimension = len(classes.select("embedding").first()[0])
    doubles = "double" in classes.schema["embedding"].dataType.simpleString()
    leading = min(leading, dimension)
    epsilon = math.sqrt(2 - 2 * cosine) + 1e-9
    directions = principal_directions(classes, dimension, leading)

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not len(batch):
                continue
            turned = _unit(_matrix(batch.column(3), dimension)) @ directions
            cells = np.floor(turned / epsilon).astype(np.int32)
            lists = [
                pa.FixedSizeListArray.from_arrays(pa.array(x.ravel()), leading).cast(pa.list_(pa.from_numpy_dtype(x.dtype)))
                for x in (cells, turned)
            ]
            yield pa.RecordBatch.from_arrays([*batch.columns, *lists], ["id", "label", "size", "embedding", "cells", "turned"])

    kind = classes.schema["embedding"].dataType.simpleString()
    label = classes.schema["label"].dataType.simpleString()
    schema = f"id bigint, label {label}, size bigint, embedding {kind}, cells array<int>, turned array<double>"
    ordered = classes.select("id", "label", "size", "embedding").mapInArrow(project, schema)
    # The order ends in the exact place, so that a crowded cell can be dealt to several tasks.
    keys = ["label", "cells", "turned", "id"]
    ordered = ordered.repartitionByRange(*keys).sortWithinPartitions(*keys)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: list[pa.RecordBatch] = []

        def intervals(last: bool) -> Iterator[pa.RecordBatch]:
            table = pa.Table.from_batches(waiting).combine_chunks()
            waiting.clear()
            labels = table["label"].to_numpy()
            borders = [0, *(np.flatnonzero(labels[1:] != labels[:-1]) + 1).tolist(), len(labels)]
            for start, end in zip(borders, borders[1:]):
                for i in range(start, end, INTERVAL):
                    j = min(i + INTERVAL, end)
                    if j == len(labels) and not last:
                        waiting.extend(table.slice(i).to_batches())
                        return
                    part = table.slice(i, j - i).combine_chunks()
                    turned = _matrix(part["turned"].combine_chunks(), leading)
                    content = [part["id"].to_numpy(), part["size"].to_numpy(), _matrix(part["embedding"].combine_chunks(), dimension), turned]
                    row = [pa.array([x], t) for x, t in (
                        (int(content[0][0]), pa.int64()), (labels[i].item(), part.schema.field("label").type),
                        (turned[0].tolist(), pa.list_(pa.float64())), (turned.min(0).tolist(), pa.list_(pa.float64())), (turned.max(0).tolist(), pa.list_(pa.float64())),
                        *[(np.ascontiguousarray(c).tobytes(), pa.binary()) for c in content])]
                    yield pa.RecordBatch.from_arrays(row, ["interval", "label", "first", "low", "high", "ids", "sizes", "vectors", "places"])

        held = 0
        for batch in batches:
            waiting.append(batch)
            held += len(batch)
            if held > 4 * INTERVAL:
                yield from intervals(False)
                held = sum(len(b) for b in waiting)
        if waiting:
            yield from intervals(True)

    blobs = "ids binary, sizes binary, vectors binary, places binary"
    cut_up = store(ordered.mapInArrow(cut, f"interval bigint, label {label}, first array<double>, low array<double>, high array<double>, {blobs}"))

    # Boxes alone tell which intervals may hold links: first those of FAN intervals that
    # follow each other, then those of the intervals below pairs that are near.
    sequence = Window.partitionBy("label").orderBy("first", "interval")
    boxes = cut_up.select("interval", "label", "low", "high", "first")
    boxes = boxes.withColumn("above", F.floor((F.row_number().over(sequence) - 1) / FAN)).drop("first")
    above = boxes.groupBy("label", "above").agg(
        F.array(*[F.min(F.col("low")[i]) for i in range(leading)]).alias("low"),
        F.array(*[F.max(F.col("high")[i]) for i in range(leading)]).alias("high"),
    )

    def near(x: str, y: str) -> Column:
        total = F.lit(0.0)
        for i in range(leading):
            gap = F.greatest(
                F.lit(0.0),
                F.col(f"{x}.low")[i] - F.col(f"{y}.high")[i],
                F.col(f"{y}.low")[i] - F.col(f"{x}.high")[i],
            )
            total = total + gap * gap
        return total <= epsilon * epsilon

    tops = above.alias("x").join(above.alias("y"), (F.col("x.label") == F.col("y.label")) & near("x", "y"))
    tops = tops.select(F.col("x.label").alias("of"), F.col("x.above").alias("p"), F.col("y.above").alias("q"))
    first = boxes.alias("b").join(tops, (F.col("b.label") == F.col("of")) & (F.col("b.above") == F.col("p"))).select("b.*", "q")
    same_label = (F.col("x.label") == F.col("y.label")) & (F.col("x.q") == F.col("y.above"))
    pairs = first.alias("x").join(boxes.alias("y"), same_label & (F.col("x.interval") <= F.col("y.interval")) & near("x", "y"))
    pairs = pairs.select(F.col("x.interval").alias("p"), F.col("y.interval").alias("q"))

    def named(side: str) -> DataFrame:
        return cut_up.select(F.col("interval").alias(side), *[F.col(c).alias(f"{c}_{side}") for c in ("ids", "sizes", "vectors", "places")])

    met = pairs.join(named("p"), "p").join(named("q"), "q")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                a = _Interval(row["ids_p"], row["sizes_p"], row["vectors_p"], row["places_p"], dimension)
                same = row["p"] == row["q"]
                b = a if same else _Interval(row["ids_q"], row["sizes_q"], row["vectors_q"], row["places_q"], dimension)
                left, right = _join(a, b, same, cosine, epsilon * epsilon)
                if not len(left):
                    continue
                ids = a.ids if same else np.concatenate([a.ids, b.ids])
                right_at = right if same else right + len(a.ids)
                counts = np.bincount(left, b.sizes[right], len(ids)).astype(np.int64)
                counts += np.bincount(right_at, a.sizes[left], len(ids)).astype(np.int64)
                child, parent = _forest(left, right_at, len(ids))
                some = np.flatnonzero(counts)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.concatenate([ids[child], ids[some]])),
                        pa.array([*ids[parent].tolist(), *[None] * len(some)], pa.int64()),
                        pa.array([*[None] * len(child), *counts[some].tolist()], pa.int64()),
                    ],
                    ["a", "b", "n"],
                )

    return met.mapInArrow(compare, "a bigint, b bigint, n bigint")


def near_duplicates(vectors: DataFrame, key: str = "vec_id", embedding: str = "embedding", label: str = "label", cosine: float = COSINE) -> DataFrame:
    """One row per vector: ``key``, ``n_links``, ``component_id`` and ``kept``.

    Vectors link if their labels are equal and their cosine is at least ``cosine``. Those
    that are null or zero, hold a null or a number that is not finite, or have no label
    link with nothing, and neither do vectors of different dimensions. A row without a
    link is its own component. Rows with a null key count as links and are never kept;
    their component is the smallest key reachable, null if there is none.
    """
    rows = vectors.select(F.col(key).cast("bigint").alias("key"), F.col(label).alias("label"), F.col(embedding).alias("embedding"))
    rows = rows.withColumn("usable", _usable(F.col("embedding"), F.col("label")))
    grouped = rows.filter("usable").groupBy("label", "embedding").agg(F.min("key").alias("least"), F.count("*").alias("size"))
    # The number of a class is fixed once it is stored.
    classes = store(grouped.withColumn("id", F.monotonically_increasing_id()))
    ends = vectors.sparkSession.createDataFrame([], "a bigint, b bigint, n bigint")
    for (dimension,) in classes.select(F.size("embedding")).distinct().collect():
        ends = ends.unionAll(linked(classes.filter(F.size("embedding") == dimension), cosine))
    ends = store(ends)
    roots = components(ends.filter("b is not null").select("a", "b"))
    counts = ends.filter("n is not null").groupBy("a").agg(F.sum("n").alias("n"))
    known = classes.join(roots, F.col("id") == F.col("node"), "left").join(counts, F.col("id") == F.col("a"), "left")
    known = known.select(
        "label", "embedding", "least", F.coalesce("root", "id").alias("root"), (F.coalesce("n", F.lit(0)) + F.col("size") - 1).alias("n_links")
    )
    smallest = known.groupBy("root").agg(F.min("least").alias("component"))
    known = known.join(smallest, "root").select("label", "embedding", "n_links", "component")
    same = (F.col("r.label") == F.col("k.label")) & (F.col("r.embedding") == F.col("k.embedding")) & F.col("r.usable")
    joined = rows.alias("r").join(known.alias("k"), same, "left")
    component = F.coalesce(F.col("k.component"), F.col("r.key"))
    return joined.select(
        F.col("r.key").alias(key),
        F.coalesce(F.col("k.n_links"), F.lit(0)).cast("bigint").alias("n_links"),
        component.alias("component_id"),
        F.coalesce(F.col("r.key") == component, F.lit(False)).alias("kept"),
    )
