"""A linear support vector machine on hashed words, with gradients that stay sparse.

Words fall into signed buckets by MD5, which every engine has. A pass over the posts sends,
per task, one row for each bucket that the task has touched, added up by bucket; the
driver holds vectors of ``size`` numbers, whatever the number of posts. The step along a
direction is chosen in one more pass, as losses of many steps are summed up at once.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator, Sequence
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from opinionlens import constants as K
from opinionlens.functions.text import ColumnOrName, column
from opinionlens.operators.models import in_train, stance_words
from opinionlens.operators.posts import labelled
from opinionlens.session import discard, materialize

# Functions that run in tasks are shipped by value: executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

STEPS = 2.0 ** np.arange(3, -13, -1)  # along a direction, tried all at once
MEMORY = 10  # changes of point and gradient that shape a direction


def hashed_word(word: Column, size: int) -> Column:
    """The bucket of a word, counted from 1 on, with its sign: 28 bits of its MD5 tell the bucket, the next digit the sign."""
    digest = F.md5(word.cast("binary"))
    bucket = F.conv(F.substring(digest, 1, 7), 16, 10).cast("int") % size + 1
    return F.when(F.substring(digest, 8, 1) < "8", bucket).otherwise(-bucket)


def hashed_words(words: ColumnOrName, size: int = K.SVM_HASH_SIZE) -> Column:
    """The signed buckets of an array of words, in order, repeats kept."""
    return F.transform(column(words), lambda w: hashed_word(w, size))


def hashed_terms(words: DataFrame, key: str, size: int = K.SVM_HASH_SIZE) -> DataFrame:
    """``key``, ``bucket`` and ``value``: how often a post holds words of a bucket, by sign. Zeros are left out."""
    rows = words.select(key, F.explode("words").alias("word")).select(key, hashed_word(F.col("word"), size).alias("code"))
    values = rows.groupBy(key, (F.abs("code") - 1).alias("bucket")).agg(F.sum(F.signum("code")).cast("bigint").alias("value"))
    return values.filter("value != 0")


class Scales(NamedTuple):
    """For each bucket the weight of its values: inverse document frequency, and its spread over the posts."""

    idf: np.ndarray
    spread: np.ndarray
    posts: int


class Loss(NamedTuple):
    value: float
    gradient: np.ndarray
    intercept: float


def _entries(column: pa.Array, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, bucket and signed count of the values of a batch, zeros left out."""
    sizes = pc.fill_null(pc.list_value_length(column), 0).to_numpy(zero_copy_only=False)
    codes = column.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    row = np.repeat(np.arange(len(column)), sizes)
    place, back = np.unique(row * size + np.abs(codes) - 1, return_inverse=True)
    value = np.bincount(back, np.sign(codes), len(place)).astype(np.int64)
    some = value != 0
    return place[some] // size, place[some] % size, value[some]


def _gathered(rows: DataFrame, size: int, columns: Sequence[str]) -> list[np.ndarray]:
    """Sums by bucket as vectors; at most one row per bucket reaches the driver."""
    table = rows.groupBy("bucket").agg(*[F.sum(c).alias(c) for c in columns]).toArrow()
    at = table["bucket"].to_numpy()
    found = []
    for c in columns:
        own = np.zeros(size + 1)
        own[at] = table[c].to_numpy()
        found.append(own)
    return found


def scales(codes: DataFrame, size: int) -> Scales:
    """Document frequencies and spreads of the buckets, from the array column ``codes``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals, posts = np.zeros((3, size + 1)), 0
        for batch in batches:
            _, bucket, value = _entries(batch.column(0), size)
            for total, own in zip(totals, (np.ones(len(value)), value, value * value)):
                total[:size] += np.bincount(bucket, own, size)
            posts += len(batch)
        totals[0, size] = posts  # one more row than buckets: the number of posts
        some = np.flatnonzero(totals[0])
        yield pa.RecordBatch.from_arrays([pa.array(some), *[pa.array(t[some]) for t in totals]], names=["bucket", "df", "sum", "squares"])

    rows = codes.select("codes").mapInArrow(run, "bucket bigint, df double, sum double, squares double")
    df, total, squares = _gathered(rows, size, ["df", "sum", "squares"])
    posts = int(df[size])
    idf = np.log((posts + 1) / (df[:size] + 1))
    n = max(posts, 1)
    variance = np.maximum(squares[:size] - total[:size] ** 2 / n, 0) / max(posts - 1, 1)
    return Scales(idf, idf * np.sqrt(variance), posts)


def _scores(entries: tuple, rows: int, weights: np.ndarray) -> np.ndarray:
    row, bucket, value = entries
    return np.bincount(row, value * weights[bucket], rows)


def hinge_gradient(codes: DataFrame, weights: np.ndarray, intercept: float) -> DataFrame:
    """``bucket`` and ``gradient`` of the summed hinge loss, for buckets that some post within the margin has.

    ``codes`` has a ``label`` of 0 or 1 and the signed buckets; ``weights`` are those of
    plain counts. The bucket ``len(weights)`` is the intercept, the one after it the loss.
    """
    size = len(weights)
    shipped = codes.sparkSession.sparkContext.broadcast((weights, intercept))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, intercept = shipped.value
        total, touched = np.zeros(size + 2), np.zeros(size + 2, bool)
        for batch in batches:
            entries = _entries(batch.column(1), size)
            side = 2 * batch.column(0).to_numpy(zero_copy_only=False) - 1
            short = 1 - side * (_scores(entries, len(batch), own) + intercept)
            pull = np.where(short > 0, -side, 0.0)
            row, bucket, value = entries
            total[:size] += np.bincount(bucket, pull[row] * value, size)
            touched[bucket[short[row] > 0]] = True
            total[size:] += pull.sum(), short[short > 0].sum()
        touched[size:] = True
        some = np.flatnonzero(touched)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], names=["bucket", "gradient"])

    rows = codes.select(F.col("label").cast("double"), "codes").mapInArrow(run, "bucket bigint, gradient double")
    return rows.groupBy("bucket").agg(F.sum("gradient").alias("gradient"))


def _losses(codes: DataFrame, weights: np.ndarray, intercept: float, turn: np.ndarray, turn_intercept: float) -> np.ndarray:
    """The summed hinge losses of all ``STEPS`` from a point along a direction."""
    shipped = codes.sparkSession.sparkContext.broadcast((weights, intercept, turn, turn_intercept, STEPS))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, intercept, turn, turn_intercept, steps = shipped.value
        total = np.zeros(len(steps))
        for batch in batches:
            entries = _entries(batch.column(1), len(own))
            side = 2 * batch.column(0).to_numpy(zero_copy_only=False) - 1
            here = _scores(entries, len(batch), own) + intercept
            there = _scores(entries, len(batch), turn) + turn_intercept
            total += np.maximum(1 - side * (here + steps[:, None] * there), 0).sum(axis=1)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(steps))), pa.array(total)], names=["step", "loss"])

    rows = codes.select(F.col("label").cast("double"), "codes").mapInArrow(run, "step bigint, loss double")
    return np.array([r["loss"] for r in rows.groupBy("step").agg(F.sum("loss").alias("loss")).orderBy("step").collect()])


class Machine(NamedTuple):
    """Weights of plain counts, and the objective after each iteration."""

    weights: np.ndarray
    intercept: float
    objectives: list[float]


def _direction(gradient: np.ndarray, changes: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """The quasi-Newton direction of the last changes of point and gradient."""
    turn, parts = -gradient, []
    for s, y in reversed(changes):
        a = (s @ turn) / (s @ y)
        turn = turn - a * y
        parts.append(a)
    if changes:
        s, y = changes[-1]
        turn = turn * ((s @ y) / (y @ y))
    for (s, y), a in zip(changes, reversed(parts)):
        turn = turn + (a - (y @ turn) / (s @ y)) * s
    return turn


def fit_machine(codes: DataFrame, size: int, reg: float = K.SVM_REG, max_iter: int = K.SVM_MAX_ITER, tolerance: float = 1e-6) -> Machine:
    """The machine of least mean hinge loss and ``reg / 2`` times the squared weights.

    Features are counts by bucket times their inverse document frequency, and weights count
    as those of features divided by their spread over the posts; buckets without spread
    have none. Each iteration takes two passes over ``codes``.
    """
    known = scales(codes, size)
    if not known.posts:
        raise ValueError("there are no posts to learn from")
    factor = np.divide(known.idf, known.spread, out=np.zeros(size), where=known.spread > 0)
    point = np.zeros(size + 1)
    changes: list[tuple[np.ndarray, np.ndarray]] = []
    last: tuple[np.ndarray, np.ndarray] | None = None
    objectives: list[float] = []
    for _ in range(max_iter):
        total = _gathered(hinge_gradient(codes, point[:size] * factor, point[size]).select("bucket", "gradient"), size + 1, ["gradient"])[0]
        gradient = np.append(total[:size] * factor, total[size]) / known.posts
        gradient[:size] += reg * point[:size]
        objective = total[size + 1] / known.posts + reg / 2 * point[:size] @ point[:size]
        objectives.append(float(objective))
        if len(objectives) > 1 and objectives[-2] - objectives[-1] <= tolerance * max(abs(objectives[-2]), 1):
            break
        if last is not None:
            s, y = point - last[0], gradient - last[1]
            if s @ y > 1e-12 * (y @ y):
                changes = [*changes[1 - MEMORY :], (s, y)]
        last = point, gradient
        turn = _direction(gradient, changes)
        if turn @ gradient >= 0:
            changes, turn = [], -gradient
        moved = point[:size] + STEPS[:, None] * turn[:size]
        found = _losses(codes, point[:size] * factor, point[size], turn[:size] * factor, turn[size]) / known.posts + reg / 2 * (moved * moved).sum(axis=1)
        best = int(found.argmin())
        if found[best] >= objective:
            break
        point = point + STEPS[best] * turn
    return Machine(point[:size] * factor, float(point[size]), objectives)


def predict(codes: DataFrame, machine: Machine, keep: Sequence[str] = ("label",)) -> DataFrame:
    """The ``keep`` columns, the ``score`` and the ``prediction`` of each post."""
    schema = StructType([*codes.select(*keep).schema, StructField("score", DoubleType()), StructField("prediction", DoubleType())])
    shipped = codes.sparkSession.sparkContext.broadcast((machine.weights, machine.intercept))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights, intercept = shipped.value
        for batch in batches:
            score = _scores(_entries(batch.column(len(keep)), len(weights)), len(batch), weights) + intercept
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(keep)], pa.array(score), pa.array((score > 0).astype(float))], names=schema.names)

    return codes.select(*keep, "codes").mapInArrow(run, schema)


class StanceMachine(NamedTuple):
    machine: Machine
    train_rows: int
    predictions: DataFrame


def fit_stance_machine(
    posts: DataFrame, features: Sequence[str] = K.SVM_FEATURES, *, keys: Sequence[str] | None = None, size: int = K.SVM_HASH_SIZE,
    reg: float = K.SVM_REG, max_iter: int = K.SVM_MAX_ITER,
) -> StanceMachine:
    """The classifier of labelled posts, with predictions for the held-out part.

    ``keys`` name the columns that identify a post for the split; by default its author,
    date and features do. The buckets of the training part are stored while the fit lasts.
    """
    keys = list(keys or dict.fromkeys(["user_id", "date", *features]))
    words = stance_words(labelled(posts).withColumn("in_train", in_train(keys)), features, keep=["in_train"])
    codes = words.select("in_train", "label", hashed_words("words", size).alias("codes"))
    table = materialize(codes.filter("in_train").select("label", "codes"))
    machine = fit_machine(table, size, reg, max_iter)
    rows = table.count()
    discard(table)
    return StanceMachine(machine, rows, predict(codes.filter("not in_train"), machine))
