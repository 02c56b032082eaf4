"""Mixing sources to target weights by weighted sampling without replacement.

Each source gets a target number of words. As often as the target holds the whole
source, every document is taken; these complete epochs come first. The rest is chosen
by Efraimidis-Spirakis sampling: documents get exponential keys scaled by their quality
weight, and the smallest keys are taken until their words reach the rest.

The sum over sorted keys is found without sorting a source: keys fall into cells of
about ``ROWS_PER_CELL`` documents, words are summed per cell with map-side combine, and
running totals go over cells of cells. Only the one cell of a source in which its rest
ends is looked into, so a source that holds most of the rows costs no more than another.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from opinionlens.llm.common import store

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (1, 2, 3)
MAX_EPOCHS = 3
SEED = 20
ROWS_PER_CELL = 1024


def n_words(text: Column | str) -> Column:
    """Words of a text as ``bigint``; a null text has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def default_quality(text: str, size: str) -> Column:
    """A weight from 0.1 to 1 that falls as the mean size of words leaves that of prose."""
    mean = F.coalesce(F.length(text), F.lit(0)) / F.greatest(F.col(size), F.lit(1))
    return F.greatest(F.lit(0.1), 1 - F.abs(mean - 6) / 12)


def _uniform(key: str, seed: int) -> Column:
    """A number in (0, 1) from the digits of a hash of the document's key."""
    digits = F.substring(F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(key).cast("string"), F.lit("")))), 1, 13)
    return (F.conv(digits, 16, 10).cast("bigint") + 0.5) / F.lit(float(1 << 52))


def sampling_key(key: str, weight: Column, seed: int = SEED) -> Column:
    return -F.log(_uniform(key, seed)) / weight


def targets(sources: DataFrame, weights: Sequence[int] = WEIGHTS, most: int = MAX_EPOCHS) -> DataFrame:
    """``source``, ``source_size``, ``target`` from one row per source.

    Sources in code point order, null last, weigh ``weights`` in turn and share the sum
    of all sizes; a source is given at most ``most`` times its size, and what it cannot
    hold goes to the others by weight. Ordered by size per weight, the sources that are
    filled are a head of the list, and the rest share evenly what these leave.
    """
    named = Window.orderBy(F.col("source").asc_nulls_last())
    turn = (F.row_number().over(named) - 1) % len(weights) + 1
    weighed = sources.withColumn("weight", F.element_at(F.array(*[F.lit(w) for w in weights]), turn.cast("int")))
    weighed = weighed.withColumn("limit", F.col("source_size") * most).withColumn("full", F.col("limit") / F.col("weight"))
    by_full = Window.orderBy("full", F.col("source").asc_nulls_last())
    before, onward = by_full.rowsBetween(Window.unboundedPreceding, -1), by_full.rowsBetween(0, Window.unboundedFollowing)
    all_rows = Window.orderBy(F.lit(0)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    left = F.sum("source_size").over(all_rows) - F.coalesce(F.sum("limit").over(before), F.lit(0))
    level = weighed.withColumn("place", F.row_number().over(by_full)).withColumn("level", left / F.sum("weight").over(onward))
    holds = F.when(F.col("level") <= F.col("full"), F.col("place"))
    shared = F.min_by("level", holds).over(all_rows)
    return level.withColumn("shared", shared).select(
        "source", "source_size", F.least(F.col("weight") * F.col("shared"), F.col("limit").cast("double")).alias("target")
    )


def _before(value: str, *groups: str, order: str) -> Column:
    window = Window.partitionBy(*groups).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    return F.coalesce(F.sum(value).over(window), F.lit(0))


@dataclass(frozen=True)
class Mix:
    """One row per source: epochs to take whole, and the last document of the rest."""

    sources: DataFrame
    seed: int

    def taken(self, docs: DataFrame) -> DataFrame:
        """``docs`` (``key``, ``source``, ``size``, ``weight``) with the source's numbers and ``taken``."""
        plan = self.sources.withColumnRenamed("source", "__of")
        joined = docs.join(plan, docs["source"].eqNullSafe(plan["__of"]), "left").drop("__of")
        here = F.struct(sampling_key("key", F.col("weight"), self.seed), F.coalesce("key", F.lit(0).cast("bigint")), "size")
        extra = F.coalesce((here <= F.col("last")), F.lit(False)).cast("bigint")
        return joined.withColumn("taken", F.col("size") * (F.col("epochs") + extra)).drop("last")


def sized(docs: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source", quality: Column | None = None) -> DataFrame:
    """``key``, ``source``, ``size`` in words and quality ``weight`` of each document.

    A weight that is null or below 0.001 counts as 0.001.
    """
    counted = docs.select(
        F.col(key).cast("bigint").alias("key"), F.col(source).cast("string").alias("source"), F.col(text).alias("__body"),
        n_words(text).alias("size"), *([] if quality is None else [quality.alias("weight")]),
    )
    if quality is None:
        counted = counted.withColumn("weight", default_quality("__body", "size"))
    floor = F.greatest(F.coalesce(F.col("weight").cast("double"), F.lit(0.0)), F.lit(0.001))
    return counted.select("key", "source", "size", floor.alias("weight"))


def plan(docs: DataFrame, weights: Sequence[int] = WEIGHTS, most: int = MAX_EPOCHS, seed: int = SEED) -> Mix:
    """The mix of ``docs`` as :func:`sized` gives them; they are read several times.

    Documents with equal keys and sizes in a source are taken or left together. Whether
    the document at the border of a rest is taken depends on which comes nearer to the
    target. The null source is a source; empty tables give an empty plan.
    """
    rows, mean = docs.agg(F.count("*"), F.avg("weight")).first()
    cells = max(1, -(-rows // ROWS_PER_CELL))
    key = sampling_key("key", F.col("weight"), seed)
    # The exponential distribution of the mean weight spreads the keys over the cells.
    spread = (F.lit(float(cells)) * (1 - F.exp(-key * F.lit(mean or 1.0)))).cast("bigint")
    dealt = docs.withColumn("draw", key).withColumn("cell", F.least(spread, F.lit(cells - 1)))
    summed = dealt.groupBy("source", "cell").agg(F.sum("size").alias("words"))
    summed = summed.withColumn("group", (F.col("cell") / ROWS_PER_CELL).cast("bigint"))
    groups = summed.groupBy("source", "group").agg(F.sum("words").alias("words"))

    goals = targets(groups.groupBy("source").agg(F.sum("words").alias("source_size")), weights, most)
    epochs = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("bigint")
    goals = goals.withColumn("epochs", epochs).withColumn("rest", F.col("target") - F.col("epochs") * F.col("source_size"))
    goals = store(goals)

    def ending(totals: DataFrame, at: str) -> DataFrame:
        """Of each source the part in which its rest ends, with the words before it."""
        return totals.filter((F.col("before") <= F.col("rest")) & (F.col("rest") < F.col("before") + F.col("words"))).select(
            F.col("source").alias("__of"), F.col(at).alias("__at"), "rest", F.col("before").alias("offset")
        )

    def within(parts: DataFrame, chosen: DataFrame, at: str) -> DataFrame:
        same = parts["source"].eqNullSafe(chosen["__of"]) & (parts[at] == chosen["__at"])
        return parts.join(chosen, same).drop("__of", "__at")

    whole = goals.select(F.col("source").alias("__of"), "rest").filter("rest > 0")
    by_group = groups.join(whole, groups["source"].eqNullSafe(whole["__of"])).drop("__of")
    by_group = ending(by_group.withColumn("before", _before("words", "source", order="group")), "group")
    by_cell = within(summed, by_group, "group")
    by_cell = ending(by_cell.withColumn("before", F.col("offset") + _before("words", "source", order="cell")), "cell")
    rank = F.struct("draw", F.coalesce("key", F.lit(0).cast("bigint")).alias("key"), "size")
    last_cell = within(dealt, by_cell, "cell").groupBy("source", "rest", "offset", rank.alias("rank"))
    ranked = last_cell.agg(F.sum("size").alias("words"))
    ranked = ranked.withColumn("before", F.col("offset") + _before("words", "source", order="rank"))
    # The first part of the cell that is left out, or else its last one, tells the border.
    taken = F.when(2 * F.col("before") + F.col("words") <= 2 * F.col("rest"), F.col("rank"))
    last = ranked.groupBy("source").agg(F.max(taken).alias("inside"), F.min("rank").alias("least"))
    # With nothing of the cell taken, the border lies just before its smallest key.
    below = F.struct(F.col("least.draw").alias("draw"), F.col("least.key").alias("key"), (F.col("least.size") - 1).alias("size"))
    last = last.select(F.col("source").alias("__of"), F.coalesce("inside", below).alias("last"))
    sources = goals.join(last, goals["source"].eqNullSafe(last["__of"]), "left")
    return Mix(store(sources.select("source", "source_size", "target", "epochs", "last")), seed)


def mix(docs: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source", quality: Column | None = None,
        weights: Sequence[int] = WEIGHTS, most: int = MAX_EPOCHS, seed: int = SEED) -> DataFrame:
    """One row per document: ``key``, ``size``, ``source_size``, ``target``, ``taken`` (words, with repeats).

    See :func:`sized`, :func:`targets` and :func:`plan`. Reruns agree, as chance comes from
    a hash of the key and ``seed``; a null key is drawn like any other.
    """
    measured = store(sized(docs, key, text, source, quality))
    found = plan(measured, weights, most, seed).taken(measured)
    return found.select(F.col("key").alias(key), "size", "source_size", "target", "taken")


def mixed_docs(docs: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source", quality: Column | None = None,
               weights: Sequence[int] = WEIGHTS, most: int = MAX_EPOCHS, seed: int = SEED) -> DataFrame:
    """The mix itself: rows of ``docs``, each as often as the mix takes it, with its own columns.

    Documents without a word add nothing to a mix and are left out.
    """
    measured = store(sized(docs, key, text, source, quality))
    found = plan(measured, weights, most, seed)
    own = F.struct(*[F.col(c) for c in docs.columns]).alias("__own")
    weight = [] if quality is None else [quality.alias("weight")]
    again = docs.select(
        own, F.col(key).cast("bigint").alias("key"), F.col(source).cast("string").alias("source"),
        F.col(text).alias("__body"), n_words(text).alias("size"), *weight,
    )
    if quality is None:
        again = again.withColumn("weight", default_quality("__body", "size"))
    floor = F.greatest(F.coalesce(F.col("weight").cast("double"), F.lit(0.0)), F.lit(0.001))
    taken = found.taken(again.select("__own", "key", "source", "size", floor.alias("weight"))).filter("taken > 0")
    copies = F.sequence(F.lit(1).cast("bigint"), (F.col("taken") / F.col("size")).cast("bigint"))
    return taken.select("__own", F.explode(copies)).select("__own.*")
