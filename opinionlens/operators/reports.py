"""Re-aggregations of the result tables for reporting."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from opinionlens.functions import values as v


def top_state(geo: DataFrame) -> DataFrame:
    """The state with most posts."""
    return (
        geo.groupBy("state")
        .agg(F.sum("tweet_count").alias("tweet_count"))
        .orderBy(F.desc("tweet_count"), "state")
        .limit(1)
    )


def geo_rollup(geo: DataFrame) -> DataFrame:
    """Totals of cities, states (``level`` 1) and everything (``level`` 3)."""
    return geo.rollup("state", "city").agg(
        F.grouping_id().alias("level"),
        F.sum("tweet_count").alias("tweet_count"),
        F.sum("unique_users").alias("unique_users_by_city_sum"),
    )


def city_ranking(geo: DataFrame, metric: str = "tweet_count", n: int = 12) -> DataFrame:
    """The ``n`` cities with the highest ``metric``, named for display."""
    return geo.orderBy(F.desc(metric), "state", "city").limit(n).withColumn("area", v.area())


def daily_volume(temporal: DataFrame) -> DataFrame:
    return temporal.groupBy("date").agg(F.sum("tweet_count").alias("tweet_count"))


def daily_state_volume(temporal: DataFrame) -> DataFrame:
    return temporal.groupBy("date", "state").agg(F.sum("tweet_count").alias("tweet_count"))


def daily_composition(temporal: DataFrame) -> DataFrame:
    """Posts of each class per day, over all states."""
    return temporal.groupBy("date").agg(*[F.sum(c).alias(c) for c in ("pos", "neg", "unclear")])


def state_mentions(comparison: DataFrame) -> DataFrame:
    return comparison.groupBy("state").agg(*[F.sum(c).alias(c) for c in ("a_mentions", "b_mentions")])


def distinct_states(tables: Iterable[DataFrame]) -> DataFrame:
    """Every state named in any of the tables."""
    columns = [t.select("state") for t in tables if "state" in t.columns]
    return reduce(DataFrame.unionByName, columns).dropna().distinct()


def label_pivot(counts: DataFrame, classes: Sequence[float] = (0, 1)) -> DataFrame:
    """(label, prediction, count) rows as a square table, 0 where a pair is absent."""
    cells = counts.groupBy("label").pivot("prediction", list(classes)).agg(F.sum("count"))
    names = [f"predicted_{int(c)}" for c in classes]
    return cells.toDF("label", *names).na.fill(0, names)
