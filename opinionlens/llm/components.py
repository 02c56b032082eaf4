"""Connected components of a large graph by alternating star steps.

Every step aggregates with map-side combine and joins back on the node, so a hub with
very many links costs its links once and is never gathered in one place. Edges are
written to the shared folder after each round, which ends their lineage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from opinionlens.llm.common import store


def _large_star(edges: DataFrame) -> DataFrame:
    """Link every larger neighbour of a node to the smallest node around it."""
    both = edges.select("a", "b").unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    return both.join(least, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a != b")


def _small_star(edges: DataFrame) -> DataFrame:
    """Link every smaller neighbour of a node, and itself, to the smallest of them."""
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    moved = down.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a != b")
    return moved.unionAll(least.select("a", F.col("m").alias("b"))).distinct()


def components(edges: DataFrame) -> DataFrame:
    """``node`` and ``root`` for every end of an edge, ``root`` the smallest node reachable.

    ``edges`` has two columns of one integer type; loops, repeats and edges with a null
    end are ignored, so a node without a link to another is not in the result.
    """
    a, b = edges.columns
    current = store(
        edges.select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b"))
        .filter("a is not null and b is not null and a != b")
        .distinct()
    )
    seen = None
    while True:
        state = current.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state[0] == 0 or state == seen:
            break
        seen = state
        current = store(_small_star(_large_star(current)))
    roots = current.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return roots.unionAll(roots.select(F.col("root").alias("node"), "root").distinct())
