"""Comparison of two subjects by keyword."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from opinionlens import constants as K
from opinionlens.functions import text as tx
from opinionlens.functions import values as v


def keyword_flags(
    posts: DataFrame,
    keywords_a: Sequence[str] = K.KEYWORDS_A,
    keywords_b: Sequence[str] = K.KEYWORDS_B,
    keep: Sequence[str] = (),
) -> DataFrame:
    """Whether text or hashtags of a post name either subject, as 0 / 1."""
    both_fields = F.concat_ws(" ", "text", "hashtags")
    return posts.select(
        *keep,
        tx.mentions(both_fields, keywords_a).cast("int").alias("mentions_a"),
        tx.mentions(both_fields, keywords_b).cast("int").alias("mentions_b"),
    )


def keyword_comparison(
    posts: DataFrame,
    keywords_a: Sequence[str] = K.KEYWORDS_A,
    keywords_b: Sequence[str] = K.KEYWORDS_B,
) -> DataFrame:
    """Posts per state that name A, B, only one of them or both.

    Posts are first counted per (state, flag pair), so each is matched once and
    at most four rows per state and task are exchanged.
    """
    groups = (
        keyword_flags(posts, keywords_a, keywords_b, keep=["state"])
        .groupBy("state", "mentions_a", "mentions_b")
        .agg(F.count("*").alias("n"))
    )
    a, b = F.col("mentions_a"), F.col("mentions_b")

    def posts_where(condition):
        return F.sum(F.when(condition, F.col("n")).otherwise(0))

    return (
        groups.groupBy("state")
        .agg(
            F.sum("n").alias("tweet_count"),
            posts_where(a == 1).alias("a_mentions"),
            posts_where(b == 1).alias("b_mentions"),
            posts_where((a == 1) & (b == 0)).alias("only_a"),
            posts_where((a == 0) & (b == 1)).alias("only_b"),
            posts_where((a == 1) & (b == 1)).alias("both"),
        )
        .withColumns(
            {"a_share": v.share("a_mentions", "tweet_count"), "b_share": v.share("b_mentions", "tweet_count")}
        )
    )
