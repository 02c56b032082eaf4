"""Hashtag statistics."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from opinionlens import constants as K
from opinionlens.functions import tokens as tk
from opinionlens.functions import values as v
from opinionlens.operators.posts import labelled


def tag_rows(posts: DataFrame, *keep: str) -> DataFrame:
    """One row per hashtag occurrence, lower-cased and led by ``#``."""
    pieces = posts.select(*keep, F.explode(tk.tag_pieces("hashtags")).alias("piece"))
    pieces = pieces.withColumn("piece", F.trim("piece")).filter(F.length("piece") > 1)
    return pieces.select(*keep, tk.as_tag("piece").alias("hashtag"))


def top_hashtags(posts: DataFrame, top_n: int = K.TOP_N) -> DataFrame:
    return (
        tag_rows(posts)
        .groupBy("hashtag")
        .agg(F.count("*").alias("count"))
        .orderBy(F.desc("count"), "hashtag")
        .limit(top_n)
    )


def distinctive_hashtags(
    posts: DataFrame, min_count: int = K.MIN_TAG_COUNT, top_n: int = K.TOP_N
) -> DataFrame:
    """Hashtags that lean to one class among labelled posts, strongest first.

    The dominant class follows the *rounded* score, so a lean below 0.00005 is balanced.
    """
    score = F.col("orientation_score")
    return (
        tag_rows(labelled(posts), "binary_label")
        .groupBy("hashtag")
        .agg(
            F.count("*").alias("total_count"),
            F.count_if(F.col("binary_label") == 1).alias("pos_count"),
            F.count_if(F.col("binary_label") == 0).alias("neg_count"),
        )
        .filter(F.col("total_count") >= min_count)
        .withColumns(
            {
                "pos_share": v.share("pos_count", "total_count"),
                "neg_share": v.share("neg_count", "total_count"),
                "orientation_score": v.share(F.col("pos_count") - F.col("neg_count"), "total_count"),
            }
        )
        .withColumns(
            {
                "distinctiveness_score": F.abs(score),
                "dominant_orientation": v.orientation(score, F.lit(0.0)),
            }
        )
        .orderBy(F.desc("distinctiveness_score"), F.desc("total_count"), "hashtag")
        .limit(top_n)
    )


def tag_extremes(distinctive: DataFrame, n: int = 15) -> DataFrame:
    """The ``n`` most positive and the ``n`` most negative hashtags."""
    score = F.col("orientation_score")
    ties = [F.desc("total_count"), F.col("hashtag")]
    lowest = distinctive.filter(score < 0).orderBy(score.asc(), *ties).limit(n)
    highest = distinctive.filter(score > 0).orderBy(score.desc(), *ties).limit(n)
    return lowest.unionByName(highest)
