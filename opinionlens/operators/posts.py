"""Cleaning of raw posts and normalisation of cleaned ones."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from opinionlens import constants as K
from opinionlens.functions import text as tx
from opinionlens.functions import values as v
from opinionlens.schema import CLEAN_COLUMNS, require_columns


def clean_posts(
    raw: DataFrame,
    *,
    file_name: str | None = None,
    states: Mapping[str, str] | None = None,
    drop_blank: bool = True,
) -> DataFrame:
    """Clean a raw export: repaired text without tags, URLs and emoji, tags in a column
    of their own right after ``text``, cleaned user fields, state from ``file_name``.

    A narrow job: no shuffle. Each step is a projection of its own, so that a step
    which reads its input several times does not repeat the one before it.
    """
    require_columns(raw, ["text"], "raw posts")
    posts = raw.withColumnRenamed("Extracted_Location", "city").drop("location_raw", "hashtags")
    if file_name is not None:
        posts = posts.withColumn("state", v.state_from_name(file_name, states)).drop(file_name)
    order = [c for name in posts.columns for c in ([name, "hashtags"] if name == "text" else [name])]

    posts = posts.withColumn("text", F.coalesce(F.col("text").cast("string"), F.lit("")))
    posts = posts.withColumn("text", tx.repair_text("text"))
    posts = posts.withColumns(
        {"text": tx.delete_tags("text"), "hashtags": F.array_join(tx.extract_tags("text"), ";")}
    )
    posts = posts.withColumn("text", tx.repair_text("text"))

    cleaned = {"text": tx.strip_noise("text")}
    if "username" in posts.columns:
        cleaned["username"] = tx.clean_username("username")
    if "description" in posts.columns:
        cleaned["description"] = tx.clean_description("description")
    posts = posts.withColumns(cleaned)
    if drop_blank:
        # A filter on the cleaned text would be pushed below these steps and so make
        # every row go through them twice; a generator stays where it is.
        posts = posts.withColumn("text", F.explode(F.array_remove(F.array("text"), "")))
    return posts.select(*order)


def normalize_posts(posts: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Typed clean posts: null texts empty, blank places "Unknown", unparsable dates
    and labels null. ``keep`` names extra columns to carry along."""
    require_columns(posts, [c for c in CLEAN_COLUMNS if c != "binary_label"], "clean posts")
    label = v.label_value("binary_label") if "binary_label" in posts.columns else F.lit(None).cast("int")
    return posts.select(
        *keep,
        F.col("user_id").cast("string").alias("user_id"),
        F.col("username").cast("string").alias("username"),
        *[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("description", "text", "hashtags")],
        v.date_value("date").alias("date"),
        v.place_or_unknown("city").alias("city"),
        v.place_or_unknown("state").alias("state"),
        label.alias("binary_label"),
    )


def labelled(posts: DataFrame) -> DataFrame:
    """Posts of one of the two classes."""
    return posts.filter(F.col("binary_label").isin(0, 1))


def filter_states(df: DataFrame, states: Sequence[str] | None) -> DataFrame:
    """Keep the named states; everything where there is no such column or no name."""
    if not states or "state" not in df.columns:
        return df
    return df.filter(F.col("state").isin(list(states)))


def with_state_code(df: DataFrame, codes: Mapping[str, str] | None = None, drop_unknown: bool = False) -> DataFrame:
    df = df.withColumn("state_code", v.lookup("state", K.STATE_CODES if codes is None else codes))
    return df.dropna(subset=["state_code"]) if drop_unknown else df


def label_coverage(posts: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Posts and labelled posts, overall or per group."""
    return posts.groupBy(*by).agg(
        F.count("*").alias("total_posts"), F.count("binary_label").alias("labelled_posts")
    )
