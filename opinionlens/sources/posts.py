"""Reading exports and storing typed posts."""

from __future__ import annotations

from collections.abc import Sequence
from functools import partial, reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from opinionlens.operators.posts import normalize_posts
from opinionlens.schema import CLEAN_POST, require_columns

FILE_NAME = "file_name"


def input_paths(folder: str, files: Sequence[str] | None = None) -> list[str]:
    """The named files, relative ones within ``folder``, or every CSV file of it."""
    folder = folder.rstrip("/")
    if not files:
        return [f"{folder}/*.csv"]
    return [f if f.startswith("/") or "://" in f else f"{folder}/{f}" for f in files]


def read_csv(spark: SparkSession, path: str | Sequence[str], multiline: bool = False) -> DataFrame:
    """CSV files with one common header, every column a string.

    ``path`` may be a file, a folder, a glob or a list of them; Spark raises when
    nothing matches. Headers are checked in every file: a file with other columns, or
    the same in another order, raises instead of shifting its values. ``multiline``
    allows line breaks inside quotes, at the price of files that cannot be split.
    """
    return (
        spark.read.option("header", True)
        .option("enforceSchema", False)
        .option("quote", '"')
        .option("escape", '"')
        .option("multiLine", multiline)
        .csv(path if isinstance(path, str) else list(path))
    )


def read_posts(
    spark: SparkSession, path: str | Sequence[str], multiline: bool = False, keep: Sequence[str] = ()
) -> DataFrame:
    """Cleaned post files as typed, normalised posts."""
    return normalize_posts(read_csv(spark, path, multiline), keep)


def read_raw_posts(
    spark: SparkSession, paths: str | Sequence[str], multiline: bool = False, partitions: int | None = None
) -> DataFrame:
    """Raw exports with the name of the source file in ``file_name``.

    Each path may have a header of its own; columns missing in one are null there.
    ``multiline`` is for importing many small files: one with line breaks inside quotes
    cannot be split, so each is read by one task. ``partitions`` deals the rows out to so
    many tasks before anything is done to their text; without it nothing is shuffled.
    """
    paths = [paths] if isinstance(paths, str) else list(paths)
    if not paths:
        raise ValueError("no raw files named")
    frames = []
    for path in paths:
        frame = require_columns(read_csv(spark, path, multiline), ["text"], path)
        frames.append(frame.select("*", F.col("_metadata.file_name").alias(FILE_NAME)))
    raw = reduce(partial(DataFrame.unionByName, allowMissingColumns=True), frames)
    return raw if partitions is None else raw.repartition(partitions)


def store_posts(posts: DataFrame, path: str, rebalance: bool = True, file_format: str = "parquet") -> None:
    """Write posts partitioned by state, as Parquet or as CSV with a header.

    Rebalancing gives files of even size: adaptive execution splits a state that
    holds a large part of all posts and merges the small ones, where writing straight
    from the input would leave one file per state and task.
    """
    if rebalance:
        posts = posts.hint("rebalance", "state")
    writer = posts.write.mode("overwrite").partitionBy("state").format(file_format)
    if file_format == "csv":
        writer = (
            writer.option("header", True)
            .option("quote", '"')
            .option("escape", '"')
            .option("ignoreLeadingWhiteSpace", False)
            .option("ignoreTrailingWhiteSpace", False)
        )
    writer.save(path)


def read_stored_posts(spark: SparkSession, path: str) -> DataFrame:
    """Stored posts; filters on state prune folders, filters on labels reach the files."""
    return spark.read.schema(CLEAN_POST).parquet(path)
