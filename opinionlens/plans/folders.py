"""Cleaning a folder of raw exports into a folder of cleaned ones, file by file."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from opinionlens.operators.posts import clean_posts
from opinionlens.sources.posts import FILE_NAME, input_paths, read_raw_posts

SOURCE = "source_file"
MANIFEST = "path string, modified timestamp, length bigint"


def source_files(spark: SparkSession, folder: str) -> DataFrame:
    """``path``, ``modified`` and ``length`` of the CSV files of a folder; contents are not read."""
    listed = spark.read.format("binaryFile").load(input_paths(folder))
    return listed.select("path", F.col("modificationTime").alias("modified"), "length")


def _manifest(spark: SparkSession, out_dir: str) -> DataFrame:
    try:
        return spark.read.schema(MANIFEST).parquet(f"{out_dir}/manifest")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], MANIFEST)


def clean_folder(
    spark: SparkSession, folder: str, out_dir: str, states: Mapping[str, str] | None = None, *, files_at_once: int = 1000, multiline: bool = False
) -> list[str]:
    """Clean the files of ``folder`` that are new or changed since the last run, and return their paths.

    A file counts as done once its rows are stored and the manifest in ``out_dir`` has its
    path, time and length. Each file's rows lie in a folder of their own, which a changed
    file replaces, so a run that was cut short is simply run again. ``files_at_once`` files
    are cleaned and marked as done together. Files may differ in their headers; names must
    be unique, as the rows are filed by name. A folder without files raises, like any input.
    """
    out_dir = out_dir.rstrip("/")
    files = source_files(spark, folder)
    due = files.join(_manifest(spark, out_dir), files.columns, "left_anti").orderBy("path")
    waiting = [(r["path"], r["modified"], r["length"]) for r in due.collect()]  # one row per file
    for start in range(0, len(waiting), files_at_once):
        part = waiting[start : start + files_at_once]
        raw = read_raw_posts(spark, [path for path, _, _ in part], multiline)
        cleaned = clean_posts(raw.withColumn(SOURCE, F.col(FILE_NAME)), file_name=FILE_NAME, states=states)
        writer = cleaned.hint("rebalance", SOURCE).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        writer.partitionBy(SOURCE).parquet(f"{out_dir}/posts")
        done = spark.createDataFrame(part, MANIFEST).coalesce(1)
        done.write.mode("append").parquet(f"{out_dir}/manifest")
    return [path for path, _, _ in waiting]


def read_cleaned(spark: SparkSession, out_dir: str) -> DataFrame:
    """All cleaned posts with the name of their file in ``source_file``."""
    return spark.read.option("mergeSchema", True).parquet(f"{out_dir.rstrip('/')}/posts")
