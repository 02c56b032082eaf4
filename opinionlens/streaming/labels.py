"""Resumable labelling as an available-now stream."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from opinionlens.operators.labeling import PredictBatch, label_posts


def label_new_files(
    spark: SparkSession,
    source_dir: str,
    schema: T.StructType,
    out_dir: str,
    checkpoint_dir: str,
    predict_batch: PredictBatch | None = None,
    *,
    prepare: Callable[[DataFrame], DataFrame] | None = None,
    max_files_per_batch: int = 1000,
    file_format: str = "parquet",
    **options,
) -> None:
    """Label the files that have arrived since the last run and append the result.

    Progress is kept after every batch of ``max_files_per_batch`` files; a run that
    was cut short goes on where it stopped, and no post is written twice or asked
    about again once its batch is committed. A batch for which the model stays away is
    not committed: the run ends with an error, and the next one asks for it again. ``source_dir``, ``out_dir`` and
    ``checkpoint_dir`` must be reachable by all executors.
    """
    posts = _arriving(spark, source_dir, schema, prepare, max_files_per_batch, file_format)
    if predict_batch is not None:
        options.setdefault("give_up", False)
    query = (
        label_posts(posts, predict_batch, **options)
        .writeStream.format("parquet")
        .outputMode("append")
        .option("path", out_dir)
        .option("checkpointLocation", checkpoint_dir)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def _arriving(
    spark: SparkSession, source_dir: str, schema: T.StructType, prepare: Callable[[DataFrame], DataFrame] | None, max_files_per_batch: int, file_format: str
) -> DataFrame:
    posts = spark.readStream.format(file_format).schema(schema).option("maxFilesPerTrigger", max_files_per_batch).load(source_dir)
    return posts if prepare is None else prepare(posts)


# Labels lie in folders by round and batch: later rounds come before earlier ones.
ROUND, BATCH = "label_round", "label_batch"


def store_batch(labelled: DataFrame, out_dir: str, label_round: int, batch: int) -> None:
    """Write one batch of a round; if it was written before, in part or whole, it is replaced."""
    labelled.write.mode("overwrite").parquet(f"{out_dir.rstrip('/')}/{ROUND}={label_round}/{BATCH}={batch}")


def relabel_files(
    spark: SparkSession,
    source_dir: str,
    schema: T.StructType,
    out_dir: str,
    checkpoint_dir: str,
    predict_batch: PredictBatch | None = None,
    *,
    label_round: int,
    relabel: bool = True,
    prepare: Callable[[DataFrame], DataFrame] | None = None,
    max_files_per_batch: int = 1000,
    file_format: str = "parquet",
    **options,
) -> None:
    """Label the files of a folder in a new round, over labels that they have already.

    Every round has its own progress below ``checkpoint_dir`` and starts at the first file;
    the same round again goes on where it stopped and takes in new files. A batch that a
    lost driver leaves unfinished is labelled again and replaces what it had written, so
    that each post stands once in a round. With ``relabel=False`` labels that posts bring
    along are kept. :func:`latest_labels` tells what holds after all rounds.
    """
    posts = _arriving(spark, source_dir, schema, prepare, max_files_per_batch, file_format)
    if predict_batch is not None:
        options.setdefault("give_up", False)
    labelled = label_posts(posts, predict_batch, relabel=relabel, **options)
    query = (
        labelled.writeStream.foreachBatch(lambda batch, number: store_batch(batch, out_dir, label_round, number))
        .option("checkpointLocation", f"{checkpoint_dir.rstrip('/')}/{ROUND}={label_round}")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


SETTLED = ("kept", "rule", "model", "neutral")


def latest_labels(spark: SparkSession, out_dir: str, key: str | Sequence[str], settled: Sequence[str] = SETTLED) -> DataFrame:
    """Each post once, with the label of the last round that settled it, else of the last one at all.

    Rows are compared per task before they are exchanged by key. Of rows of one round the
    last batch counts; two rows of one key in a batch are one post, and its smallest label holds.
    """
    rows = spark.read.parquet(out_dir)
    keys = [key] if isinstance(key, str) else list(key)
    rest = [c for c in rows.columns if c not in (*keys, ROUND, BATCH)]
    order = F.struct(
        F.coalesce(F.col("label_status").isin(list(settled)), F.lit(False)).alias("settled"), ROUND, BATCH, (-F.col("binary_label")).alias("least")
    )
    best = rows.groupBy(*keys).agg(F.max_by(F.struct(*rest), order).alias("post"))
    return best.select(*keys, "post.*")
