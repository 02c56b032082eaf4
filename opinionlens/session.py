"""Session defaults and the shared scratch folder."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Shuffles here carry partial aggregates, so AQE may size them; nothing is fixed
# that a cluster would have to undo.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(app_name: str = "opinionlens", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULT_CONF, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """A fresh folder below the one every executor can reach.

    The cluster names it in ``spark.checkpoint.dir``; without that setting it is the
    warehouse, which executors share as well.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir")
    return f"{root.rstrip('/')}/opinionlens-{uuid.uuid4().hex}"


# Bytes of text in a file that one task writes or reads.
FILE_BYTES = 1 << 25


def files_for(rows: DataFrame, texts: Sequence[str], least: int = 1) -> int:
    """Into how many files rows go, by the bytes of their ``texts``: ``least``, and more where these outgrow a task."""
    size = F.octet_length(F.concat_ws("", *texts)).cast("bigint")
    (total,) = rows.agg(F.sum(size)).first()
    return max(least, -(-(total or 0) // FILE_BYTES))


def materialize(df: DataFrame, key: str | None = None, partitions: int = 200) -> DataFrame:
    """Store ``df`` in the shared folder and read it back.

    Iterative fits read their input many times. From a stored table they carry no
    lineage with each task and lose nothing with an executor. Files are of even size,
    whatever the input layout; with a ``key`` that is unique per row they also hold the
    same rows in the same order every time, in ``partitions`` files: choose as many as
    keep a file at some hundred megabytes. :func:`discard` removes the folder again.
    """
    path = shared_dir(df.sparkSession)
    if key is None:
        df = df.hint("rebalance")
    else:
        df = df.repartition(partitions, key).sortWithinPartitions(key)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def discard(stored: DataFrame) -> None:
    """Delete the files below a frame from :func:`materialize`, once nothing reads them any more."""
    jvm = stored.sparkSession.sparkContext._jvm
    conf = stored.sparkSession.sparkContext._jsc.hadoopConfiguration()
    for folder in {file.rpartition("/")[0] for file in stored.inputFiles()}:
        path = jvm.org.apache.hadoop.fs.Path(folder)
        if path.getName().startswith("opinionlens-"):
            path.getFileSystem(conf).delete(path, True)
