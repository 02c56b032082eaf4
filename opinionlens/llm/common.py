"""Helpers shared by the operators: Arrow columns from texts, and stored tables."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructField, StructType

from opinionlens.session import shared_dir

# Texts are worked on in slices of about this many bytes, whatever the Arrow batch
# holds, so that a task's memory depends on neither batch nor table.
SLICE_BYTES = 2 << 20


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def store(df: DataFrame) -> DataFrame:
    """``df`` written below the shared folder and read again: its lineage ends here."""
    path = shared_dir(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def small_batches(spark: SparkSession) -> None:
    """Let Arrow batches hold fewer rows, unless the session has a number of its own.

    Spark fills a batch by rows, whatever their texts hold; ten thousand texts of a web
    page each do not fit beside each other in a small executor.
    """
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if spark.conf.get(name) == "10000":
        spark.conf.set(name, "1000")


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts of a column in one array, and n + 1 offsets. Null is empty."""
    column = pc.fill_null(column, "") if column.null_count else column
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, starts, data = column.buffers()
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(starts, np.int64 if wide else np.int32)
    offsets = offsets[column.offset : column.offset + len(column) + 1].astype(np.int64)
    content = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return content[offsets[0] : offsets[-1]], offsets - offsets[0]


def slices(column: pa.Array, most_bytes: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of rows whose texts hold up to ``most_bytes``; a longer text is alone."""
    _, offsets = utf8(column)
    start, rows = 0, len(column)
    while start < rows:
        end = int(np.searchsorted(offsets, offsets[start] + most_bytes, "right")) - 1
        end = min(max(end, start + 1), rows)
        yield start, end
        start = end


def others(df: DataFrame, names: Sequence[str]) -> list[str]:
    """The columns of ``df`` that are not called like one of ``names``."""
    taken = {n.lower() for n in names}
    return [c for c in df.columns if c.lower() not in taken]


def add_from_text(
    df: DataFrame,
    fields: Sequence[StructField],
    factory: Callable[[], Callable[[pa.Array], Sequence[pa.Array]]],
    text: str = "text",
    most_bytes: int = SLICE_BYTES,
) -> DataFrame:
    """``df`` and columns computed from its text column, slice by slice.

    ``factory`` is called once in each task and returns a function from the texts of a
    slice to the new columns. An input column called like a new one is replaced.
    """
    small_batches(df.sparkSession)
    kept = others(df, [f.name for f in fields])
    schema = StructType([StructField(f.name, f.dataType) for f in [*df.select(*kept).schema, *fields]])
    wanted = df.select(*kept, df[text].cast("string").alias("__text"))
    names = [f.name for f in schema]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        compute = factory()
        for batch in batches:
            texts = batch.column(len(kept))
            for start, end in slices(texts, most_bytes):
                part = batch.slice(start, end - start)
                new = compute(part.column(len(kept)))
                yield pa.RecordBatch.from_arrays([*part.columns[: len(kept)], *new], names=names)

    return wanted.mapInArrow(run, schema)
