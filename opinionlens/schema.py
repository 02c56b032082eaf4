"""Schemas of the logical tables and the required-column check."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import types as T

CLEAN_POST = T.StructType(
    [
        T.StructField("user_id", T.StringType()),
        T.StructField("username", T.StringType()),
        T.StructField("description", T.StringType()),
        T.StructField("text", T.StringType()),
        T.StructField("hashtags", T.StringType()),
        T.StructField("date", T.DateType()),
        T.StructField("city", T.StringType()),
        T.StructField("state", T.StringType()),
        T.StructField("binary_label", T.IntegerType()),
    ]
)

CLEAN_COLUMNS = CLEAN_POST.fieldNames()


def require_columns(df: DataFrame, required: Iterable[str], where: str = "input") -> DataFrame:
    """Return ``df`` unchanged, or raise naming the missing and the available columns."""
    missing = [name for name in required if name not in df.columns]
    if missing:
        raise ValueError(f"{where}: missing columns {missing}; available columns: {df.columns}")
    return df
