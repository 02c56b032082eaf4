"""Result tables: where they lie, how they are written and read back."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from opinionlens.operators.posts import with_state_code

# Result name -> (folder of its query, columns).
RESULTS: dict[str, tuple[str, str]] = {
    "geo_distribution": ("geo_distribution", "state string, city string, tweet_count bigint, unique_users bigint"),
    "temporal_evolution": (
        "temporal_evolution",
        "date date, state string, tweet_count bigint, pos bigint, neg bigint, unclear bigint",
    ),
    "top_hashtags": ("top_hashtags", "hashtag string, count bigint"),
    "frequent_words": ("frequent_words", "word string, count bigint"),
    "distinctive_hashtags": (
        "distinctive_hashtags",
        "hashtag string, total_count bigint, pos_count bigint, neg_count bigint, pos_share double, "
        "neg_share double, orientation_score double, distinctiveness_score double, dominant_orientation string",
    ),
    "keyword_comparison": (
        "keyword_comparison",
        "state string, tweet_count bigint, a_mentions bigint, b_mentions bigint, only_a bigint, only_b bigint, "
        "both bigint, a_share double, b_share double",
    ),
    "word_cooccurrence": ("word_cooccurrence", "word_a string, word_b string, count bigint"),
    "polarization_city": (
        "polarization_city",
        "state string, city string, classified_users bigint, pos_users bigint, neg_users bigint, "
        "balanced_users bigint, classified_tweets bigint, pos_tweets bigint, neg_tweets bigint, "
        "pos_user_share double, neg_user_share double, balanced_user_share double, "
        "user_polarization_score double, dominant_user_orientation string",
    ),
    "cluster_summary": (
        "topic_clusters",
        "cluster int, tweet_count bigint, pos bigint, neg bigint, unclear bigint, pos_share double, neg_share double",
    ),
    "cluster_terms": ("topic_clusters", "cluster int, word string, count bigint, rank int"),
    "metrics": ("stance_classifier", "metric string, value double"),
    "confusion_matrix": ("stance_classifier", "label double, prediction double, count bigint"),
}


# The order in which a result is stored. Operators leave their rows unsorted, as others may
# read them; sorting is the sink's work.
ORDERS: dict[str, list[str]] = {
    "geo_distribution": ["tweet_count desc", "state", "city"],
    "temporal_evolution": ["date", "state"],
    "keyword_comparison": ["state"],
    "polarization_city": ["user_polarization_score desc", "classified_users desc", "state", "city"],
}


def in_order(df: DataFrame, name: str) -> DataFrame:
    """The rows of a result in the order of its stored form."""
    return df.orderBy(*[F.expr(c) if " " not in c else F.desc(c.split()[0]) for c in ORDERS[name]]) if name in ORDERS else df


def result_path(out_dir: str, name: str) -> str:
    folder, _ = RESULTS[name]
    return f"{out_dir.rstrip('/')}/{folder}/{name}"


def write_result(df: DataFrame, out_dir: str, name: str, file_format: str = "csv") -> str:
    """Replace one stored result. Tasks write their own parts; nulls become empty fields."""
    path = result_path(out_dir, name)
    writer = in_order(df, name).write.mode("overwrite").format(file_format)
    if file_format == "csv":
        writer = writer.option("header", True).option("emptyValue", "").option("quote", '"').option("escape", '"')
    writer.save(path)
    return path


def read_result(spark: SparkSession, out_dir: str, name: str, file_format: str = "csv") -> DataFrame:
    """A stored result with its declared columns, empty where it was never written."""
    schema = T.StructType.fromDDL(RESULTS[name][1])
    raw = schema
    if file_format == "csv":
        # Dates are cast below, so that an unreadable one is null and no error.
        raw = T.StructType([T.StructField(f.name, T.StringType() if f.name == "date" else f.dataType) for f in schema])
    reader = spark.read.schema(raw).format(file_format)
    if file_format == "csv":
        reader = reader.option("header", True).option("quote", '"').option("escape", '"')
    try:
        df = reader.load(result_path(out_dir, name))
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)
    return df.withColumn("date", F.col("date").try_cast("date")) if "date" in df.columns else df


def load_results(
    spark: SparkSession, out_dir: str, codes: Mapping[str, str] | None = None, file_format: str = "csv"
) -> dict[str, DataFrame]:
    """All results; those by state also get the state code."""
    tables = {name: read_result(spark, out_dir, name, file_format) for name in RESULTS}
    return {n: with_state_code(t, codes) if "state" in t.columns else t for n, t in tables.items()}


def available_results(tables: Mapping[str, DataFrame]) -> list[str]:
    return [name for name, table in tables.items() if not table.isEmpty()]
