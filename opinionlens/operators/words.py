"""Word statistics: frequency, co-occurrence, top terms per group, document frequency."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from opinionlens import constants as K
from opinionlens.functions import tokens as tk


def add_tokens(posts: DataFrame, stops: Iterable[str] | None = None) -> DataFrame:
    """Posts with the array column ``words``."""
    return posts.withColumn("words", tk.tokens("text", stops))


def _words(posts: DataFrame) -> Column:
    """The column ``words`` where a frame has one already, else the words of its text."""
    return F.col("words") if "words" in posts.columns else tk.raw_words("text")


def _drop_stops(rows: DataFrame, stops: Iterable[str] | None) -> DataFrame:
    stops = tk.stop_words() if stops is None else tk.possible_words(stops)
    # Letters only, so the list can be given as SQL text: one call, not one per word.
    return rows.filter("word not in ('" + "', '".join(stops) + "')") if stops else rows


def word_rows(posts: DataFrame, *keep: str, stops: Iterable[str] | None = None) -> DataFrame:
    """One row per word occurrence.

    Words are filtered after the explode, where the stop-word test is compiled
    code, and not inside an array lambda.
    """
    return _drop_stops(posts.select(*keep, F.explode(_words(posts)).alias("word")), stops)


def word_counts(posts: DataFrame, stops: Iterable[str] | None = None) -> DataFrame:
    return word_rows(posts, stops=stops).groupBy("word").agg(F.count("*").alias("count"))


def frequent_words(posts: DataFrame, top_n: int = K.TOP_N, stops: Iterable[str] | None = None) -> DataFrame:
    return word_counts(posts, stops).orderBy(F.desc("count"), "word").limit(top_n)


def word_cooccurrence(
    posts: DataFrame,
    top_n_words: int = K.COOCCURRENCE_WORDS,
    top_n_pairs: int = K.COOCCURRENCE_PAIRS,
    stops: Iterable[str] | None = None,
) -> DataFrame:
    """Pairs of the most frequent words by the number of posts that hold both.

    The word list is a scalar subquery of at most ``top_n_words`` entries, so posts
    are neither joined nor shuffled: each task reduces a post to its frequent words,
    emits their ordered pairs and counts them before the only exchange, which carries
    at most ``top_n_words * (top_n_words - 1) / 2`` rows per task.
    """
    top = frequent_words(posts, top_n_words, stops).agg(F.sort_array(F.collect_list("word")))
    # Intersecting in the order of the sorted list leaves the result sorted and distinct.
    present = posts.select(F.array_intersect(top.scalar(), _words(posts)).alias("present"))
    size = F.size("present")
    leading = F.slice("present", 1, F.greatest(size - 1, F.lit(0)))
    firsts = present.select("present", F.posexplode(leading).alias("pos", "word_a"))
    rest = F.slice("present", F.col("pos") + 2, size)
    return (
        firsts.select("word_a", F.explode(rest).alias("word_b"))
        .groupBy("word_a", "word_b")
        .agg(F.count("*").alias("count"))
        .orderBy(F.desc("count"), "word_a", "word_b")
        .limit(top_n_pairs)
    )


def group_top_terms(
    posts: DataFrame, group: str, n: int = K.TERMS_PER_CLUSTER, stops: Iterable[str] | None = None
) -> DataFrame:
    """The ``n`` most frequent words of each group, ranked.

    Words are counted per (group, word) first and each task keeps only its own best
    ``n`` per group, so a group holding a third of all posts is no hot spot.
    """
    counts = word_rows(posts, group, stops=stops).groupBy(group, "word").agg(F.count("*").alias("count"))
    return rank_terms(counts, group, n)


def rank_terms(counts: DataFrame, group: str, n: int = K.TERMS_PER_CLUSTER) -> DataFrame:
    by_count = Window.partitionBy(group).orderBy(F.desc("count"), "word")
    return (
        counts.withColumn("rank", F.row_number().over(by_count))
        .filter(F.col("rank") <= n)
        .orderBy(group, "rank")
    )


def tfidf_terms(
    posts: DataFrame,
    vocab_size: int = K.VOCAB_SIZE,
    min_df: float = K.MIN_DF,
    max_df: float = K.MAX_DF,
    stops: Iterable[str] | None = None,
) -> DataFrame:
    """The vocabulary with term count, document count and inverse document frequency.

    Limits below 1 are fractions of all posts. Sorting the words of a post brings
    repeats together, so one pass tells first occurrences from repeats and a single
    exchange by word yields both counts.
    """
    total = posts.agg(F.count("*"))
    ordered = posts.select(F.sort_array(_words(posts)).alias("words"))
    # The slice is the whole array: exploding the column itself would make Spark infer
    # a filter on it and push that, with the work it repeats, below the sort.
    every = F.slice("words", 1, F.size("words"))
    rows = ordered.select("words", F.posexplode(every).alias("pos", "word"))
    is_first = ~F.equal_null("word", F.get("words", F.col("pos") - 1))
    rows = rows.select("word", is_first.alias("first"))
    counts = (
        _drop_stops(rows, stops)
        .groupBy("word")
        .agg(F.count("*").alias("term_count"), F.count_if("first").alias("doc_count"))
        .withColumn("n", total.scalar())
    )

    def limit(value: float):
        return F.lit(float(value)) * (F.col("n") if value < 1 else F.lit(1))

    kept = counts.filter((F.col("doc_count") >= limit(min_df)) & (F.col("doc_count") <= limit(max_df)))
    return (
        kept.orderBy(F.desc("term_count"), "word")
        .limit(vocab_size)
        .select("word", "term_count", "doc_count", F.log((F.col("n") + 1) / (F.col("doc_count") + 1)).alias("idf"))
    )
