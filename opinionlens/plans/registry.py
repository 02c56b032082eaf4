"""The ten analyses by number or name, and a runner that writes their results."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence
from dataclasses import dataclass, replace

from pyspark import StorageLevel
from pyspark.sql import DataFrame

from opinionlens import constants as K
from opinionlens.operators import models, polarization, subjects, tags, volume, words
from opinionlens.sources.results import write_result
from opinionlens.sources.staging import StagedResults


@dataclass(frozen=True)
class Params:
    top_n: int = K.TOP_N
    min_tag_count: int = K.MIN_TAG_COUNT
    cooccurrence_words: int = K.COOCCURRENCE_WORDS
    cooccurrence_pairs: int = K.COOCCURRENCE_PAIRS
    min_city_users: int = K.MIN_CITY_USERS
    k: int = K.KMEANS_K
    min_df: float = K.MIN_DF
    max_df: float = K.MAX_DF
    vocab_size: int = K.VOCAB_SIZE
    seed: int = K.SEED
    svm_features: Sequence[str] = K.SVM_FEATURES
    svm_hash_size: int = K.SVM_HASH_SIZE
    svm_max_iter: int = K.SVM_MAX_ITER
    svm_reg: float = K.SVM_REG
    fit_partitions: int = models.FIT_PARTITIONS
    keywords_a: Sequence[str] = tuple(K.KEYWORDS_A)
    keywords_b: Sequence[str] = tuple(K.KEYWORDS_B)


Results = dict[str, DataFrame]
Hold = Callable[[DataFrame], DataFrame]


def _topics(posts: DataFrame, p: Params, hold: Hold) -> Results:
    fit = models.fit_topics(
        posts, p.k, vocab_size=p.vocab_size, min_df=p.min_df, max_df=p.max_df, seed=p.seed, partitions=p.fit_partitions
    )
    clustered = hold(fit.clustered)
    return {
        "cluster_summary": models.cluster_summary(clustered),
        "cluster_terms": models.cluster_terms(clustered),
    }


def _stance(posts: DataFrame, p: Params, hold: Hold) -> Results:
    fit = models.fit_stance(
        posts, p.svm_features, hash_size=p.svm_hash_size, max_iter=p.svm_max_iter, reg=p.svm_reg, partitions=p.fit_partitions
    )
    fit = replace(fit, predictions=hold(fit.predictions))
    return {
        "metrics": models.stance_metrics(fit),
        "confusion_matrix": models.confusion_matrix(fit.predictions),
    }


# Name -> analysis, in the order of their numbers 1 to 10.
ANALYSES: dict[str, Callable[[DataFrame, Params, Hold], Results]] = {
    "geo_distribution": lambda t, p, _: {"geo_distribution": volume.geo_distribution(t)},
    "temporal_evolution": lambda t, p, _: {"temporal_evolution": volume.temporal_evolution(t)},
    "top_hashtags": lambda t, p, _: {"top_hashtags": tags.top_hashtags(t, p.top_n)},
    "frequent_words": lambda t, p, _: {"frequent_words": words.frequent_words(t, p.top_n)},
    "distinctive_hashtags": lambda t, p, _: {
        "distinctive_hashtags": tags.distinctive_hashtags(t, p.min_tag_count, p.top_n)
    },
    "keyword_comparison": lambda t, p, _: {
        "keyword_comparison": subjects.keyword_comparison(t, p.keywords_a, p.keywords_b)
    },
    "word_cooccurrence": lambda t, p, _: {
        "word_cooccurrence": words.word_cooccurrence(t, p.cooccurrence_words, p.cooccurrence_pairs)
    },
    "polarization_city": lambda t, p, _: {"polarization_city": polarization.polarization_city(t, p.min_city_users)},
    "topic_clusters": _topics,
    "stance_classifier": _stance,
}

_BY_WORD = {"frequent_words", "word_cooccurrence"}
_MULTI_PASS = {"frequent_words", "word_cooccurrence", "topic_clusters", "stance_classifier"}


def select(chosen: Iterable[int | str] | None = None) -> list[str]:
    """Names of the chosen analyses (numbers or names) in their fixed order; all by default."""
    names = list(ANALYSES)
    if chosen is None:
        return names
    picked = set()
    for item in chosen:
        if isinstance(item, int) and 1 <= item <= len(names):
            picked.add(names[item - 1])
        elif item in ANALYSES:
            picked.add(item)
        else:
            raise ValueError(f"unknown analysis {item!r}; choose 1 to {len(names)} or one of {names}")
    return [name for name in names if name in picked]


def run(
    posts: DataFrame,
    out_dir: str,
    chosen: Iterable[int | str] | None = None,
    params: Params = Params(),
    *,
    cache: bool = False,
    file_format: str = "csv",
    write: Callable[[DataFrame, str, str, str], str] = write_result,
) -> list[str]:
    """Run the chosen analyses one after the other and return the paths written.

    ``write`` takes a result, ``out_dir``, its name and the format; see also :func:`run_staged`.
    ``cache`` holds the posts while more than one analysis, or one that reads them
    repeatedly, runs, and the words for the two word analyses. Use it for posts read
    from CSV; for Parquet a second scan of the few columns needed costs less than
    holding all of them. Clusters and predictions, which feed several results, are
    always held.
    """
    names = select(chosen)
    held: list[DataFrame] = []

    def hold(df: DataFrame) -> DataFrame:
        held.append(df.persist(StorageLevel.MEMORY_AND_DISK))
        return held[-1]

    try:
        if cache and (len(names) > 1 or _MULTI_PASS.intersection(names)):
            posts = hold(posts)
        tokenized = posts
        if cache and _BY_WORD.intersection(names):
            tokenized = hold(words.add_tokens(posts).select("words"))
        paths = []
        for name in names:
            source = tokenized if name in _BY_WORD else posts
            for result, df in ANALYSES[name](source, params, hold).items():
                paths.append(write(df, out_dir, result, file_format))
        return paths
    finally:
        for df in held:
            df.unpersist()


def run_staged(
    posts: DataFrame, out_dir: str, chosen: Iterable[int | str] | None = None, params: Params = Params(), *, cache: bool = False, file_format: str = "csv"
) -> DataFrame:
    """As :func:`run`, but results take their place together, once all are written.

    Returns ``result`` and ``rows``, counted while they were written. A run that fails leaves
    what an earlier one has published as it was.
    """
    with StagedResults(posts.sparkSession, out_dir, file_format) as staged:
        run(posts, out_dir, chosen, params, cache=cache, file_format=file_format, write=staged.write)
    return staged.report()
