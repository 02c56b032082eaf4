"""Every operator as a query over the given tables."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace
from functools import reduce

import numpy as np
from pyspark.errors import StreamingQueryException
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from opinionlens.fixtures.adapters import frame
from opinionlens.functions import codepages
from opinionlens.functions import text as tx
from opinionlens.functions import tokens as tk
from opinionlens.functions import values as v
from opinionlens.operators import clustering, labeling, margin, models, polarization, reports, subjects, tags, users, volume, words
from opinionlens.operators import posts as post_ops
from opinionlens.plans import folders, registry
from opinionlens.session import files_for, materialize, shared_dir
from opinionlens.sources import posts as post_sources
from opinionlens.sources import results as result_sources
from opinionlens.streaming.labels import label_new_files, latest_labels, relabel_files, store_batch

Query = Callable[[SparkSession, str], DataFrame]

# Words that the invented prose holds, in place of the default keyword lists.
KEYWORDS_A = ["the", "and", "on the"]
KEYWORDS_B = ["der", "und", "la", "élle"]

# src19 has no code on purpose: it plays the place that maps leave out.
STATE_CODES = {f"src{i}": f"S{i}" for i in range(19)}
FILE_KEYS = {"src1_": "One", "src1": "Teens", "src2": "Two", "en": "English"}
STATES = ["src1", "src2", "src3"]

# Patterns as a caller may write them: optional ends, classes and alternatives at the top.
CUSTOM_NEG = [r"\b[ct]rump\b(\s+2024)?", r"\b(?:never|worst) [a-z]+|coward$"]
CUSTOM_POS = [r"\bvote\b(\s+blue)?", r"anti-?maga|\bquinces?\b"]

# Files of the model queries' stored feature tables.
FIT_PARTITIONS = 8

# Where the checks of single steps of the models start.
GIVEN_CENTROIDS, GIVEN_STEPS = 4, 3
GIVEN_BUCKETS, GIVEN_INTERCEPT = 1 << 12, 0.10005


def _posts(spark, sf):
    return frame(spark, sf, "posts")


def _texts(spark, sf, adapter="posts"):
    return frame(spark, sf, adapter)


def _clean(spark, sf):
    """Posts after a round through the dirty form: null users, dates and places."""
    return post_ops.normalize_posts(frame(spark, sf, "posts_dirty"), keep=["post_id"])


def _geo(spark, sf):
    return volume.geo_distribution(_clean(spark, sf))


def _temporal(spark, sf):
    return volume.temporal_evolution(_clean(spark, sf))


def _comparison(spark, sf):
    return subjects.keyword_comparison(_texts(spark, sf), KEYWORDS_A, KEYWORDS_B)


def _cities(spark, sf):
    return polarization.polarization_city(_clean(spark, sf))


def _predictions(spark, sf):
    return frame(spark, sf, "predictions")


# --- text functions -----------------------------------------------------------


def _on_text(adapter: str, function, source: str = "text", target: str = "text") -> Query:
    def query(spark, sf):
        return _texts(spark, sf, adapter).select("post_id", function(source).alias(target))

    return query


def _state_from_source(spark, sf):
    raw = frame(spark, sf, "raw_posts")
    return raw.select("post_id", "file_name", v.state_from_name("file_name", FILE_KEYS).alias("state"))


def _clean_posts(spark, sf):
    return post_ops.clean_posts(_texts(spark, sf, "raw_posts"), file_name="file_name", states=FILE_KEYS)


def _undo_misreading(spark, sf):
    """Texts that were read in a wrong code page and repaired."""
    damaged = F.col("text")
    for k, page in enumerate(codepages.PAGES):
        damaged = F.when(F.col("post_id") % len(codepages.PAGES) == k, codepages.misread("text", page)).otherwise(damaged)
    return _posts(spark, sf).select("post_id", codepages.undo_misreading(damaged).alias("text"))


def _parse_tags(spark, sf):
    return tags.tag_rows(frame(spark, sf, "tag_lists"), "post_id")


def _tokens(spark, sf):
    return _texts(spark, sf).select("post_id", F.array_join(tk.tokens("text"), " ").alias("words"))


def _keyword_flags(spark, sf):
    return subjects.keyword_flags(_texts(spark, sf), KEYWORDS_A, KEYWORDS_B, keep=["post_id"])


# --- labels -------------------------------------------------------------------


def _stand_in_model():
    """A model whose reply depends on nothing but the length of the prompt."""

    def predict(prompts: list[str]) -> list[str]:
        return [("1", "Answer: 0", "N", "10")[len(p) % 4] for p in prompts]

    return predict


LABEL_COLUMNS = ["post_id", "binary_label", "label_status"]


def _rule_label(spark, sf):
    posts = _texts(spark, sf, "stance_posts")
    return posts.select("post_id", labeling.rule_label("text", "hashtags").alias("rule_label"))


def _rule_label_custom(spark, sf):
    posts = _texts(spark, sf, "stance_posts")
    label = labeling.rule_label("text", "hashtags", CUSTOM_NEG, CUSTOM_POS)
    return posts.select("post_id", label.alias("rule_label"))


def _build_prompt(spark, sf):
    posts = _texts(spark, sf, "stance_posts").withColumn(
        "hashtags", F.when(F.col("post_id") % 3 == 0, "").otherwise(F.col("hashtags"))
    )
    return posts.select("post_id", labeling.build_prompt("text", "hashtags").alias("prompt"))


def _parse_answer(spark, sf):
    return frame(spark, sf, "answers").select("post_id", labeling.parse_answer("answer").alias("label"))


def _label_posts(spark, sf):
    return labeling.label_posts(_texts(spark, sf, "stance_posts")).select(*LABEL_COLUMNS)


def _model_label(spark, sf):
    return labeling.label_posts(_texts(spark, sf, "stance_posts"), _stand_in_model()).select(*LABEL_COLUMNS)


def _label_resume(spark, sf):
    """Two runs over a folder that grew in between; every post is labelled once."""
    root = shared_dir(spark)
    posts = _texts(spark, sf, "stance_posts")
    for half in (0, 1):
        part = posts.filter(F.col("post_id") % 2 == half)
        part.write.mode("append").parquet(f"{root}/posts")
        label_new_files(
            spark, f"{root}/posts", posts.schema, f"{root}/labelled", f"{root}/progress", _stand_in_model(),
            max_files_per_batch=4,
        )
    return spark.read.parquet(f"{root}/labelled").select(*LABEL_COLUMNS)


def _label_retry(spark, sf):
    """A first run during which the model is away, and a second one that makes up for it."""
    root = shared_dir(spark)
    posts = _texts(spark, sf, "stance_posts")
    posts.write.parquet(f"{root}/posts")

    def away(prompts: list[str]) -> list[str]:
        raise ConnectionError("the model is away")

    for model in (away, _stand_in_model()):
        try:
            label_new_files(
                spark, f"{root}/posts", posts.schema, f"{root}/labelled", f"{root}/progress", model, backoff=0.0
            )
        except StreamingQueryException:
            if model is not away:
                raise
    return spark.read.parquet(f"{root}/labelled").select(*LABEL_COLUMNS)


def _label_relabel(spark, sf):
    """A round without a model, then one over the even posts with it, of which a batch is replayed."""
    root = shared_dir(spark)
    posts = _texts(spark, sf, "stance_posts")
    files = files_for(posts, ["text"], 4)
    posts.repartition(files).write.parquet(f"{root}/posts")
    for label_round, model in ((1, None), (2, _stand_in_model())):
        relabel_files(
            spark, f"{root}/posts", posts.schema, f"{root}/labelled", f"{root}/progress", model, label_round=label_round,
            relabel=label_round > 1, prepare=lambda p, r=label_round: p.filter((F.col("post_id") % 2 == 0) | (r == 1)), max_files_per_batch=-(-files // 2),
        )
    again = spark.read.parquet(f"{root}/labelled/label_round=2/label_batch=0")
    store_batch(again.transform(materialize), f"{root}/labelled", 2, 0)
    return latest_labels(spark, f"{root}/labelled", "post_id").select(*LABEL_COLUMNS)


def _still_to_label(spark, sf):
    posts = _texts(spark, sf, "stance_posts")
    done = labeling.label_posts(posts).filter(F.col("post_id") % 3 > 0)
    return labeling.still_to_label(posts, done, "post_id").select("post_id")


# --- sources and sinks --------------------------------------------------------


def _read_posts(spark, sf):
    path = f"{shared_dir(spark)}/posts_csv"
    # Line breaks are escaped, so that the files can be split when they are read.
    escaped = F.replace(F.replace("text", F.lit("\\"), F.lit("\\\\")), F.lit("\n"), F.lit("\\n"))
    (
        frame(spark, sf, "posts_dirty")
        .withColumn("text", escaped)
        .write.option("header", True)
        .option("quote", '"')
        .option("escape", '"')
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .csv(path)
    )
    parts = F.transform(F.split("text", r"\\\\\\\\"), lambda part: F.replace(part, F.lit("\\n"), F.lit("\n")))
    read = post_sources.read_posts(spark, path, keep=["post_id"])
    return read.withColumns({"post_id": F.col("post_id").cast("bigint"), "text": F.array_join(parts, "\\")})


def _stored_posts(spark, sf):
    path = f"{shared_dir(spark)}/posts"
    post_sources.store_posts(_clean(spark, sf).drop("post_id"), path)
    stored = post_ops.labelled(post_sources.read_stored_posts(spark, path))
    return post_ops.filter_states(stored, STATES).select("state", "user_id", "date", "binary_label", "text")


def _stored_results(spark, sf):
    out = shared_dir(spark)
    result_sources.write_result(_temporal(spark, sf), out, "temporal_evolution")
    return result_sources.load_results(spark, out, STATE_CODES)["temporal_evolution"]


# --- models -------------------------------------------------------------------


_FITS: dict[tuple[str, str, str], object] = {}


def _once(spark, sf, name, fit):
    """A fit, made once for a session and input, for all queries that report on it."""
    key = (spark.sparkContext.applicationId, sf, name)
    if key not in _FITS:
        _FITS[key] = fit()
    return _FITS[key]


def forget_fits() -> None:
    """Let the next query that reports on a fit make it anew."""
    _FITS.clear()


def _clustered(spark, sf):
    def fit():
        posts = _texts(spark, sf)
        return models.fit_topics(
            posts, keep=["post_id", "binary_label"], key="post_id", partitions=FIT_PARTITIONS
        ).clustered

    return _once(spark, sf, "topics", fit)


def _stance(spark, sf):
    def fit():
        found = models.fit_stance(_texts(spark, sf), keys=["post_id"], partitions=FIT_PARTITIONS)
        return replace(found, predictions=materialize(found.predictions))

    return _once(spark, sf, "stance", fit)


def _tfidf_vectors(spark, sf):
    """The vectors of the clusters' features, entry by entry."""
    words_of = models.topic_words(_texts(spark, sf).withColumn("hashtags", F.lit("")), ["post_id"], tk.stop_words())
    vectors = models.fit_vectors(words_of)
    names = F.array(*[F.lit(w) for w in vectors.stages[0].vocabulary])
    entries = F.posexplode(vector_to_array("features")).alias("at", "weight")
    found = vectors.transform(words_of).select("post_id", entries).filter("weight != 0")
    return found.select("post_id", F.get(names, F.col("at")).alias("word"), F.round("weight", 9).alias("weight"))


def _word_vectors(spark, sf):
    """Sparse vectors of the clusters' features, and the centroids that four posts are."""
    words_of = models.topic_words(_texts(spark, sf).withColumn("hashtags", F.lit("")), ["post_id"], tk.stop_words())
    terms = clustering.vocabulary(words_of)
    vectors = materialize(clustering.sparse_vectors(words_of, terms))
    given = vectors.filter(F.col("post_id") < GIVEN_CENTROIDS).select(
        F.col("post_id").alias("cluster"), F.explode(F.arrays_zip("terms", "weights")).alias("entry")
    )
    rows = given.select("cluster", F.col("entry.terms").alias("term"), F.col("entry.weights").alias("weight")).collect()
    return terms, vectors, clustering.as_centroids(rows, GIVEN_CENTROIDS, len(terms.words))


def _kmeans_step(spark, sf):
    terms, vectors, centroids = _word_vectors(spark, sf)
    names = F.array(*[F.lit(w) for w in terms.words])
    step = clustering.kmeans_step(vectors, centroids)
    return step.select("cluster", F.get(names, F.col("term").cast("int")).alias("word"), "weight", "posts")


def _kmeans_assigned(spark, sf):
    """Clusters of all posts after steps from given centroids."""
    terms, vectors, centroids = _word_vectors(spark, sf)
    for _ in range(GIVEN_STEPS):
        centroids = clustering.as_centroids(clustering.kmeans_step(vectors, centroids).collect(), GIVEN_CENTROIDS, len(terms.words))
    return clustering.assign(vectors, centroids, ["post_id"])


def _topic_clusters(spark, sf):
    """The clusters of a whole fit, seeds included."""
    return clustering.fit_clusters(_texts(spark, sf), "post_id", keep=["post_id"]).clustered.select("post_id", "cluster")


def _stance_words(spark, sf, features=("text",)):
    return models.stance_words(_posts(spark, sf), features, keep=["post_id"])


def _hinge_gradient(spark, sf):
    """Loss and gradient at weights that a rule gives."""
    codes = _stance_words(spark, sf).select("label", margin.hashed_words("words", GIVEN_BUCKETS).alias("codes"))
    weights = [(b * 37 % 101 - 50) / 1000 for b in range(GIVEN_BUCKETS)]
    found = margin.hinge_gradient(codes, np.array(weights), GIVEN_INTERCEPT)
    return found.select("bucket", F.round("gradient", 6).alias("gradient"))


def _stance_machine_metrics(spark, sf):
    fit = margin.fit_stance_machine(_posts(spark, sf), keys=["post_id"])
    return models.classification_metrics(fit.predictions)


def _stored(spark, sf):
    """The four results by state, written as the runner writes them and read back."""
    out = shared_dir(spark)
    registry.run(_clean(spark, sf), out, ["geo_distribution", "temporal_evolution", "polarization_city"])
    result_sources.write_result(_comparison(spark, sf), out, "keyword_comparison")
    return result_sources.load_results(spark, out)


def _run_registry(spark, sf):
    """Rows of each result, after the runner has written it."""
    out, chosen = shared_dir(spark), [1, 2, 3, 5, "keyword_comparison", "polarization_city"]
    params = registry.Params(keywords_a=KEYWORDS_A, keywords_b=KEYWORDS_B)
    paths = registry.run(_clean(spark, sf), out, chosen, params, cache=True)
    tables = [result_sources.read_result(spark, out, p.rpartition("/")[2]).select(F.lit(p.rpartition("/")[2]).alias("result")) for p in paths]
    return reduce(DataFrame.unionAll, tables).groupBy("result").agg(F.count("*").alias("rows"))


def _write_report(spark, sf):
    """Rows of the results of a staged run, which follows one that failed half-way."""
    out, posts = shared_dir(spark), _clean(spark, sf)
    params = registry.Params(keywords_a=KEYWORDS_A, keywords_b=KEYWORDS_B)
    registry.run(posts, out, [1, 2], params)
    try:
        registry.run_staged(posts.limit(5), out, [1, "keyword_comparison"], replace(params, keywords_a=[]))
    except ValueError:
        kept = result_sources.read_result(spark, out, "geo_distribution").select(F.lit("after a failed run").alias("result"))
    report = registry.run_staged(posts, f"{out}/next", [1, 2, 3, 5, "keyword_comparison", "polarization_city"], params)
    return report.unionAll(kept.groupBy("result").agg(F.count("*").alias("rows")))


def _clean_folder(spark, sf):
    """Two runs over a folder of exports that grew in between."""
    root = shared_dir(spark)
    raw = _texts(spark, sf, "raw_posts").drop("file_name").withColumn("text", F.translate("text", "\n\r", "  "))
    for half in (0, 1):
        part = raw.filter(F.col("post_id") % 2 == half).write.mode("append").option("header", True).option("quote", '"').option("escape", '"')
        part.option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(f"{root}/raw")
        folders.clean_folder(spark, f"{root}/raw", f"{root}/clean", FILE_KEYS)
    cleaned = folders.read_cleaned(spark, f"{root}/clean")
    return cleaned.select(F.col("post_id").cast("bigint").alias("post_id"), "text", "hashtags", "username", "description", "city")


def _available_results(spark, sf):
    out = shared_dir(spark)
    registry.run(_clean(spark, sf), out, ["geo_distribution", "temporal_evolution"])
    names = result_sources.available_results(result_sources.load_results(spark, out))
    return spark.createDataFrame([(n,) for n in names], "result string")


def _score_metrics(spark, sf):
    """Of all metrics those that are scores; here the accuracy, as SQL has it too."""
    metrics = models.classification_metrics(_predictions(spark, sf)).unionAll(
        _predictions(spark, sf).agg(F.count("*").cast("double").alias("value")).select(F.lit("test_rows"), "value")
    )
    scores = models.score_metrics(metrics).filter("metric not in ('f1', 'weighted_precision', 'weighted_recall')")
    return scores.select("metric", F.round("value", 9).alias("value"))


def _assigned(spark, sf):
    """Posts with clusters given by a rule: what follows the fit, in a form SQL can check."""
    found = _texts(spark, sf, "assigned")
    return found.select("post_id", "binary_label", "cluster", tk.tokens("text").alias("words"))


def _hash_split(spark, sf):
    split = F.when(models.in_train(["post_id"]), "train").otherwise("test")
    return _posts(spark, sf).select("post_id", split.alias("part"))


def _auc_from_scores(spark, sf):
    area = models.area_under_roc(frame(spark, sf, "scores"), score="score")
    return spark.createDataFrame([("area_under_roc", round(area, 9))], "metric string, value double")


def _roc_area(spark, sf):
    return models.roc_area(frame(spark, sf, "scores")).select("metric", F.round("value", 9).alias("value"))


def _classification_metrics(spark, sf):
    metrics = models.classification_metrics(_predictions(spark, sf))
    return metrics.select("metric", F.round("value", 9).alias("value"))


QUERIES: dict[str, Query] = {
    # where and when
    "geo_distribution": _geo,
    "temporal_evolution": _temporal,
    "overview_kpis": lambda s, d: volume.overview_kpis(_clean(s, d)),
    "state_volume": lambda s, d: post_ops.with_state_code(
        volume.state_volume(_clean(s, d)), STATE_CODES, drop_unknown=True
    ),
    "state_users_exact": lambda s, d: users.united_users(materialize(users.user_bitmaps(_clean(s, d)))),
    "top_state": lambda s, d: reports.top_state(_geo(s, d)),
    "geo_rollup": lambda s, d: reports.geo_rollup(_geo(s, d)),
    "city_ranking": lambda s, d: reports.city_ranking(_geo(s, d)),
    "city_ranking_by_users": lambda s, d: reports.city_ranking(_geo(s, d), "unique_users", 15),
    "daily_volume": lambda s, d: reports.daily_volume(_temporal(s, d)),
    "daily_state_volume": lambda s, d: reports.daily_state_volume(_temporal(s, d)),
    "daily_composition": lambda s, d: reports.daily_composition(_temporal(s, d)),
    "distinct_states": lambda s, d: reports.distinct_states(_stored(s, d).values()),
    "filter_states": lambda s, d: post_ops.filter_states(_geo(s, d), STATES),
    "formatted_volume": lambda s, d: reports.daily_volume(_temporal(s, d)).select(
        "date", v.format_thousands(F.col("tweet_count") * 12345).alias("shown")
    ),
    # hashtags and words
    "top_hashtags": lambda s, d: tags.top_hashtags(_posts(s, d)),
    "distinctive_hashtags": lambda s, d: tags.distinctive_hashtags(_posts(s, d)),
    "tag_extremes": lambda s, d: tags.tag_extremes(tags.distinctive_hashtags(_posts(s, d))),
    "frequent_words": lambda s, d: words.frequent_words(_texts(s, d)),
    "word_cooccurrence": lambda s, d: words.word_cooccurrence(_texts(s, d)),
    "group_top_terms": lambda s, d: words.group_top_terms(_texts(s, d), "state"),
    "tfidf_terms": lambda s, d: words.tfidf_terms(_texts(s, d)).withColumn("idf", F.round("idf", 9)),
    # subjects
    "keyword_flags": _keyword_flags,
    "keyword_comparison": _comparison,
    "state_mentions": lambda s, d: reports.state_mentions(_comparison(s, d)),
    # polarization
    "user_orientation": lambda s, d: polarization.user_orientation(_clean(s, d)),
    "polarization_city": _cities,
    "polarization_state": lambda s, d: polarization.polarization_state(_cities(s, d)),
    "polarization_unpivot": lambda s, d: polarization.polarization_unpivot(
        polarization.polarization_state(_cities(s, d))
    ),
    "polarized_cities": lambda s, d: polarization.polarized_cities(_cities(s, d), min_users=3),
    "label_bounds": lambda s, d: polarization.label_bounds(_cities(s, d)),
    # cleaning
    "state_from_source": _state_from_source,
    "strip_emojis": _on_text("raw_posts", tx.strip_emojis),
    "strip_urls": _on_text("raw_posts", tx.strip_urls),
    "normalize_spaces": _on_text("raw_posts", tx.normalize_spaces),
    "extract_tags_raw": _on_text("raw_posts", lambda c: F.array_join(tx.extract_tags(c), ";"), target="tags"),
    "repair_text": _on_text("damaged_posts", tx.repair_text),
    "undo_misreading": _undo_misreading,
    "clean_text": _on_text("damaged_posts", tx.clean_text),
    "clean_description": _on_text("raw_posts", tx.clean_description, "description", "description"),
    "clean_username": _on_text("raw_posts", tx.clean_username, "username", "username"),
    "clean_posts": _clean_posts,
    "posts_normalized": _clean,
    "parse_tags": _parse_tags,
    "tokens": _tokens,
    # labels
    "rule_label": _rule_label,
    "rule_label_custom": _rule_label_custom,
    "build_prompt": _build_prompt,
    "parse_answer": _parse_answer,
    "label_posts": _label_posts,
    "model_label_overlapped": lambda s, d: labeling.label_posts(
        _texts(s, d, "stance_posts"), _stand_in_model(), in_flight=8, batch_size=4, per_second=500, deadline=600
    ).select(*LABEL_COLUMNS),
    "model_label": _model_label,
    "label_resume": _label_resume,
    "label_retry": _label_retry,
    "label_relabel": _label_relabel,
    "still_to_label": _still_to_label,
    "label_coverage": lambda s, d: post_ops.label_coverage(_clean(s, d), ["state"]),
    # sources and sinks
    "read_posts": _read_posts,
    "stored_posts": _stored_posts,
    "stored_results": _stored_results,
    "run_registry": _run_registry,
    "available_results": _available_results,
    "write_report": _write_report,
    "clean_folder": _clean_folder,
    # models
    "cluster_summary": lambda s, d: models.cluster_summary(_clustered(s, d)),
    "cluster_terms": lambda s, d: models.cluster_terms(_clustered(s, d)),
    "cluster_shares": lambda s, d: models.cluster_shares(models.cluster_summary(_clustered(s, d))),
    "cluster_summary_given": lambda s, d: models.cluster_summary(_assigned(s, d)),
    "cluster_terms_given": lambda s, d: models.cluster_terms(_assigned(s, d)),
    "cluster_shares_given": lambda s, d: models.cluster_shares(models.cluster_summary(_assigned(s, d))),
    "terms_of_cluster_given": lambda s, d: models.terms_of_cluster(models.cluster_terms(_assigned(s, d)), 1),
    "svm_metrics": lambda s, d: models.stance_metrics(_stance(s, d)),
    "confusion_matrix": lambda s, d: models.confusion_matrix(_stance(s, d).predictions),
    "confusion_pivot": lambda s, d: reports.label_pivot(models.confusion_matrix(_stance(s, d).predictions)),
    "confusion_matrix_given": lambda s, d: models.confusion_matrix(_predictions(s, d)),
    "label_pivot": lambda s, d: reports.label_pivot(models.confusion_matrix(_predictions(s, d))),
    "hash_split": _hash_split,
    "tfidf_vectors": _tfidf_vectors,
    "kmeans_step_given": _kmeans_step,
    "kmeans_assigned_given": _kmeans_assigned,
    "topic_clusters": _topic_clusters,
    "hashed_terms": lambda s, d: margin.hashed_terms(_stance_words(s, d), "post_id"),
    "hinge_gradient_given": _hinge_gradient,
    "stance_machine_metrics": _stance_machine_metrics,
    "score_metrics_given": _score_metrics,
    "auc_from_scores": _auc_from_scores,
    "roc_area": _roc_area,
    "classification_metrics": _classification_metrics,
}
