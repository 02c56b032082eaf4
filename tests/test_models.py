import hashlib

import pytest
from pyspark.ml import Pipeline
from pyspark.ml.classification import LinearSVC
from pyspark.ml.clustering import KMeans
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.feature import IDF, CountVectorizer, HashingTF, Normalizer, RegexTokenizer, StopWordsRemover
from pyspark.sql import Observation
from pyspark.sql import functions as F

from opinionlens import constants as K
from opinionlens.fixtures.adapters import frame
from opinionlens.functions import tokens as tk
from opinionlens.operators import models


@pytest.fixture(scope="module")
def topical(spark):
    themes = ["border wall security agents", "economy jobs inflation prices", "health care doctors hospital"]
    rows = [
        (i, f"u{i % 9}", f"{themes[i % 3]} item{chr(97 + i % 5)} filler", "#t", "bio", (None, 0, 1)[i % 3], "2024-09-01")
        for i in range(240)
    ]
    return spark.createDataFrame(
        rows, "post_id int, user_id string, text string, hashtags string, description string, binary_label int, date string"
    ).cache()


def test_tokens_equal_the_ml_transformers(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("text")
    tokenizer = RegexTokenizer(inputCol="text", outputCol="raw", pattern="[^A-Za-z]+", minTokenLength=3)
    remover = StopWordsRemover(
        inputCol="raw",
        outputCol="expected",
        stopWords=StopWordsRemover.loadDefaultStopWords("english") + K.EXTRA_STOPWORDS,
    )
    both = remover.transform(tokenizer.transform(docs)).withColumn("words", tk.tokens("text"))
    assert both.filter("words != expected").count() == 0


def test_clusters(topical):
    fit = models.fit_topics(topical, 3, keep=["post_id", "binary_label"], key="post_id", min_df=2, partitions=4)
    clustered = fit.clustered.cache()
    summary = models.cluster_summary(clustered)
    rows = summary.collect()
    assert sum(r.tweet_count for r in rows) == topical.count()
    assert all(r.pos + r.neg + r.unclear == r.tweet_count for r in rows)
    # Three clean themes end up in three clusters, each of one label.
    assert sorted(max(r.pos, r.neg, r.unclear) for r in rows) == [80, 80, 80]

    terms = models.cluster_terms(clustered, 4).collect()
    assert all(r["rank"] <= 4 for r in terms) and len(terms) == 12
    first = models.terms_of_cluster(models.cluster_terms(clustered), 0).collect()
    assert [r["rank"] for r in first] == list(range(1, len(first) + 1)) and len(first) <= K.TERMS_PER_CLUSTER
    shares = models.cluster_shares(summary)
    assert shares.count() == 9
    assert all(abs(r[1] - 1) < 1e-9 for r in shares.groupBy("cluster").agg(F.sum("share")).collect())


def test_vectors_equal_the_ml_estimators(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", tk.tokens("text").alias("words")).cache()
    ours = models.fit_vectors(docs, min_df=5, max_df=0.6)
    theirs = Pipeline(
        stages=[
            CountVectorizer(inputCol="words", outputCol="tf", vocabSize=20000, minDF=5, maxDF=0.6),
            IDF(inputCol="tf", outputCol="tfidf"),
            Normalizer(inputCol="tfidf", outputCol="features", p=2.0),
        ]
    ).fit(docs)

    def weights(model):
        vocabulary = model.stages[0].vocabulary
        rows = model.transform(docs).select("doc_id", "features").collect()
        return {(r.doc_id, vocabulary[i]): x for r in rows for i, x in zip(r.features.indices, r.features.values)}

    a, b = weights(ours), weights(theirs)
    assert len(a) > 1000 and a.keys() == b.keys()
    assert all(a[k] == pytest.approx(b[k]) for k in a)
    with pytest.raises(ValueError, match="no word"):
        models.fit_vectors(docs, min_df=10**6)


def test_keyed_fit_ignores_the_layout(topical):
    def assigned(df):
        fit = models.fit_topics(df, 4, keep=["post_id"], key="post_id", min_df=2, partitions=4)
        return {r.post_id: r.cluster for r in fit.clustered.collect()}

    assert assigned(topical) == assigned(topical.repartition(7))


def test_topic_words_leave_out_the_listed_ones(spark):
    df = spark.createDataFrame([("Trump vote economy", "#Michigan;#jobs", 1)], "text string, hashtags string, binary_label int")
    assert models.topic_words(df).first().words == ["economy", "jobs"]


def test_stance(topical):
    fit = models.fit_stance(topical, keys=["post_id"], hash_size=1 << 12, partitions=4)
    metrics = {r.metric: r.value for r in models.stance_metrics(fit).collect()}
    assert list(metrics) == [
        "area_under_roc", "accuracy", "f1", "weighted_precision", "weighted_recall", "train_rows", "test_rows"
    ]
    assert metrics["train_rows"] + metrics["test_rows"] == 160
    assert metrics["accuracy"] == 1.0 and metrics["area_under_roc"] == 1.0
    assert sum(r["count"] for r in models.confusion_matrix(fit.predictions).collect()) == metrics["test_rows"]
    assert models.score_metrics(models.stance_metrics(fit)).count() == 5
    with pytest.raises(ValueError):
        models.fit_stance(topical, [])


def test_stance_equals_a_plain_pipeline(spark, sf_dir):
    """On noisy labels: the same classifier as one fitted directly on the same rows."""
    posts = frame(spark, sf_dir, "posts")
    ours = models.fit_stance(posts, keys=["post_id"], hash_size=1 << 12, max_iter=20, partitions=4)
    words = models.stance_words(posts.withColumn("train", models.in_train(["post_id"])), keep=["train", "post_id"]).cache()
    plain = Pipeline(
        stages=[
            HashingTF(inputCol="words", outputCol="tf", numFeatures=1 << 12),
            IDF(inputCol="tf", outputCol="features"),
            LinearSVC(maxIter=20, regParam=K.SVM_REG),
        ]
    ).fit(words.filter("train"))
    test = words.filter("not train")
    theirs = [(r.post_id, r.prediction, r.rawPrediction[1]) for r in plain.transform(test).collect()]
    mine = [(r.post_id, r.prediction, r.rawPrediction[1]) for r in ours.model.transform(test).collect()]
    assert len(theirs) > 50 and len({p for _, p, _ in theirs}) == 2
    assert {i: p for i, p, _ in mine} == {i: p for i, p, _ in theirs}
    assert [s for *_, s in sorted(mine)] == pytest.approx([s for *_, s in sorted(theirs)], abs=1e-3)
    bounded = models.fit_stance(posts, keys=["post_id"], hash_size=1 << 12, max_iter=2, partitions=2, max_rows=40)
    assert bounded.train.count() == 40


def test_clusters_are_as_good_as_a_plain_pipeline(spark, sf_dir):
    """Starts differ with the layout of the rows; the cost of the clusters must not."""
    posts = frame(spark, sf_dir, "posts")
    ours = models.fit_topics(posts, 4, keep=["post_id"], key="post_id", min_df=5, partitions=4)
    words = models.topic_words(posts, ["post_id"]).cache()
    plain = Pipeline(
        stages=[
            CountVectorizer(inputCol="words", outputCol="tf", vocabSize=20000, minDF=5, maxDF=0.6),
            IDF(inputCol="tf", outputCol="tfidf"),
            Normalizer(inputCol="tfidf", outputCol="features", p=2.0),
            KMeans(k=4, seed=K.SEED, predictionCol="theirs"),
        ]
    ).fit(words)
    assert ours.model.stages[-1].summary.trainingCost == pytest.approx(plain.stages[-1].summary.trainingCost, rel=0.05)
    both = plain.transform(words).select("post_id", "theirs").join(ours.clustered, "post_id")
    assert both.count() == posts.count() and both.select("cluster").distinct().count() == 4


def test_metrics_equal_the_evaluators(spark):
    rows = [(0.0, 0.0)] * 7 + [(0.0, 1.0)] * 2 + [(1.0, 0.0)] * 3 + [(1.0, 1.0)] * 5
    df = spark.createDataFrame(rows, "label double, prediction double")
    got = {r.metric: r.value for r in models.classification_metrics(df).collect()}
    for name, spark_name in [
        ("accuracy", "accuracy"), ("f1", "f1"), ("weighted_precision", "weightedPrecision"), ("weighted_recall", "weightedRecall")
    ]:
        assert got[name] == pytest.approx(MulticlassClassificationEvaluator(metricName=spark_name).evaluate(df))
    never = models.classification_metrics(df.withColumn("prediction", F.lit(0.0)))
    assert {r.metric: r.value for r in never.collect()}["weighted_precision"] == pytest.approx(9 / 17 * 9 / 17)


def test_area_under_roc_counts_pairs(spark):
    rows = [(1.0, s) for s in (0.9, 0.8, 0.5, 0.5)] + [(0.0, s) for s in (0.8, 0.5, 0.1)]
    df = spark.createDataFrame(rows, "label double, score double")
    pairs = [(p > n) + (p == n) / 2 for a, p in rows if a for b, n in rows if not b]
    assert models.area_under_roc(df, "score", 0) == pytest.approx(sum(pairs) / len(pairs))


def test_hash_split(spark):
    df = spark.range(5000).withColumn("text", F.concat(F.lit("p"), F.col("id")))
    train, test = models.hash_split(df, ["id", "text"])
    assert train.count() + test.count() == 5000 and 3850 < train.count() < 4150
    assert {r.id for r in train.collect()} == {r.id for r in models.hash_split(df.repartition(5), ["id", "text"])[0].collect()}
    digest = hashlib.md5(b"3\x1fp3").hexdigest()
    assert (train.filter("id = 3").count() == 1) == (int(digest[:8], 16) % 100 < 80)


def test_bench_times_the_fit_of_each_run(spark):
    """No timed run reports on a fit that an earlier one made."""
    import bench
    from opinionlens.fixtures import catalog

    made = []

    def query(spark, sf):
        catalog._once(spark, sf, "bench", lambda: made.append(1) or len(made))
        return spark.range(1)

    for _ in range(3):
        assert bench.run_once(query, spark, "somewhere") > 0
    assert len(made) == 3
    catalog.forget_fits()


def test_a_classifier_is_sent_to_tasks_after_the_session_has_observed_a_metric(spark):
    """A training summary would take the session along, which holds its observations."""
    spark.range(5).observe(Observation(), F.count(F.lit(1)).alias("rows")).collect()
    posts = spark.createDataFrame(
        [(i, "vote blue" if i % 2 else "vote red", i % 2) for i in range(60)], "post_id bigint, text string, binary_label int"
    )
    fit = models.fit_stance(posts, ["text"], keys=["post_id"], hash_size=64, max_iter=2, partitions=2)
    assert not fit.model.stages[-1].hasSummary
    assert fit.predictions.count() + fit.train.count() == 60
