"""Topic clusters and the stance classifier, on Spark ML."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.ml.classification import LinearSVC
from pyspark.ml.clustering import KMeans
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.feature import IDF, CountVectorizer, ElementwiseProduct, HashingTF, Normalizer
from pyspark.ml.linalg import Vectors
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from opinionlens import constants as K
from opinionlens.functions import tokens as tk
from opinionlens.functions import values as v
from opinionlens.functions.text import column
from opinionlens.operators.posts import labelled
from opinionlens.operators.words import rank_terms, tfidf_terms, word_rows
from opinionlens.session import discard, files_for, materialize, shared_dir


# Files of a stored feature table, for fits that need the same rows in each of them every time.
FIT_PARTITIONS = 200

# --- topic clusters -----------------------------------------------------------


def topic_words(
    posts: DataFrame, keep: Sequence[str] = ("binary_label",), stops: Iterable[str] | None = None
) -> DataFrame:
    """Words of text and hashtags. Place and author are left out on purpose."""
    stops = tk.stop_words(K.TOPIC_STOPWORDS) if stops is None else stops
    return posts.select(*keep, tk.tokens(F.concat_ws(" ", "text", "hashtags"), stops).alias("words"))


def fit_vectors(
    words: DataFrame, *, vocab_size: int = K.VOCAB_SIZE, min_df: float = K.MIN_DF, max_df: float = K.MAX_DF
) -> PipelineModel:
    """Stages from the array column ``words`` to normalised TF-IDF vectors ``features``.

    One aggregation yields vocabulary and weights together, at most ``vocab_size`` rows
    on the driver, where separate fits would pass over all posts three times or hold
    their words meanwhile.
    """
    terms = tfidf_terms(words, vocab_size, min_df, max_df, stops=()).select("word", "idf").collect()
    if not terms:
        raise ValueError(f"no word is in at least {min_df} and at most {max_df} of the posts")
    idf = {t.word: t.idf for t in terms}
    # One partition, so that words of equal count keep one order.
    vocabulary = words.sparkSession.createDataFrame([(list(idf),)], "words array<string>").coalesce(1)
    counter = CountVectorizer(inputCol="words", outputCol="tf", vocabSize=vocab_size, minDF=1.0).fit(vocabulary)
    weights = Vectors.dense([idf[word] for word in counter.vocabulary])
    return PipelineModel(
        [
            counter,
            ElementwiseProduct(scalingVec=weights, inputCol="tf", outputCol="tfidf"),
            Normalizer(inputCol="tfidf", outputCol="features", p=2.0),
        ]
    )


@dataclass(frozen=True)
class TopicFit:
    model: PipelineModel
    clustered: DataFrame


def fit_topics(
    posts: DataFrame,
    k: int = K.KMEANS_K,
    *,
    keep: Sequence[str] = ("binary_label",),
    key: str | None = None,
    stops: Iterable[str] | None = None,
    vocab_size: int = K.VOCAB_SIZE,
    min_df: float = K.MIN_DF,
    max_df: float = K.MAX_DF,
    seed: int = K.SEED,
    partitions: int = FIT_PARTITIONS,
) -> TopicFit:
    """Cluster posts by K-Means on normalised TF-IDF vectors of their words.

    Returns the fitted stages and the posts (the ``keep`` columns and ``words``) with
    their ``cluster``. Seeds act per partition, so only a fit with a ``key`` among the
    kept columns is the same for every layout of the input; its vectors, and nothing
    else, are stored in ``partitions`` files while it lasts, or in as many more as keep
    a file at some hundred megabytes. Without a key files are of even size.
    """
    words = topic_words(posts, keep, stops)
    vectors = fit_vectors(words, vocab_size=vocab_size, min_df=min_df, max_df=max_df)
    files = files_for(posts, ["text", "hashtags"], partitions) if key else partitions
    table = materialize(vectors.transform(words).select(*([key] if key else []), "features"), key, files)
    kmeans = KMeans(k=k, seed=seed, featuresCol="features", predictionCol="cluster").fit(table.select("features"))
    discard(table)
    model = PipelineModel([*vectors.stages, kmeans])
    return TopicFit(model, model.transform(words).select(*keep, "words", "cluster"))


def cluster_summary(clustered: DataFrame) -> DataFrame:
    """Size and class mix of each cluster."""
    return (
        clustered.groupBy("cluster")
        .agg(F.count("*").alias("tweet_count"), *v.class_counts())
        .withColumns({"pos_share": v.share("pos", "tweet_count"), "neg_share": v.share("neg", "tweet_count")})
        .orderBy("cluster")
    )


def cluster_terms(clustered: DataFrame, n: int = K.TERMS_PER_CLUSTER) -> DataFrame:
    """The most frequent words of each cluster, ranked."""
    counts = word_rows(clustered, "cluster", stops=()).groupBy("cluster", "word").agg(F.count("*").alias("count"))
    return rank_terms(counts, "cluster", n)


def terms_of_cluster(terms: DataFrame, cluster: int) -> DataFrame:
    return terms.filter(F.col("cluster") == cluster).orderBy("rank")


def cluster_shares(summary: DataFrame) -> DataFrame:
    """Unrounded class shares, one row per cluster and class."""
    parts = ["pos", "neg", "unclear"]
    wide = summary.select(
        "cluster", "tweet_count", *[(F.col(p) / F.col("tweet_count")).alias(f"{p}_share") for p in parts]
    )
    return wide.unpivot(["cluster", "tweet_count"], [f"{p}_share" for p in parts], "orientation", "share")


# --- stance classifier --------------------------------------------------------


def in_train(keys: Sequence[str], percent: int = K.TRAIN_PERCENT) -> Column:
    """Whether a row belongs to the training part, from a hash of its key.

    Unlike a random split the answer does not depend on the layout, and copies of
    a row stay on one side.
    """
    digest = F.md5(F.concat_ws("\x1f", *[column(k).cast("string") for k in keys]))
    bucket = F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint") % 100
    return bucket < percent


def hash_split(df: DataFrame, keys: Sequence[str], percent: int = K.TRAIN_PERCENT) -> tuple[DataFrame, DataFrame]:
    chosen = in_train(keys, percent)
    return df.filter(chosen), df.filter(~chosen)


@dataclass(frozen=True)
class StanceFit:
    model: PipelineModel
    train: DataFrame
    predictions: DataFrame


def stance_words(
    posts: DataFrame,
    features: Sequence[str] = K.SVM_FEATURES,
    keep: Sequence[str] = (),
    stops: Iterable[str] | None = None,
) -> DataFrame:
    """Label and words of the chosen text features of the labelled posts."""
    if not features:
        raise ValueError("the classifier needs at least one text feature")
    return labelled(posts).select(
        *keep,
        F.col("binary_label").cast("double").alias("label"),
        tk.tokens(F.concat_ws(" ", *features), stops).alias("words"),
    )


def fit_stance(
    posts: DataFrame,
    features: Sequence[str] = K.SVM_FEATURES,
    *,
    keys: Sequence[str] | None = None,
    hash_size: int = K.SVM_HASH_SIZE,
    max_iter: int = K.SVM_MAX_ITER,
    reg: float = K.SVM_REG,
    aggregation_depth: int = 2,
    partitions: int = FIT_PARTITIONS,
    max_rows: int | None = None,
) -> StanceFit:
    """A linear SVM on hashed TF-IDF features, with predictions for the held-out part.

    ``keys`` name the columns that identify a post for the split; by default its
    author, date and features do. Raise ``aggregation_depth`` on many executors: each
    iteration adds up one dense gradient per partition of the stored table. ``max_rows``
    bounds the posts that the fit learns from, chosen by the hash of their key; by
    default all of the training part are used.
    """
    keys = list(keys or dict.fromkeys(["user_id", "date", *features]))
    chosen = labelled(posts).withColumn("in_train", in_train(keys))
    chosen = chosen.withColumn("split_key", F.md5(F.concat_ws("\x1f", *[column(k).cast("string") for k in keys])))
    words = stance_words(chosen, features, keep=["in_train", "split_key"])
    train = words.filter("in_train")
    if max_rows is not None:
        train = train.orderBy("split_key").limit(max_rows)
    hashing = HashingTF(inputCol="words", outputCol="tf", numFeatures=hash_size)
    # Counts are stored once; weighing them again in each pass costs less than a second copy.
    files = files_for(labelled(posts), features, partitions)
    table = materialize(hashing.transform(train).select("split_key", "label", "tf"), "split_key", files)
    idf = IDF(inputCol="tf", outputCol="features").fit(table)
    svm = LinearSVC(
        featuresCol="features",
        labelCol="label",
        maxIter=max_iter,
        regParam=reg,
        aggregationDepth=aggregation_depth,
    ).fit(idf.transform(table).select("label", "features"))
    # A copy has no training summary. With it each task would get the whole session, which
    # cannot be sent at all once the session has observed a metric.
    svm = svm.copy()
    discard(table)
    model = PipelineModel([hashing, idf, svm])
    predictions = model.transform(words.filter("not in_train")).select("label", "prediction", "rawPrediction")
    return StanceFit(model, train.select("label"), predictions)


def confusion_matrix(predictions: DataFrame) -> DataFrame:
    return (
        predictions.groupBy("label", "prediction")
        .agg(F.count("*").alias("count"))
        .orderBy("label", "prediction")
    )


def area_under_roc(predictions: DataFrame, score: str = "rawPrediction", num_bins: int = 0) -> float:
    """Area under the ROC curve; exact, or from so many score bins as ``num_bins`` names.

    Spark sorts the distinct scores across the cluster and returns one number.
    """
    evaluator = BinaryClassificationEvaluator(labelCol="label", rawPredictionCol=score, numBins=num_bins)
    return evaluator.evaluate(predictions)


def roc_area(predictions: DataFrame, score: str = "score", label: str = "label") -> DataFrame:
    """The exact area under the ROC curve as one row of ``metric`` and ``value``, within one plan.

    The area is the share of pairs of a positive and a negative row that the score puts in
    order; equal scores count half. Rows are counted by score, the counts are dealt out by
    ranges and stored in order, and only the totals of the ranges are summed up in one place.
    Rows with a null score or label do not count; without both classes the area is null.
    """
    side = column(label).cast("double") > 0.5
    counted = predictions.filter(F.col(score).isNotNull() & F.col(label).isNotNull()).groupBy(F.col(score).alias("score"))
    counted = counted.agg(F.count_if(side).alias("pos"), F.count_if(~side).alias("neg"))
    stored = stored_in_ranges(counted, "score")
    totals = stored.groupBy("range").agg(F.sum("pos").alias("pos_in"), F.sum("neg").alias("neg_in"))
    below = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    totals = totals.select("range", F.coalesce(F.sum("neg_in").over(below), F.lit(0)).alias("neg_before"))
    within = Window.partitionBy("range").orderBy("at").rowsBetween(Window.unboundedPreceding, -1)
    ranked = stored.withColumn("neg_below", F.coalesce(F.sum("neg").over(within), F.lit(0))).join(totals, "range")
    won = F.col("pos").cast("double") * (F.col("neg_before") + F.col("neg_below") + F.col("neg") / 2)
    pairs = F.sum("pos").cast("double") * F.sum("neg")
    return ranked.agg(F.try_divide(F.sum(won), pairs).alias("value")).select(F.lit("area_under_roc").alias("metric"), "value")


def stored_in_ranges(rows: DataFrame, *keys: str) -> DataFrame:
    """``rows`` stored in ranges of the keys: the number of the ``range``, and ``at``, which ascends by one within it."""
    ordered = rows.repartitionByRange(*keys).sortWithinPartitions(*keys).withColumn("__at", F.monotonically_increasing_id())
    path = shared_dir(rows.sparkSession)
    ordered.write.parquet(path)
    stored = rows.sparkSession.read.schema(ordered.schema).parquet(path)
    return stored.select("*", F.shiftright("__at", 33).alias("range"), F.col("__at").alias("at")).drop("__at")


def _metric_columns(predictions: DataFrame, classes: Sequence[float]) -> tuple[DataFrame, list[str]]:
    counts = predictions.agg(
        F.count("*").alias("rows"),
        *[
            F.count_if((F.col("label") == a) & (F.col("prediction") == p)).alias(f"n{i}{j}")
            for i, a in enumerate(classes)
            for j, p in enumerate(classes)
        ],
    )
    size = range(len(classes))

    def add(names: Iterable[str]) -> Column:
        names = list(names)
        total = F.col(names[0])
        for name in names[1:]:
            total = total + F.col(name)
        return total

    per_class = []
    for i in size:
        hit, actual = F.col(f"n{i}{i}"), add(f"n{i}{j}" for j in size)
        guessed = add(f"n{j}{i}" for j in size)
        per_class.append((actual, v.safe_divide(hit, guessed), v.safe_divide(hit, actual), hit, guessed))

    def weighted(values: Iterable[Column]) -> Column:
        total = F.lit(0.0)
        for (actual, *_), value in zip(per_class, values):
            total = total + v.safe_divide(actual, "rows") * value
        return total

    metrics = {
        "accuracy": v.safe_divide(add(f"n{i}{i}" for i in size), "rows"),
        "f1": weighted(v.safe_divide(2 * hit, actual + guessed) for actual, _, _, hit, guessed in per_class),
        "weighted_precision": weighted(precision for _, precision, *_ in per_class),
        "weighted_recall": weighted(recall for _, _, recall, *_ in per_class),
    }
    return counts.select("rows", *[m.alias(name) for name, m in metrics.items()]), list(metrics)


def classification_metrics(predictions: DataFrame, classes: Sequence[float] = (0, 1)) -> DataFrame:
    """Accuracy and class-weighted F1, precision and recall as (metric, value) rows.

    All of them follow from the counts per (label, prediction), so one scan with one
    exchanged row per task is enough.
    """
    wide, names = _metric_columns(predictions, classes)
    return wide.unpivot([], names, "metric", "value")


def stance_metrics(fit: StanceFit, classes: Sequence[float] = (0, 1)) -> DataFrame:
    """Area under ROC, the classification metrics and the sizes of both parts."""
    wide, names = _metric_columns(fit.predictions, classes)
    train_rows = fit.train.agg(F.count("*").cast("double")).scalar()
    wide = wide.select(
        F.lit(area_under_roc(fit.predictions)).alias("area_under_roc"),
        *names,
        train_rows.alias("train_rows"),
        F.col("rows").cast("double").alias("test_rows"),
    )
    return wide.unpivot([], wide.columns, "metric", "value")


def score_metrics(metrics: DataFrame) -> DataFrame:
    """The metrics that are scores, without the row counts."""
    return metrics.filter(~F.col("metric").isin("train_rows", "test_rows"))
