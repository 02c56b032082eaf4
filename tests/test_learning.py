"""K-Means in whole numbers and the sparse support vector machine."""

import hashlib
import math

import numpy as np
import pyarrow as pa
import pytest
from pyspark.ml.classification import LinearSVC
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from opinionlens import session
from opinionlens.fixtures.adapters import frame
from opinionlens.operators import clustering, margin, models

THEMES = ["border wall security agents", "economy jobs inflation prices", "health care doctors hospital"]


@pytest.fixture(scope="module")
def topical(spark):
    rows = [(i, f"u{i % 9}", f"{THEMES[i % 3]} item{chr(97 + i % 5)} filler", "#t", "bio", (None, 0, 1)[i % 3], "2024-09-01") for i in range(240)]
    schema = "post_id int, user_id string, text string, hashtags string, description string, binary_label int, date string"
    return spark.createDataFrame(rows, schema).cache()


def clusters_of(posts, k=3, **options):
    fit = clustering.fit_clusters(posts, "post_id", k, keep=["post_id"], **{"min_df": 2, **options})
    return fit, {r["post_id"]: r["cluster"] for r in fit.clustered.collect()}


def test_themes_are_clusters(topical):
    fit, found = clusters_of(topical)
    assert len(found) == 240 and len({(i % 3, c) for i, c in found.items()}) == 3
    assert fit.steps < 20 and fit.clustered.columns == ["post_id", "words", "cluster"]


@pytest.mark.parametrize("seed", [42, 7])
def test_layout_does_not_matter(spark, sf_dir, seed):
    posts = frame(spark, sf_dir, "posts")
    (one, first), (seven, second) = (clusters_of(posts.repartition(n), 4, seed=seed, min_df=20) for n in (1, 7))
    assert first == second and (one.centroids == seven.centroids).all()
    assert len(set(first.values())) == 4


def test_step_against_plain_loops(spark):
    rng = np.random.default_rng(1)
    rows = []
    for i in range(60):
        terms = np.sort(rng.choice(12, rng.integers(0, 6), replace=False))
        rows.append((i, terms.tolist(), rng.integers(1, clustering.SCALE, len(terms)).tolist()))
    vectors = spark.createDataFrame(rows, "post_id int, terms array<int>, weights array<bigint>").repartition(5)
    centroids = rng.integers(0, clustering.SCALE, (4, 12))
    centroids[3] = centroids[1]  # a tie: the first one wins, and the other has no posts
    dense = np.zeros((60, 12), np.int64)
    for i, terms, weights in rows:
        dense[i, terms] = weights
    nearest = [min(range(4), key=lambda c: (int(((x - centroids[c]) ** 2).sum()), c)) for x in dense]
    assert {r["post_id"]: r["cluster"] for r in clustering.assign(vectors, centroids, ["post_id"]).collect()} == dict(enumerate(nearest))
    step = clustering.kmeans_step(vectors, centroids).collect()
    moved = clustering.as_centroids(step, 4, 12)
    for c in range(4):
        own = dense[[i for i in range(60) if nearest[i] == c]]
        assert (moved[c] == (own.sum(axis=0) // max(len(own), 1))).all()
        assert {r["posts"] for r in step if r["cluster"] == c} <= {len(own)}


def test_seeds_are_far_apart(topical):
    words = models.topic_words(topical, ["post_id"])
    terms = clustering.vocabulary(words, min_df=2)
    vectors = clustering.sparse_vectors(words, terms)
    found = clustering.seeds(vectors, "post_id", 3, len(terms.words))
    themes = {tuple(np.flatnonzero(f[[terms.words.index(t.split()[0]) for t in THEMES]])) for f in found}
    assert themes == {(0,), (1,), (2,)}
    few = clustering.seeds(vectors.limit(1), "post_id", 3, len(terms.words))
    assert (few[0] > 0).any() and not few[1:].any()  # fewer posts than clusters


def test_vectors_equal_those_of_the_ml_stages(spark, sf_dir):
    words = models.topic_words(frame(spark, sf_dir, "posts"), ["post_id"])
    terms = clustering.vocabulary(words)
    theirs = models.fit_vectors(words)
    names = theirs.stages[0].vocabulary
    expected = {(r["post_id"], names[i]): x for r in theirs.transform(words).collect() for i, x in zip(r["features"].indices, r["features"].values)}
    found = {(r["post_id"], terms.words[t]): w for r in clustering.sparse_vectors(words, terms).collect() for t, w in zip(r["terms"], r["weights"])}
    assert found.keys() == expected.keys()
    assert all(abs(w / clustering.SCALE - expected[k]) < 1e-6 for k, w in found.items())


def code_of(word, size):
    digest = hashlib.md5(word.encode()).hexdigest()
    return (int(digest[:7], 16) % size + 1) * (1 if digest[7] < "8" else -1)


def test_buckets(spark):
    words = ["economy", "jobs", "jobs", "été"]
    df = spark.createDataFrame([(1, words), (2, []), (3, None)], "post_id int, words array<string>")
    assert [r[0] for r in df.select(margin.hashed_words("words", 50)).collect()] == [[code_of(w, 50) for w in words], [], None]
    values = {r["bucket"]: r["value"] for r in margin.hashed_terms(df, "post_id", 50).collect()}
    totals: dict[int, int] = {}
    for w in words:
        totals[abs(code_of(w, 50)) - 1] = totals.get(abs(code_of(w, 50)) - 1, 0) + (1 if code_of(w, 50) > 0 else -1)
    assert values == {b: x for b, x in totals.items() if x}


def objective(w, b, x, y, reg, spread):
    side = 2 * y - 1
    return np.maximum(1 - side * (x @ w + b), 0).mean() + reg / 2 * ((w * spread) ** 2).sum()


@pytest.mark.parametrize("size, reg", [(1 << 9, 0.1), (1 << 12, 0.1)])
def test_objective_equals_that_of_spark(spark, sf_dir, size, reg):
    """On noisy labels: both machines reach the same objective on the same features."""
    words = models.stance_words(frame(spark, sf_dir, "posts"), ("text",), keep=["post_id"])
    codes = words.select("post_id", "label", margin.hashed_words("words", size).alias("codes")).cache()
    known = margin.scales(codes, size)
    rows = codes.orderBy("post_id").collect()
    x = np.zeros((len(rows), size))
    for i, r in enumerate(rows):
        np.add.at(x[i], [abs(c) - 1 for c in r["codes"]], np.sign(r["codes"]))
    assert known.posts == len(rows)
    assert np.allclose(known.idf, np.log((len(rows) + 1) / ((x != 0).sum(axis=0) + 1)))
    x *= known.idf
    assert np.allclose(known.spread, x.std(axis=0, ddof=1))
    y = np.array([r["label"] for r in rows])
    machine = margin.fit_machine(codes, size, reg=reg)
    table = spark.createDataFrame([(float(a), Vectors.dense(f)) for a, f in zip(y, x)], ["label", "features"])
    theirs = LinearSVC(maxIter=50, regParam=reg).fit(table)
    plain = np.divide(machine.weights, known.idf, out=np.zeros(size), where=known.idf > 0)
    ours = objective(plain, machine.intercept, x, y, reg, known.spread)
    assert ours <= min(machine.objectives) + 1e-9
    assert ours <= objective(theirs.coefficients.toArray(), theirs.intercept, x, y, reg, known.spread) + 1e-3
    predicted = margin.predict(codes, machine, ["post_id"]).orderBy("post_id").collect()
    assert np.allclose([r["score"] for r in predicted], x @ plain + machine.intercept)


def test_gradient_against_differences(spark, sf_dir):
    size = 64
    words = models.stance_words(frame(spark, sf_dir, "posts"), ("text",))
    codes = words.select("label", margin.hashed_words("words", size).alias("codes")).cache()
    rng = np.random.default_rng(2)
    weights = rng.normal(0, 0.02, size)

    def loss(w, b):
        return {r["bucket"]: r["gradient"] for r in margin.hinge_gradient(codes, w, b).collect()}

    here = loss(weights, 0.1)
    for bucket in (3, 40):
        step = np.zeros(size)
        step[bucket] = 1e-7
        slope = (loss(weights + step, 0.1)[size + 1] - loss(weights - step, 0.1)[size + 1]) / 2e-7
        assert slope == pytest.approx(here[bucket], rel=1e-3, abs=1e-3)
    assert (loss(weights, 0.1 + 1e-7)[size + 1] - here[size + 1]) / 1e-7 == pytest.approx(here[size], rel=1e-3)
    along = margin._losses(codes, weights, 0.1, weights, 0.0)
    assert along[list(margin.STEPS).index(1.0)] == pytest.approx(loss(2 * weights, 0.1)[size + 1])


def test_stance_machine(topical):
    fit = margin.fit_stance_machine(topical, keys=["post_id"], size=1 << 12)
    metrics = {r["metric"]: r["value"] for r in models.classification_metrics(fit.predictions).collect()}
    assert metrics["accuracy"] == 1.0 and fit.train_rows + fit.predictions.count() == 160
    assert math.isclose(min(fit.machine.objectives), fit.machine.objectives[-1], abs_tol=1e-9)
    with pytest.raises(ValueError):
        margin.fit_stance_machine(topical.filter("binary_label is null"), keys=["post_id"], size=16)


def test_a_task_works_on_slices_of_a_batch():
    """What a task holds beside a batch depends on the words of a slice, not on the batch."""
    lists = [[1, 2], [], None, [3, 4, 5, 6, 7, 8, 9], [1], [2], [3, 4]]
    batch = pa.RecordBatch.from_arrays([pa.array(lists, pa.list_(pa.int32()))], names=["terms"])
    parts = [part.column(0).to_pylist() for part in clustering._slices(batch, 0, 3)]
    assert parts == [[[1, 2], [], None], [[3, 4, 5, 6, 7, 8, 9]], [[1], [2]], [[3, 4]]]


def test_slices_and_packed_vectors_change_no_cluster(spark, topical, monkeypatch):
    words = models.topic_words(topical, ["post_id"])
    terms = clustering.vocabulary(words, min_df=1)
    whole = clustering.sparse_vectors(words, terms)
    size = len(terms.words)
    first = clustering.seeds(whole, "post_id", 3, size)
    rows = sorted(map(tuple, clustering.kmeans_step(whole, first).collect()))
    monkeypatch.setattr(clustering, "SLICE_ITEMS", 5)
    packed = clustering.sparse_vectors(words, terms, packed=True)
    assert (clustering.seeds(packed, "post_id", 3, size) == first).all()
    assert sorted(map(tuple, clustering.kmeans_step(packed, first).collect())) == rows and rows
    assert sorted(clustering.assign(packed, first, ["post_id"]).collect()) == sorted(clustering.assign(whole, first, ["post_id"]).collect())


def test_a_step_reads_its_posts_once(spark, topical):
    """The sizes of the clusters do not cost a second pass over the posts."""
    words = models.topic_words(topical, ["post_id"])
    terms = clustering.vocabulary(words, min_df=1)
    step = clustering.kmeans_step(clustering.sparse_vectors(words, terms), np.ones((2, len(terms.words)), np.int64))
    assert step._jdf.queryExecution().optimizedPlan().toString().count("MapInArrow") == 2  # the vectors, and the step


def test_files_of_a_fit_grow_with_the_texts(spark, topical, monkeypatch):
    """A fixed number of files would give each task a fixed share of any input."""
    seen = []

    def noted(df, key=None, partitions=200):
        seen.append(partitions)
        return session.materialize(df, key, partitions)

    (size,) = topical.selectExpr("sum(octet_length(concat(text, hashtags)))").first()
    monkeypatch.setattr(session, "FILE_BYTES", size // 10)
    monkeypatch.setattr(models, "materialize", noted)
    models.fit_topics(topical, 2, key="post_id", keep=["post_id"], min_df=1, partitions=3)
    models.fit_stance(topical, ["text"], keys=["post_id"], hash_size=64, max_iter=2, partitions=2)
    assert seen[0] >= 10 and seen[1] > 2
    assert session.files_for(topical, ["text"], 40) == 40
