"""Staged results, folders of exports, rounds of labels, and areas within a plan."""

import os
import random
import unicodedata

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from comparing import rows_of
from opinionlens.functions import composition
from opinionlens.functions import text as tx
from opinionlens.operators import models, users, volume
from opinionlens.plans import folders, registry
from opinionlens.sources import results
from opinionlens.sources.staging import StagedResults
from opinionlens.streaming.labels import latest_labels, relabel_files, store_batch

# --- staged results -----------------------------------------------------------


def test_results_take_their_place_together(spark, small_posts, tmp_path):
    posts, _ = small_posts
    out = str(tmp_path)
    report = {r["result"]: r["rows"] for r in registry.run_staged(posts, out, [1, 2]).collect()}
    assert report == {n: results.read_result(spark, out, n).count() for n in ("geo_distribution", "temporal_evolution")}
    assert not [f for f in os.listdir(out) if f.startswith("_staging")]
    before = rows_of(results.read_result(spark, out, "geo_distribution"))
    fewer = posts.filter("state = 'Nevada'")
    with pytest.raises(ValueError), StagedResults(spark, out) as staged:
        staged.write(volume.geo_distribution(fewer), None, "geo_distribution")
        staged.write(volume.geo_distribution(fewer), None, "no such result")
    assert rows_of(results.read_result(spark, out, "geo_distribution")) == before
    assert not [f for f in os.listdir(out) if f.startswith("_staging")]
    registry.run_staged(fewer, out, [1])
    after = rows_of(results.read_result(spark, out, "geo_distribution"))
    assert after != before and {r[0] for r in after} == {"Nevada"}
    assert results.read_result(spark, out, "temporal_evolution").count() == report["temporal_evolution"]


def test_a_result_in_several_writes(spark, small_posts, tmp_path):
    posts, _ = small_posts
    with StagedResults(spark, str(tmp_path), "parquet") as staged:
        for state in ("Nevada", "Michigan"):
            staged.write(volume.geo_distribution(posts.filter(F.col("state") == state)), None, "geo_distribution", add=True)
    whole = volume.geo_distribution(posts.filter("state in ('Nevada', 'Michigan')"))
    assert rows_of(results.read_result(spark, str(tmp_path), "geo_distribution", "parquet")) == rows_of(whole)
    assert staged.rows == {"geo_distribution": whole.count()}


def test_a_result_that_cannot_be_put_in_place(spark, small_posts, tmp_path, monkeypatch):
    """What was in place already goes back."""
    posts, _ = small_posts
    out = str(tmp_path)
    registry.run_staged(posts, out, [1, 2])
    before = rows_of(results.read_result(spark, out, "geo_distribution"))
    move = StagedResults._move

    def failing(files, path, old, new, moved):
        if "temporal_evolution" in new and "_before" not in new:
            raise OSError("no room")
        move(files, path, old, new, moved)

    monkeypatch.setattr(StagedResults, "_move", staticmethod(failing))
    with pytest.raises(OSError, match="no room"):
        registry.run_staged(posts.limit(3), out, [1, 2])
    assert rows_of(results.read_result(spark, out, "geo_distribution")) == before
    assert results.read_result(spark, out, "temporal_evolution").count() > 3


# --- folders ------------------------------------------------------------------


def write(path, text):
    path.write_text(text, encoding="utf-8")


def cleaned(spark, out):
    return {(r["source_file"], r["text"]) for r in folders.read_cleaned(spark, out).collect()}


def test_only_new_and_changed_files_are_cleaned(spark, tmp_path):
    raw, out = tmp_path / "raw", str(tmp_path / "clean")
    raw.mkdir()
    write(raw / "nevada.csv", "text,username\none #a,x\ntwo,y\n")
    write(raw / "georgia.csv", "text,Extracted_Location\nthree,Macon\n")
    assert len(folders.clean_folder(spark, str(raw), out)) == 2
    assert cleaned(spark, out) == {("nevada.csv", "one"), ("nevada.csv", "two"), ("georgia.csv", "three")}
    states = {r["source_file"]: r["state"] for r in folders.read_cleaned(spark, out).collect()}
    assert states == {"nevada.csv": "Nevada", "georgia.csv": "Georgia"}
    assert folders.clean_folder(spark, str(raw), out) == []
    kept = [f for f in (tmp_path / "clean/posts/source_file=nevada.csv").iterdir()]
    write(raw / "georgia.csv", "text,Extracted_Location\nfour,Macon\nfive longer,Rome\n")
    write(raw / "ohio.csv", "text\nsix\n")
    assert [p.rpartition("/")[2] for p in folders.clean_folder(spark, str(raw), out, files_at_once=1)] == ["georgia.csv", "ohio.csv"]
    assert cleaned(spark, out) == {("nevada.csv", "one"), ("nevada.csv", "two"), ("georgia.csv", "four"), ("georgia.csv", "five longer"), ("ohio.csv", "six")}
    assert [f for f in (tmp_path / "clean/posts/source_file=nevada.csv").iterdir()] == kept


def test_a_run_that_was_cut_short(spark, tmp_path, monkeypatch):
    raw, out = tmp_path / "raw", str(tmp_path / "clean")
    raw.mkdir()
    for i in range(3):
        write(raw / f"f{i}.csv", f"text\nword{i}\n")
    done = folders.read_raw_posts

    def failing(spark, paths, multiline):
        if "f1" in paths[0]:
            raise OSError("gone")
        return done(spark, paths, multiline)

    monkeypatch.setattr(folders, "read_raw_posts", failing)
    with pytest.raises(OSError):
        folders.clean_folder(spark, str(raw), out, files_at_once=1)
    monkeypatch.setattr(folders, "read_raw_posts", done)
    assert [p.rpartition("/")[2] for p in folders.clean_folder(spark, str(raw), out)] == ["f1.csv", "f2.csv"]
    assert {t for _, t in cleaned(spark, out)} == {"word0", "word1", "word2"}


# --- rounds of labels ---------------------------------------------------------

POST = T.StructType(
    [T.StructField("post_id", T.IntegerType()), T.StructField("text", T.StringType()), T.StructField("hashtags", T.StringType()), T.StructField("binary_label", T.IntegerType())]
)


def test_rounds_and_replays(spark, tmp_path):
    source, out, progress = (str(tmp_path / n) for n in ("posts", "labels", "progress"))
    rows = [(i, "nothing to see", "", i % 2 if i < 4 else None) for i in range(12)]
    spark.createDataFrame(rows, POST).repartition(3).write.parquet(source)
    asked = spark.sparkContext.accumulator(0)

    def says(answer):
        def model(prompts):
            asked.add(len(prompts))
            return [answer] * len(prompts)

        return model

    def labels():
        return {r["post_id"]: (r["binary_label"], r["label_status"]) for r in latest_labels(spark, out, "post_id").collect()}

    relabel_files(spark, source, POST, out, progress, label_round=1, relabel=False, max_files_per_batch=1)
    assert labels() == {i: (i % 2, "kept") if i < 4 else (None, "pending") for i in range(12)}
    relabel_files(spark, source, POST, out, progress, says("1"), label_round=2, max_files_per_batch=1)
    assert labels() == {i: (1, "model") for i in range(12)} and asked.value == 12
    # The same round again has nothing to do; new files are taken in.
    spark.createDataFrame([(99, "late", "", None)], POST).write.mode("append").parquet(source)
    relabel_files(spark, source, POST, out, progress, says("0"), label_round=2)
    assert labels()[99] == (0, "model") and labels()[0] == (1, "model") and asked.value == 13
    # A batch that is written once more replaces itself.
    batch = spark.createDataFrame([(0, "nothing", "", 0, "model")], "post_id int, text string, hashtags string, binary_label int, label_status string")
    for _ in range(2):
        store_batch(batch, out, 3, 0)
    assert spark.read.parquet(out).filter("label_round = 3").count() == 1 and labels()[0] == (0, "model")
    # A round that could not settle a post leaves what an earlier one found.
    store_batch(batch.withColumn("label_status", F.lit("error")).withColumn("binary_label", F.lit(None).cast("int")), out, 4, 0)
    assert labels()[0] == (0, "model") and len(labels()) == 13


# --- area under the curve -----------------------------------------------------


@pytest.mark.parametrize("rows", [[], [(1.0, 0.5)], [(1.0, 0.5), (0.0, 0.5)], [(1.0, 2.0), (0.0, 1.0), (0.0, 3.0), (None, 9.0), (1.0, None)]])
def test_small_areas(spark, rows):
    known = [(a, s) for a, s in rows if a is not None and s is not None]
    pairs = [(p, n) for a, p in known if a for b, n in known if not b]
    (found,) = models.roc_area(spark.createDataFrame(rows, "label double, score double")).collect()
    assert found["value"] == (sum((p > n) + (p == n) / 2 for p, n in pairs) / len(pairs) if pairs else None)


def test_area_equals_that_of_the_evaluator(spark):
    rng = random.Random(3)
    rows = [(float(rng.random() < 0.4), round(rng.gauss(0, 1), rng.choice([1, 6])) + 0.0) for _ in range(5000)]
    df = spark.createDataFrame(rows, "label double, score double").repartition(7)
    (found,) = models.roc_area(df).collect()
    assert found["value"] == pytest.approx(models.area_under_roc(df, score="score"), abs=1e-9)


# --- canonical composition ----------------------------------------------------


def composed(spark, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "i int, s string").repartition(4)
    return dict(df.select("i", composition.compose(F.col("s"))).collect())


def test_every_assigned_character(spark):
    every = [chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000 and unicodedata.category(chr(c)) not in ("Cn", "Co")]
    # A few hundred together: neighbours must not disturb each other.
    texts = ["".join(f"{c}x" for c in every[i : i + 300]) for i in range(0, len(every), 300)]
    texts += [unicodedata.normalize("NFD", t) for t in texts]
    found = composed(spark, texts)
    assert all(found[i] == unicodedata.normalize("NFC", t) for i, t in enumerate(texts))


def test_marks_in_any_number_and_order(spark):
    rng, known = random.Random(1), composition.tables()
    letters = [*known.order, *known.apart, *(p[1] for p in known.pairs), *"ᄀ가각ᅡᆨ힣", "a", "e", "o", "u", "ア", "क"]
    texts = ["".join(rng.choices(letters, k=rng.randint(1, 8))) for _ in range(6000)]
    texts += ["e" + "".join(rng.choices(list(known.order), k=300)), "", "plain", "ô" * 3, "́"]
    found = composed(spark, texts)
    assert all(found[i] == unicodedata.normalize("NFC", t) for i, t in enumerate(texts))


def test_texts_are_composed_when_they_are_repaired(spark):
    rows = [("Việt &amp; 한",), ("plain ệ",), (None,)]
    found = [r[0] for r in spark.createDataFrame(rows, "s string").select(tx.repair_text("s")).collect()]
    assert found == [unicodedata.normalize("NFC", "Việt & 한"), "plain ệ", None]


# --- users that add up --------------------------------------------------------


def test_users_of_places_add_up(spark):
    rng = random.Random(5)
    rows = [(rng.choice("ABC"), f"c{rng.randrange(4)}", rng.choice([None, *(f"u{k}" for k in range(40_000))])) for _ in range(60_000)]
    posts = spark.createDataFrame(rows, "state string, city string, user_id string").repartition(5)
    numbers = users.user_numbers(posts)
    known = {u for _, _, u in rows if u is not None}
    assert sorted(r["number"] for r in numbers.collect()) == list(range(len(known)))
    bitmaps = users.user_bitmaps(posts).cache()
    for by in (["state", "city"], ["state"], ["city"]):
        found = {tuple(r[:-1]): r["unique_users"] for r in users.united_users(bitmaps, by).collect()}
        sets: dict[tuple, set] = {}
        for s, c, u in rows:
            if u is not None:
                sets.setdefault(tuple({"state": s, "city": c}[k] for k in by), set()).add(u)
        assert found == {k: len(x) for k, x in sets.items()}
    assert users.united_users(bitmaps, []).first()["unique_users"] == len(known)
    assert users.user_bitmaps(posts.limit(0)).count() == 0
