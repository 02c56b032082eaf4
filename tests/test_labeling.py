import re
from functools import partial

import pytest
from comparing import rows_of
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F
from pyspark.sql import types as T

from opinionlens import session
from opinionlens.fixtures import catalog
from opinionlens import constants as K
from opinionlens.operators import labeling
from opinionlens.streaming.labels import label_new_files


def _python_rule(text, tags):
    content = f"{text} {tags}".lower()
    for patterns, label in ((K.NEG_PATTERNS, 0), (K.POS_PATTERNS, 1)):
        if any(re.search(p, content) for p in patterns):
            return label
    return None


TEXTS = [
    ("Never Trump! Vote blue.", "#Trump2024"),
    ("Marc plays on!!! VOTE BLUE❤️", ""),
    ("Trump 2024. Make America Great Again!", "#MAGA"),
    ("Kamala Harris will destroy America.", "#KamalaHarris2024"),
    ("Kamala has the worst case of TDS", ""),
    ("an endorsement of Kamala Harris.", "#KamalaHarris2024"),
    ("reports that Trump will hold a rally", "#Election2024"),
    ("vote  blue", ""), ("voteblue", "#VoteBlue"), ("x", "#voteblues"), ("antitrump", ""), ("anti maga", ""),
    ("anti trump", ""), ("trump2024", ""), ("mytrump 2024", ""), ("évote blue", ""), ("vote blueé", ""),
    ("trump " + "x" * 75 + " treason", ""), ("trump " + "x" * 90 + " treason", ""),
    ("trump\nis a coward", ""), ("trump\ris a coward", ""), ("trump is a coward", ""),
    ("a coward, that trump", ""), ("trump 😀 coward", ""), ("democrat weak", ""), ("democrats are failed", ""),
    ("biden garbage", ""), ("why are you so obsessed with trump", ""), ("stop trump 2024", ""), ("", ""),
]


def test_rules_follow_python(spark):
    df = spark.createDataFrame([(i, a, b) for i, (a, b) in enumerate(TEXTS)], "i int, text string, tags string")
    got = [r[0] for r in df.orderBy("i").select(labeling.rule_label("text", "tags")).collect()]
    assert got == [_python_rule(a, b) for a, b in TEXTS]
    assert {0, 1, None} == set(got)


def test_own_patterns(spark):
    df = spark.createDataFrame([("good stuff", ""), ("bad", ""), ("goodness", "")], "text string, tags string")
    got = df.select(labeling.rule_label("text", "tags", [r"\bbad\b"], [r"\bgood\b"])).collect()
    assert [r[0] for r in got] == [1, 0, None]


def test_prompt(spark):
    df = spark.createDataFrame([("say {hashtags} {x}", "#a;#b"), ("t", ""), (None, None)], "text string, tags string")
    got = [r[0] for r in df.select(labeling.build_prompt("text", "tags", "T:{text} H:{hashtags}.")).collect()]
    assert got == ["T:say {hashtags} {x} H:#a;#b.", f"T:t H:{K.NO_TAGS_WORD}.", f"T: H:{K.NO_TAGS_WORD}."]


@pytest.mark.parametrize(
    "answer, label",
    [
        ("1", 1), (" 0\n", 0), ("ANSWER: 0", 0), ("Risposta: 1", 1), ("10", None), ("neutral", None),
        ("N", None), ("n", None), ('"1".', 1), ("", None), (None, None), ("N, not 1", None), ("a1 0", 0),
    ],
)
def test_answers(spark, answer, label):
    df = spark.createDataFrame([(answer,)], "a string")
    assert df.select(labeling.parse_answer("a")).first()[0] == label


@pytest.fixture
def stance(spark):
    rows = [
        (1, "vote blue", "", 1), (2, "vote blue", "", None), (3, "vote red", "", None), (4, "ask one", "", None),
        (5, "ask zero", "", None), (6, "ask none", "", None), (7, "fail", "", None), (8, None, None, None),
    ]
    return spark.createDataFrame(rows, "id int, text string, hashtags string, binary_label int").repartition(3)


def _model():
    def predict(prompts):
        import re as regex

        out = []
        for p in prompts:
            text = regex.search(r"Post: (.*)\n", p).group(1)
            if text == "fail":
                raise ConnectionError("down")
            if text.startswith("vote"):
                raise AssertionError("decided posts must not be asked")
            out.append({"ask one": "1", "ask zero": "Answer: 0"}.get(text, "N"))
        return out

    return predict


def _labels(df):
    return {r.id: (r.binary_label, r.label_status) for r in df.collect()}


def test_label_posts(stance):
    rules = _labels(labeling.label_posts(stance))
    assert rules[1] == (1, "kept") and rules[2] == (0, "rule") and rules[3] == (1, "rule")
    assert rules[4] == (None, "pending")
    got = _labels(labeling.label_posts(stance, _model(), backoff=0.0, batch_size=1))
    assert got == {
        1: (1, "kept"), 2: (0, "rule"), 3: (1, "rule"), 4: (1, "model"), 5: (0, "model"),
        6: (None, "neutral"), 7: (None, "error"), 8: (None, "neutral"),
    }
    assert _labels(labeling.label_posts(stance, relabel=True))[1] == (0, "rule")
    assert _labels(labeling.label_posts(stance.drop("hashtags", "binary_label")))[2] == (0, "rule")


def test_failed_batch_is_tried_again(spark, tmp_path):
    mark = str(tmp_path / "tries")

    def flaky(prompts):
        with open(mark, "a") as f:
            f.write("x")
        with open(mark) as f:
            if len(f.read()) < 3:
                raise ConnectionError
        return ["1"] * len(prompts)

    df = spark.createDataFrame([(1, "t")], "id int, text string")
    assert _labels(labeling.label_posts(df, flaky, backoff=0.0)) == {1: (1, "model")}
    too_few = labeling.label_posts(df, lambda prompts: [], backoff=0.0)
    assert _labels(too_few) == {1: (None, "error")}


def test_faults_of_the_hook_are_raised(spark):
    df = spark.createDataFrame([(1, "t")], "id int, text string")

    def broken(prompts):
        return [p.no_such_name for p in prompts]

    with pytest.raises(Exception, match="no_such_name"):
        labeling.label_posts(df, broken, backoff=0.0).collect()

    def moody(prompts):
        raise KeyError("overloaded")

    assert _labels(labeling.label_posts(df, moody, backoff=0.0, retryable=(KeyError,))) == {1: (None, "error")}


def test_stream_asks_again_after_an_outage(spark, stance, tmp_path):
    src, out, progress = (str(tmp_path / n) for n in ("in", "out", "progress"))
    stance.write.parquet(src)
    run = partial(label_new_files, spark, src, T.StructType(stance.schema.fields), out, progress, backoff=0.0)

    def away(prompts):
        raise TimeoutError("away")

    with pytest.raises(StreamingQueryException):
        run(away)
    run(lambda prompts: ["1"] * len(prompts))
    got = spark.read.parquet(out)
    assert got.count() == 8
    assert _labels(got) == _labels(labeling.label_posts(stance, lambda prompts: ["1"] * len(prompts)))


def test_still_to_label(stance):
    done = labeling.label_posts(stance, _model(), backoff=0.0, batch_size=1)
    assert [r.id for r in labeling.still_to_label(stance, done, "id").collect()] == [7]
    assert [r.id for r in labeling.still_to_label(stance, done.filter("id > 2"), ["id"]).orderBy("id").collect()] == [1, 2, 7]


def test_stream_resumes(spark, stance, tmp_path):
    src, out, progress = (str(tmp_path / n) for n in ("in", "out", "progress"))
    schema = T.StructType(stance.schema.fields)
    for part in ("id <= 3", "id > 3 and id <= 6", "id > 6"):
        stance.filter(part).coalesce(1).write.mode("append").parquet(src)
        label_new_files(spark, src, schema, out, progress, max_files_per_batch=1)
    label_new_files(spark, src, schema, out, progress)
    got = spark.read.parquet(out)
    assert got.count() == 8
    assert _labels(got) == _labels(labeling.label_posts(stance))


def test_stream_prepares_rows(spark, stance, tmp_path):
    src, out, progress = (str(tmp_path / n) for n in ("in", "out", "progress"))
    stance.write.parquet(src)
    label_new_files(
        spark, src, stance.schema, out, progress, prepare=lambda d: d.withColumn("text", F.lit("vote red")), relabel=True
    )
    assert rows_of(spark.read.parquet(out).select("binary_label").distinct()) == [(1,)]


# --- calls that overlap -------------------------------------------------------


def replies_of(spark, model, prompts, **options):
    df = spark.createDataFrame(list(enumerate(prompts)), "i int, prompt string").coalesce(1)
    found = df.select("i", labeling.model_answers(model, **options)("prompt").alias("reply")).collect()
    return [r["reply"] for r in sorted(found, key=lambda r: r["i"])]


def test_calls_overlap_and_keep_their_order(spark):
    import time

    def slow(prompts):
        time.sleep(0.4 if prompts[0] == "p0" else 0.1)  # the first is the last to end
        return [p.upper() for p in prompts]

    prompts = [None if i % 7 == 3 else f"p{i}" for i in range(60)]
    expected = [p and p.upper() for p in prompts]
    took = {}
    for in_flight in (1, 8):
        start = time.monotonic()
        assert replies_of(spark, slow, prompts, batch_size=2, in_flight=in_flight) == expected
        took[in_flight] = time.monotonic() - start
    assert took[8] < took[1] - 1


def test_calls_are_spaced_and_end_in_time(spark):
    import time

    starts = replies_of(spark, lambda p: [str(time.monotonic())] * len(p), ["x"] * 6, batch_size=1, in_flight=6, per_second=10)
    times = sorted(map(float, starts))
    assert all(b - a > 0.08 for a, b in zip(times, times[1:]))

    def late(prompts):
        time.sleep(0.5)
        return ["1"] * len(prompts)

    found = replies_of(spark, late, ["x"] * 6, batch_size=1, in_flight=2, deadline=0.3)
    assert found == ["1", "1", None, None, None, None]
    with pytest.raises(Exception, match="time for a batch is over"):
        replies_of(spark, late, ["x"] * 6, batch_size=1, deadline=0.3, give_up=False)


def test_failures_among_overlapping_calls(spark):
    def moody(prompts):
        if prompts[0] == "bad":
            raise ConnectionError("away")
        return ["1"] * len(prompts)

    prompts = ["a", "bad", "b", "c", "bad", "d"]
    found = replies_of(spark, moody, prompts, batch_size=1, in_flight=4, retries=2, backoff=0.01)
    assert found == ["1", None, "1", "1", None, "1"]
    with pytest.raises(Exception, match="away"):
        replies_of(spark, moody, prompts, batch_size=1, in_flight=4, retries=2, backoff=0.01, give_up=False)


def test_posts_to_relabel_lie_in_more_files_where_there_is_more_text(spark, tmp_path, monkeypatch):
    """Four files would give one task a quarter of any input; the rounds still have two batches each."""
    docs = spark.range(60).selectExpr("id as doc_id", "repeat('some words ', 20) as text", "'en' as lang", "'src1' as source", "220L as n_chars")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    docs.selectExpr("doc_id", "cast(doc_id % 2 as int) as quality", "0 as toxic").write.parquet(f"{tmp_path}/labels.parquet")
    monkeypatch.setattr(session, "FILE_BYTES", 1000)
    monkeypatch.setattr(catalog, "shared_dir", lambda s: f"{tmp_path}/run")
    assert catalog.QUERIES["label_relabel"](spark, str(tmp_path)).count() == 60
    assert len(list((tmp_path / "run" / "posts").glob("*.parquet"))) >= 12
    assert len(list((tmp_path / "run" / "labelled" / "label_round=1").glob("label_batch=*"))) == 2
