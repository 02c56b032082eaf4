import glob

import pytest
from comparing import rows_of
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from opinionlens.operators import posts, volume
from opinionlens.plans import registry
from opinionlens.sources import posts as src
from opinionlens.sources import results

HEADER = "user_id,username,description,text,hashtags,date,city,state,binary_label\n"


def test_read_posts(spark, tmp_path):
    (tmp_path / "a_tweets_cleaned.csv").write_text(
        HEADER + 'u1,n,"says ""hi"", ok",text one,#a;#b,2024-09-01,Reno,Nevada,1.0\n,,,,,,,,\n', encoding="utf-8"
    )
    (tmp_path / "b_tweets_cleaned.csv").write_text(HEADER + "u2,n,d,t,,bad, ,,N\n", encoding="utf-8")
    got = {r.user_id: (r.text, r.city, r.state, r.binary_label) for r in src.read_posts(
        spark, f"{tmp_path}/*_tweets_cleaned.csv"
    ).collect()}
    assert got == {
        "u1": ("text one", "Reno", "Nevada", 1),
        "u2": ("t", "Unknown", "Unknown", None),
        None: ("", "Unknown", "Unknown", None),
    }
    one = src.read_posts(spark, [f"{tmp_path}/a_tweets_cleaned.csv"]).filter("user_id = 'u1'").first()
    assert (one.description, str(one.date), one.binary_label) == ('says "hi", ok', "2024-09-01", 1)
    with pytest.raises(AnalysisException, match="PATH_NOT_FOUND"):
        src.read_posts(spark, f"{tmp_path}/nothing_*.csv")


def test_multiline(spark, tmp_path):
    (tmp_path / "m.csv").write_text(HEADER + 'u1,n,d,"two\nlines",,2024-09-01,Reno,Nevada,1\n', encoding="utf-8")
    assert src.read_posts(spark, str(tmp_path), multiline=True).first().text == "two\nlines"


def test_shifted_headers_raise(spark, tmp_path):
    (tmp_path / "a.csv").write_text("text,city\nx,Reno\n")
    (tmp_path / "b.csv").write_text("city,text\nTroy,y\n")
    with pytest.raises(Exception, match="CSV header does not conform"):
        src.read_csv(spark, str(tmp_path)).select("text", "city").collect()


def test_read_raw(spark, tmp_path):
    (tmp_path / "Nevada_tweets.csv").write_text("text,Extracted_Location\nhello #a,Reno\n#b,Reno\n")
    (tmp_path / "ohio.csv").write_text("Extracted_Location,text,username\nTroy,\"two\nlines\",Jo!\n")
    raw = src.read_raw_posts(spark, [f"{tmp_path}/Nevada_tweets.csv", f"{tmp_path}/ohio.csv"], multiline=True, partitions=3)
    got = posts.clean_posts(raw, file_name=src.FILE_NAME).select("text", "hashtags", "city", "username", "state")
    assert rows_of(got) == [("hello", "#a", "Reno", "", "Nevada"), ("two lines", "", "Troy", "Jo", None)]
    (tmp_path / "bad.csv").write_text("a,b\n1,2\n")
    with pytest.raises(ValueError, match="available columns"):
        src.read_raw_posts(spark, f"{tmp_path}/bad.csv")
    with pytest.raises(ValueError):
        src.read_raw_posts(spark, [])


def test_store(spark, small_posts, tmp_path):
    normal = posts.normalize_posts(
        small_posts[0].selectExpr("*", "'n' as username", "'d' as description")
    )
    src.store_posts(normal, str(tmp_path / "p"))
    stored = src.read_stored_posts(spark, str(tmp_path / "p"))
    assert rows_of(stored.select(*normal.columns)) == rows_of(normal)
    assert (tmp_path / "p" / "state=Nevada").is_dir()
    plan = stored.filter("state = 'Nevada' and binary_label = 1").select("user_id")
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(state" in text and "EqualTo(binary_label,1)" in text
    assert "ReadSchema: struct<user_id:string,binary_label:int>" in text


def test_store_as_csv(spark, small_posts, tmp_path):
    normal = posts.normalize_posts(small_posts[0].selectExpr("*", "'say \"x\", y' as description", "' n ' as username"))
    src.store_posts(normal, str(tmp_path / "c"), file_format="csv")
    assert rows_of(src.read_posts(spark, str(tmp_path / "c"))) == rows_of(normal)


def test_input_paths():
    assert src.input_paths("clean/") == ["clean/*.csv"]
    assert src.input_paths("clean", ["a.csv", "/x/b.csv", "s3a://k/c.csv"]) == ["clean/a.csv", "/x/b.csv", "s3a://k/c.csv"]


def test_results_round_trip(spark, small_posts, tmp_path):
    out = str(tmp_path)
    df = volume.temporal_evolution(small_posts[0])
    for _ in range(2):
        results.write_result(df, out, "temporal_evolution")
    tables = results.load_results(spark, out)
    assert results.available_results(tables) == ["temporal_evolution"]
    assert rows_of(tables["temporal_evolution"].drop("state_code")) == rows_of(df)
    assert "state_code" in tables["geo_distribution"].columns and tables["geo_distribution"].isEmpty()
    assert tables["metrics"].columns == ["metric", "value"]


def test_bad_dates_in_results_are_null(spark, tmp_path):
    path = tmp_path / "temporal_evolution" / "temporal_evolution"
    path.mkdir(parents=True)
    (path / "part.csv").write_text("date,state,tweet_count,pos,neg,unclear\nsoon,Nevada,1,1,0,0\n2024-09-01,Nevada,1,1,0,0\n")
    got = results.read_result(spark, str(tmp_path), "temporal_evolution")
    assert sorted(str(r.date) for r in got.collect()) == ["2024-09-01", "None"]


def test_selection():
    assert registry.select([8, "geo_distribution", 1]) == ["geo_distribution", "polarization_city"]
    assert len(registry.select()) == 10
    for wrong in (0, 11, "nothing"):
        with pytest.raises(ValueError):
            registry.select([wrong])


def test_run(spark, small_posts, tmp_path):
    df = small_posts[0].selectExpr("*", "'d' as description")
    params = registry.Params(min_df=2, max_df=0.95, k=2, top_n=5)
    paths = registry.run(df, str(tmp_path), params=params, cache=True)
    assert len(paths) == 12
    tables = results.load_results(spark, str(tmp_path))
    assert results.available_results(tables) == list(results.RESULTS)
    for name, table in tables.items():
        assert table.count() == spark.read.option("header", True).csv(results.result_path(str(tmp_path), name)).count()
    assert rows_of(tables["geo_distribution"].drop("state_code")) == rows_of(volume.geo_distribution(df))
    again = registry.run(df, str(tmp_path / "x"), [1, 4, 7], file_format="parquet")
    assert [p.rsplit("/", 1)[1] for p in again] == ["geo_distribution", "frequent_words", "word_cooccurrence"]
    with pytest.raises(ValueError):
        registry.run(df, str(tmp_path), [10], registry.Params(svm_features=()))


def test_results_are_stored_in_order(spark, tmp_path):
    """Read back file by file, a stored result has its order; operators themselves do not sort."""
    rows = [("b", "y", 3, 1), ("a", "z", 9, 2), ("a", "x", 3, 3), ("c", "w", 5, 4)]
    df = spark.createDataFrame(rows, "state string, city string, tweet_count bigint, unique_users bigint").repartition(4)
    path = results.write_result(df, str(tmp_path), "geo_distribution")
    lines = [line for part in sorted(glob.glob(f"{path}/part-*")) for line in open(part).read().splitlines()[1:]]
    assert lines == ["a,z,9,2", "c,w,5,4", "a,x,3,3", "b,y,3,1"]
    for name, keys in results.ORDERS.items():
        columns = [c.split()[0] for c in results.RESULTS[name][1].split(", ")]
        assert {k.split()[0] for k in keys} <= set(columns)
    text = volume.geo_distribution(df.withColumn("user_id", F.lit("u")))._jdf.queryExecution().executedPlan().toString()
    assert "rangepartitioning" not in text
