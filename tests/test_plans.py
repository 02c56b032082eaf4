"""What the plans must look like for the operators to work on large data."""

import re

import pytest
from pyspark.sql import functions as F

from opinionlens.operators import labeling, polarization, posts, subjects, tags, volume, words
from opinionlens.session import discard, materialize, shared_dir


@pytest.fixture(scope="module")
def stored(spark, small_posts):
    path = shared_dir(spark)
    small_posts[0].selectExpr("*", "'d' as description", "'n' as username").write.parquet(path)
    return spark.read.parquet(path)


def plan(df):
    return re.sub(r"#\d+L?", "", df._jdf.queryExecution().executedPlan().toString())


def exchanges(text):
    return len(re.findall(r"Exchange hashpartitioning|Exchange SinglePartition|Exchange rangepartitioning", text))


def test_scans_read_only_what_is_needed(stored):
    assert "ReadSchema: struct<user_id:string,city:string,state:string>" in plan(volume.geo_distribution(stored))
    assert "ReadSchema: struct<hashtags:string>" in plan(tags.top_hashtags(stored))
    assert "ReadSchema: struct<text:string>" in plan(words.frequent_words(stored))
    text = plan(polarization.polarization_city(stored))
    assert "In(binary_label, [0,1])" in text and "IsNotNull(user_id)" in text and "text:string" not in text


def test_distinct_users_are_grouped_by_user_first(stored):
    text = plan(volume.geo_distribution(stored))
    assert "hashpartitioning(state, city, user_id" in text and "Expand" not in text


def test_top_lists_need_no_global_sort(stored):
    for df in (tags.top_hashtags(stored), words.frequent_words(stored), tags.distinctive_hashtags(stored)):
        text = plan(df)
        assert "TakeOrderedAndProject" in text and "rangepartitioning" not in text and exchanges(text) == 1


def test_group_lists_are_cut_before_the_exchange(stored):
    assert "WindowGroupLimit" in plan(words.group_top_terms(stored, "state"))


def test_cooccurrence_neither_joins_nor_shuffles_posts(stored):
    text = plan(words.word_cooccurrence(stored))
    assert "Join" not in text and "Cartesian" not in text
    assert set(re.findall(r"Exchange hashpartitioning\((\w+(?:, \w+)*), \d+\)", text)) == {"word_a, word_b", "word"}
    # The words of a post are found once in the main branch and once for the word list.
    assert text.split("Subquery subquery")[0].count("regexp_extract_all") <= 1


def test_keyword_comparison_matches_each_pattern_once(stored):
    text = plan(subjects.keyword_comparison(stored))
    assert text.count("RLIKE") == 2


def test_cleaning_and_labelling_are_narrow(stored):
    cleaned = posts.clean_posts(stored)
    text = plan(cleaned)
    assert "Exchange" not in text and "Filter " not in text
    labelled = plan(labeling.label_posts(stored))
    assert "Exchange" not in labelled and labelled.count("RLIKE") == 2
    asked = plan(labeling.label_posts(stored, lambda prompts: ["N"] * len(prompts)))
    assert asked.count("ArrowEvalPython [") == 1 and "Exchange" not in asked


def test_no_operator_collects_or_crosses(stored):
    for df in (
        volume.overview_kpis(stored), volume.state_volume(stored), subjects.keyword_comparison(stored),
        words.tfidf_terms(stored), polarization.polarization_city(stored),
    ):
        text = plan(df)
        assert "CartesianProduct" not in text and "NestedLoop" not in text


def test_plans_do_not_depend_on_the_number_of_files(spark, stored, tmp_path):
    """One file or fifty: the same plan, but for names of files and columns."""
    plans = []
    for files in (1, 50):
        path = str(tmp_path / str(files))
        stored.repartition(files).write.parquet(path)
        posts = spark.read.parquet(path)
        shown = [plan(df) for df in (
            words.frequent_words(posts), subjects.keyword_comparison(posts), labeling.label_posts(posts), words.word_cooccurrence(posts),
        )]
        plans.append([re.sub(r"Location: .*?\]|plan_id=\d+|\d+ paths|expr_id=\d+|subquery#\w*|\[id=.*?\]", "", x).replace(path, "") for x in shown])
    assert plans[0] == plans[1]


def test_fit_tables_have_the_given_partitions_and_are_removed(spark, stored, monkeypatch):
    from opinionlens.operators import models

    seen = []

    def noted(df, key=None, partitions=200):
        seen.append(materialize(df, key, partitions))
        assert seen[-1].select(F.input_file_name()).distinct().count() == partitions
        return seen[-1]

    monkeypatch.setattr(models, "materialize", noted)
    fit = models.fit_topics(stored, 2, key="post_id", keep=["post_id", "binary_label"], min_df=1, partitions=3)
    models.fit_stance(stored, ["text"], keys=["post_id"], hash_size=64, max_iter=2, partitions=2)
    assert [t.columns for t in seen] == [["post_id", "features"], ["split_key", "label", "tf"]]
    assert fit.clustered.count() == stored.count()
    from py4j.protocol import Py4JJavaError
    from pyspark.errors import PySparkException

    for table in seen:
        with pytest.raises((PySparkException, Py4JJavaError)):
            table.collect()


def test_materialize(spark, stored):
    table = materialize(stored.select("post_id", "text"), "post_id", 3)
    assert table.count() == stored.count() and "FileScan parquet" in plan(table)
    assert len({r[0] for r in table.select(F.input_file_name()).collect()}) == 3
    kept = materialize(stored.select("text"))
    assert kept.count() == stored.count()
    discard(kept)


def test_shared_dir_needs_the_cluster_setting(spark):
    root = spark.conf.get("spark.checkpoint.dir")
    first, second = shared_dir(spark), shared_dir(spark)
    assert first.startswith(root) and first != second
