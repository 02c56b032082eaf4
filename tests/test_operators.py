"""Operators against plain Python over the same few hundred posts."""

import itertools
import re
from collections import Counter, defaultdict

import pytest
from comparing import rows_of
from pyspark.sql import functions as F

from opinionlens import constants as K
from opinionlens.functions import tokens as tk
from opinionlens.operators import polarization, posts, reports, subjects, tags, volume, words
from opinionlens.sources.results import in_order


def _py_tags(hashtags):
    out = []
    for piece in re.split(r"[,;\s]+", re.sub(r"[\[\]'\"{}]", " ", hashtags.lower())):
        piece = piece.strip(" ")
        if len(piece) > 1:
            out.append(piece if piece.startswith("#") else "#" + piece)
    return out


def _py_words(text, stops):
    return [w for w in re.split("[^a-z]+", text.lower()) if len(w) >= 3 and w not in stops]


def test_geo_and_time(small_posts):
    df, rows = small_posts
    users, n, days = defaultdict(set), Counter(), defaultdict(Counter)
    for r in rows:
        n[r["state"], r["city"]] += 1
        if r["user_id"]:
            users[r["state"], r["city"]].add(r["user_id"])
        days[r["date"], r["state"]][r["binary_label"]] += 1
    geo = volume.geo_distribution(df)
    assert {(r.state, r.city): (r.tweet_count, r.unique_users) for r in geo.collect()} == {
        k: (c, len(users[k])) for k, c in n.items()
    }
    counts = [r.tweet_count for r in in_order(geo, "geo_distribution").collect()]
    assert counts == sorted(counts, reverse=True)
    got = {(str(r.date) if r.date else None, r.state): r for r in volume.temporal_evolution(df).collect()}
    assert got.keys() == days.keys()
    for key, c in days.items():
        r = got[key]
        assert (r.pos, r.neg, r.unclear, r.tweet_count) == (c[1], c[0], c[None], sum(c.values()))

    kpis = volume.overview_kpis(df).first()
    known = {r["user_id"] for r in rows if r["user_id"]}
    assert tuple(kpis) == (len(rows), sum(map(len, users.values())), len(known), len(n))
    for r in volume.state_volume(df).collect():
        mine = [x for x in rows if x["state"] == r.state]
        assert r.tweet_count == len(mine)
        assert r.unique_users == len({x["user_id"] for x in mine if x["user_id"]})
        assert r.unique_users_by_city_sum == sum(len(u) for (s, _), u in users.items() if s == r.state)


def test_empty_input(small_posts):
    df = small_posts[0].filter("false")
    assert volume.overview_kpis(df).first().asDict() == {
        "tweet_count": 0, "unique_users_by_city_sum": 0, "unique_users": 0, "active_cities": 0
    }
    for result in (
        volume.geo_distribution(df), tags.top_hashtags(df), words.word_cooccurrence(df), words.tfidf_terms(df),
        subjects.keyword_comparison(df), polarization.polarization_city(df), volume.state_volume(df),
    ):
        assert result.count() == 0


def test_hashtags(spark, small_posts):
    df, rows = small_posts
    counts = Counter(t for r in rows for t in _py_tags(r["hashtags"]))
    assert [tuple(r) for r in tags.top_hashtags(df, 3).collect()] == sorted(
        counts.items(), key=lambda kv: (-kv[1], kv[0])
    )[:3]
    lists = ["['#A', \"b c\"]", "##;#;x;yy", " #Mixed,CASE\n#a", ""]
    messy = spark.createDataFrame([(i, t) for i, t in enumerate(lists)], "i int, hashtags string")
    got = defaultdict(list)
    for r in tags.tag_rows(messy, "i").collect():
        got[r.i].append(r.hashtag)
    assert dict(got) == {0: ["#a"], 1: ["##", "#yy"], 2: ["#mixed", "#case", "#a"]}


def test_distinctive(spark, small_posts):
    df, rows = small_posts
    by_tag = defaultdict(Counter)
    for r in rows:
        if r["binary_label"] in (0, 1):
            by_tag.update({})
            for t in _py_tags(r["hashtags"]):
                by_tag[t][r["binary_label"]] += 1
    got = tags.distinctive_hashtags(df, min_count=20).collect()
    assert {r.hashtag: (r.pos_count, r.neg_count) for r in got} == {
        t: (c[1], c[0]) for t, c in by_tag.items() if sum(c.values()) >= 20
    }
    for r in got:
        assert r.orientation_score == pytest.approx((r.pos_count - r.neg_count) / r.total_count, abs=5e-5)
        assert r.distinctiveness_score == abs(r.orientation_score)

    # A lean that rounds to zero is balanced although the counts differ.
    near = spark.range(30001).select(
        F.lit("#t").alias("hashtags"), F.when(F.col("id") <= 15000, 1).otherwise(0).alias("binary_label")
    )
    row = tags.distinctive_hashtags(near).first()
    assert (row.pos_count, row.neg_count, row.dominant_orientation) == (15001, 15000, "BALANCED")


def test_tag_extremes(spark):
    rows = [(f"#t{i}", 10, (i - 20) / 20) for i in range(41)] + [("#tie", 99, 1.0)]
    df = spark.createDataFrame(rows, "hashtag string, total_count long, orientation_score double")
    got = tags.tag_extremes(df, 3).collect()
    assert [r.hashtag for r in got] == ["#t0", "#t1", "#t2", "#tie", "#t40", "#t39"]


def test_words(spark, small_posts):
    df, rows = small_posts
    stops = set(tk.stop_words())
    assert {"the", "amp"} <= stops and "it" not in stops
    lists = [_py_words(r["text"], stops) for r in rows]
    counts = Counter(itertools.chain(*lists))
    top = sorted(counts.items(), key=lambda kv: (-kv[1], kv[0]))
    assert [tuple(r) for r in words.frequent_words(df, 5).collect()] == top[:5]
    tokenized = words.add_tokens(df)
    assert [r.words for r in tokenized.orderBy("post_id").collect()] == lists
    assert rows_of(words.frequent_words(tokenized.select("words"))) == rows_of(words.frequent_words(df))

    chosen = {w for w, _ in top[:5]}
    pairs = Counter(p for ws in lists for p in itertools.combinations(sorted(chosen.intersection(ws)), 2))
    expected = sorted(((a, b, n) for (a, b), n in pairs.items()), key=lambda x: (-x[2], x[0], x[1]))[:7]
    assert [tuple(r) for r in words.word_cooccurrence(df, 5, 7).collect()] == expected
    assert [tuple(r) for r in words.word_cooccurrence(tokenized, 5, 7).collect()] == expected

    by_state = defaultdict(Counter)
    for r, ws in zip(rows, lists):
        by_state[r["state"]].update(ws)
    ranked = {
        (s, i + 1): kv
        for s, c in by_state.items()
        for i, kv in enumerate(sorted(c.items(), key=lambda kv: (-kv[1], kv[0]))[:2])
    }
    assert {(r.state, r["rank"]): (r.word, r["count"]) for r in words.group_top_terms(df, "state", 2).collect()} == ranked

    docs = Counter(w for ws in lists for w in set(ws))
    got = {r.word: (r.term_count, r.doc_count) for r in words.tfidf_terms(df, min_df=2, max_df=0.9).collect()}
    assert got == {w: (counts[w], d) for w, d in docs.items() if 2 <= d <= 0.9 * len(rows)}


def test_single_word_posts_make_no_pairs(spark):
    df = spark.createDataFrame([("economy",), ("",), ("economy economy",), ("economy jobs",)], "text string")
    assert [tuple(r) for r in words.word_cooccurrence(df).collect()] == [("economy", "jobs", 1)]


def test_top_words_break_ties_by_name(spark):
    df = spark.createDataFrame([("zebra apple mango",)], "text string")
    assert [r.word for r in words.frequent_words(df, 2).collect()] == ["apple", "mango"]


def test_keyword_comparison(spark):
    rows = [
        ("Nevada", "Trump and Harris", ""), ("Nevada", "trumpism", "#MAGA"), ("Nevada", "nothing", ""),
        ("Ohio", "vote blue", ""), ("Ohio", "", ""),
    ]
    df = spark.createDataFrame(rows, "state string, text string, hashtags string")
    got = {r.state: tuple(r)[1:] for r in subjects.keyword_comparison(df).collect()}
    assert got == {"Nevada": (3, 2, 1, 1, 0, 1, 0.6667, 0.3333), "Ohio": (2, 0, 1, 0, 1, 0, 0.0, 0.5)}


def test_polarization(small_posts):
    df, rows = small_posts
    per_user = defaultdict(Counter)
    for r in rows:
        if r["user_id"] and r["binary_label"] is not None:
            per_user[r["state"], r["city"], r["user_id"]][r["binary_label"]] += 1

    def side(c):
        return "POS" if c[1] > c[0] else "NEG" if c[0] > c[1] else "BALANCED"

    users = polarization.user_orientation(df).collect()
    assert {(r.state, r.city, r.user_id): (r.pos_tweets, r.neg_tweets, r.user_orientation) for r in users} == {
        k: (c[1], c[0], side(c)) for k, c in per_user.items()
    }
    sides = defaultdict(Counter)
    for (state, city, _), c in per_user.items():
        sides[state, city][side(c)] += 1
    cities = polarization.polarization_city(df)
    for r in cities.collect():
        c = sides.pop((r.state, r.city))
        assert (r.pos_users, r.neg_users, r.balanced_users) == (c["POS"], c["NEG"], c["BALANCED"])
        assert r.user_polarization_score == pytest.approx(abs(c["POS"] - c["NEG"]) / sum(c.values()), abs=5e-5)
    assert not sides
    assert polarization.polarization_city(df, min_users=10**6).count() == 0

    states = polarization.polarization_state(cities)
    long = polarization.polarization_unpivot(states)
    assert long.count() == 3 * states.count()
    assert long.agg(F.sum("users")).first()[0] == cities.agg(F.sum("classified_users")).first()[0]
    bounds = polarization.label_bounds(cities).first()
    assert bounds.max_classified_users == max(r.classified_users for r in cities.collect())
    shown = polarization.polarized_cities(cities, n=2).collect()
    assert len(shown) == 2 and shown[0].area == f"{shown[0].city}, {shown[0].state}"


def test_state_score_of_no_users(spark):
    df = spark.createDataFrame(
        [("A", 0, 0, 0, 0)], "state string, classified_users long, pos_users long, neg_users long, balanced_users long"
    )
    assert polarization.polarization_state(df).first().user_polarization_score == 0.0


def test_reports(small_posts):
    df, rows = small_posts
    geo, temporal = volume.geo_distribution(df), volume.temporal_evolution(df)
    rollup = reports.geo_rollup(geo).collect()
    assert [r.tweet_count for r in rollup if r.level == 3] == [len(rows)]
    assert sum(r.tweet_count for r in rollup if r.level == 1) == len(rows)
    assert reports.top_state(geo).first().state == Counter(r["state"] for r in rows).most_common(1)[0][0]
    assert reports.daily_volume(temporal).agg(F.sum("tweet_count")).first()[0] == len(rows)
    daily = reports.daily_composition(temporal)
    assert daily.agg(F.sum(F.col("pos") + F.col("neg") + F.col("unclear"))).first()[0] == len(rows)
    assert reports.city_ranking(geo, "unique_users", 3).count() == 3
    names = [r.state for r in reports.distinct_states([geo, temporal, df.select("text")]).collect()]
    assert sorted(names) == sorted({r["state"] for r in rows})


def test_filters_and_codes(spark, small_posts):
    geo = volume.geo_distribution(small_posts[0])
    assert posts.filter_states(geo, []) is geo
    assert posts.filter_states(geo.drop("state"), ["Nevada"]).count() == geo.count()
    assert {r.state for r in posts.filter_states(geo, ["Nevada"]).collect()} == {"Nevada"}
    coded = posts.with_state_code(geo)
    assert {(r.state, r.state_code) for r in coded.collect()} == {("Nevada", "NV"), ("Michigan", "MI"), ("Unknown", None)}
    assert posts.with_state_code(geo, drop_unknown=True).filter("state = 'Unknown'").count() == 0


def test_label_pivot_fills_absent_pairs(spark):
    df = spark.createDataFrame([(0.0, 0.0, 5), (1.0, 0.0, 2)], "label double, prediction double, count long")
    assert rows_of(reports.label_pivot(df)) == [(0.0, 5, 0), (1.0, 2, 0)]


@pytest.mark.parametrize("partitions", [1, 7])
def test_layout_does_not_matter(small_posts, partitions):
    df = small_posts[0]
    moved = df.repartition(partitions)
    for operator in (
        volume.geo_distribution, volume.temporal_evolution, tags.top_hashtags, tags.distinctive_hashtags,
        words.frequent_words, words.word_cooccurrence, subjects.keyword_comparison, polarization.polarization_city,
    ):
        assert rows_of(operator(df)) == rows_of(operator(moved))


def test_clean_posts(spark):
    raw = spark.createDataFrame(
        [
            ("u1", "see http://q#frag #Été &amp; more 😀", "Reno", "Reno, NV", "A!", "x_y  z", "nevada_tweets.csv"),
            ("u2", "#only #tags http://x", "Reno", "", "B", None, "nevada_tweets.csv"),
            ("u3", None, "Reno", "", "B", None, "nevada_tweets.csv"),
            ("u4", "kept", None, "", None, "", "ohio.csv"),
        ],
        "user_id string, text string, Extracted_Location string, location_raw string, username string, "
        "description string, file string",
    )
    got = posts.clean_posts(raw, file_name="file")
    assert got.columns == ["user_id", "text", "hashtags", "city", "username", "description", "state"]
    assert rows_of(got) == [
        ("u1", "see & more", "#frag;#Été", "Reno", "A", "xy z", "Nevada"),
        ("u4", "kept", "", None, "", "", None),
    ]
    assert posts.clean_posts(raw, drop_blank=False).count() == 4
    with pytest.raises(ValueError, match="text.*available columns"):
        posts.clean_posts(raw.drop("text"))


def test_normalize_posts(spark):
    raw = spark.createDataFrame(
        [(1, None, "n", None, None, None, "10/01/2024", " ", None, "1.0"), (2, "u", None, "d", "t", "h", "2024-09-01", " Reno ", "X", "")],
        "id int, user_id string, username string, description string, text string, hashtags string, date string, "
        "city string, state string, binary_label string",
    )
    a, b = posts.normalize_posts(raw, keep=["id"]).orderBy("id").collect()
    assert tuple(a) == (1, None, "n", "", "", "", None, "Unknown", "Unknown", 1)
    assert (b.city, str(b.date), b.binary_label) == ("Reno", "2024-09-01", None)
    assert posts.normalize_posts(raw.drop("binary_label")).select("binary_label").first()[0] is None
    coverage = posts.label_coverage(posts.normalize_posts(raw)).first()
    assert tuple(coverage) == (2, 1)
    with pytest.raises(ValueError):
        posts.normalize_posts(raw.drop("city"))


def test_fixed_values():
    assert len(K.NEG_PATTERNS) == len(K.POS_PATTERNS) == 13
    assert len(K.EMOJI_RANGES) == 8 and len(K.STATE_CODES) == len(K.STATE_BY_FILE_KEY) == 7
