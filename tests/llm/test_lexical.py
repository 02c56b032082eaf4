"""Ranked search against plain Python."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from opinionlens.llm import lexical

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms_of(text):
    return TERM.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def ranked(docs, items, top=10):
    """(item, rank, key, score); documents and items are (key, text)."""
    counts = [(key, Counter(terms_of(text))) for key, text in docs]
    counts = [(key, c, sum(c.values())) for key, c in counts if c]
    total, length = len(counts), sum(n for _, _, n in counts)
    df = Counter(t for _, c, _ in counts for t in c)
    found = []
    for item, text in items:
        scores = []
        for key, c, n in counts:
            m = 100 - 90 + 90 * n * total // length
            score = sum(
                math.floor(1000 * math.log((2 * total + 2) / (2 * df[t] + 1))) * (1000000000 * c[t] // (1000 * c[t] + 8 * m)) for t in set(terms_of(text)) if c[t]
            )
            if score > 0:
                scores.append((-score, key is None, key or 0, key))
        found += [(item, i, s[3], -s[0]) for i, s in enumerate(sorted(scores)[:top], 1)]
    return Counter(found)


def rows_of(df):
    return Counter((r["item_id"], r["rank"], r["doc_id"], r["score"]) for r in df.select("item_id", "rank", "doc_id", "score").collect())


def items_of(rows):
    rng = random.Random(9)
    texts = [t for _, t, _ in rows if t and t.strip()]
    found = []
    for i in range(30):
        words = rng.choice(texts).split()
        at = rng.randrange(len(words))
        found.append((i, " ".join(words[at : at + 30])))
    return found + [(50, None), (51, ""), (52, "!? -"), (53, "nowhere-to-be-found"), (54, "THE the The"), (55, texts[3]), (55, texts[3]), (None, texts[4]), (56, "漢字かな 😀 É é")]


def test_search(spark, docs, rows):
    """Nulls, ties, equal documents and items, and clashing columns."""
    items = items_of(rows)
    df = spark.createDataFrame([(*r, 1, "x") for r in items], "item_id bigint, text string, row int, terms string")
    expected = ranked([(d, t) for d, t, _ in rows], items)
    assert rows_of(lexical.search(docs, df)) == expected
    assert rows_of(lexical.search(docs.repartition(1), df.repartition(7))) == expected
    assert expected[(53, 1, 0, 0)] == 0 and sum(expected.values()) > 200


@pytest.mark.parametrize("owners, at_once, bundle, top", [(1, 256, 4 << 20, 10), (7, 3, 2000, 10), (3, 5, 300, 2), (4, 256, 1, 1)])
def test_other_sizes_change_nothing(spark, docs, rows, monkeypatch, owners, at_once, bundle, top):
    """Stages, bundles and pieces of texts of any size, and blocks of few documents."""
    monkeypatch.setattr(lexical, "ITEMS_AT_ONCE", at_once)
    monkeypatch.setattr(lexical, "PIECE_BYTES", 50)
    items = items_of(rows)[:12] if bundle < 1000 else items_of(rows)
    df = spark.createDataFrame(items, "item_id bigint, text string")
    found = lexical.search(docs.repartition(11), df, owners=owners, bundle_bytes=bundle, top=top)
    assert rows_of(found) == ranked([(d, t) for d, t, _ in rows], items, top)


def test_documents_that_are_left_behind(spark):
    """One block of many documents: most are lost early, and the best are still right."""
    rng = random.Random(4)
    words = [f"w{i}" for i in range(300)]
    docs = [(i, " ".join(rng.choices(words, [1 / (k + 1) for k in range(300)], k=rng.randint(5, 80)))) for i in range(900)]
    items = [(i, " ".join(rng.choices(words, k=25))) for i in range(40)]
    found = lexical.search(spark.createDataFrame(docs, "doc_id bigint, text string").coalesce(1), spark.createDataFrame(items, "item_id bigint, text string"))
    assert rows_of(found) == ranked(docs, items)


def test_accumulators_shrink():
    """After the last owner only the best of a block are carried, ties of the last one included."""
    rng = np.random.default_rng(3)
    of_item = [np.arange(20)]
    weight, owner = np.linspace(5000, 10, 20).astype(np.int64), np.repeat([0, 1], 10)
    plan = lexical.Plan(of_item, weight, owner, lexical._still_to_come(of_item, weight, owner, 2), 2000, 100_000, 10)
    carried = tuple(np.zeros(0, np.int64) for _ in range(3))
    for stage in range(2):
        n = np.full(2000, 50, np.int32)
        df = np.full(10, 1000, np.int32)
        at = np.concatenate([np.sort(rng.choice(2000, 1000, replace=False)) for _ in range(10)]).astype(np.int32)
        tf = rng.integers(1, 4, len(at)).astype(np.int32)
        term = np.flatnonzero(owner == stage).astype(np.int32)
        ((_, docs, scores),) = lexical._add(plan, stage, carried, {"n": n.tobytes(), "term": term.tobytes(), "df": df.tobytes(), "at": at.tobytes(), "tf": tf.tobytes()})
        carried = np.zeros(len(docs), np.int64), docs, scores
    assert 10 <= len(carried[1]) < 60


def test_terms():
    text = "a-B c\x00d_é9\x7f`Z[\u0080　x\nÀ" + "y" * 50
    assert [t.decode() for part in lexical.terms(text) for t in part] == terms_of(text)
    assert list(lexical.terms(None)) == list(lexical.terms("")) == []


def test_empty_sides(spark, docs, no_docs):
    items = spark.createDataFrame([(1, "the")], "item_id bigint, text string")
    assert lexical.search(no_docs, items).collect() == []
    assert lexical.search(docs, items.limit(0)).collect() == []
    assert lexical.search(docs, spark.createDataFrame([(1, None)], "item_id bigint, text string")).collect() == []
