"""Manifests against trees built in plain Python."""

import hashlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from opinionlens.llm import merkle


def digest(*texts):
    return hashlib.sha256("".join(texts).encode()).hexdigest()


def leaf_of(*values):
    return digest(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def levels_of(leaves):
    levels = [leaves]
    while len(levels[-1]) > 1:
        levels.append([digest(*levels[-1][i : i + 16]) for i in range(0, len(levels[-1]), 16)])
    return levels


def siblings(levels, i):
    found = []
    for level in levels[:-1]:
        run = i // 16 * 16
        found += [h for j, h in enumerate(level[run : run + 16], run) if j != i]
        i //= 16
    return found


def manifest(rows):
    """(key, leaf, subroot, root, proof) of rows of key, group and leaf."""
    groups = defaultdict(list)
    for key, group, leaf in rows:
        groups[group].append(((key is not None, key or 0), leaf, key))
    names = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = {g: levels_of([leaf for _, leaf, _ in sorted(groups[g], key=lambda x: x[:2])]) for g in names}
    top = levels_of([trees[g][-1][0] for g in names])
    found = []
    for at, g in enumerate(names):
        for i, (_, leaf, key) in enumerate(sorted(groups[g], key=lambda x: x[:2])):
            found.append((key, leaf, trees[g][-1][0], top[-1][0], "".join(siblings(trees[g], i) + siblings(top, at))))
    return found


def proved(df):
    return Counter((r["doc_id"], r["leaf"], r["subroot"], r["root"], r["proof"].hex()) for r in df.collect())


@pytest.mark.parametrize("levels", [0, 2])
def test_manifest(spark, docs, rows, monkeypatch, levels):
    """Nulls, ties, equal rows, groups of one row and clashing columns, in blocks of any size."""
    monkeypatch.setattr(merkle, "BLOCK_LEVELS", levels)
    known = docs.withColumn("leaf", merkle.digest_of([F.col("doc_id"), F.col("source"), F.col("text")])).withColumn("root", F.lit("x")).withColumn("index", F.lit(1))
    found = merkle.prove(known)
    assert set(found.columns) == {*known.columns, "subroot", "n_leaves", "group_index", "n_groups", "proof"}
    expected = manifest([(d, s, leaf_of(d, s, t)) for d, t, s in rows])
    assert proved(found) == Counter(expected)
    checked = merkle.verify(found, folded="kept").select("root", "kept").collect()
    assert all(r["root"] == r["kept"] for r in checked) and len(checked) == len(rows)


@pytest.mark.parametrize("levels, rows", [(1, 700), (3, 4500)])
def test_large_group(spark, monkeypatch, levels, rows):
    monkeypatch.setattr(merkle, "BLOCK_LEVELS", levels)
    table = [(i * 7919 % 100_003, "hot" if i % 50 else f"s{i % 7}", digest(str(i))) for i in range(rows)]
    df = spark.createDataFrame(table, "doc_id bigint, source string, leaf string").repartition(9)
    assert proved(merkle.prove(df)) == Counter(manifest(table))


def test_many_groups(spark):
    table = [(i, f"host{i % 613}", digest(str(i))) for i in range(1500)]
    df = spark.createDataFrame(table, "doc_id bigint, source string, leaf string").repartition(5)
    assert proved(merkle.prove(df)) == Counter(manifest(table))


def test_one_row_and_equal_rows(spark):
    schema = "doc_id bigint, source string, leaf string"
    (one,) = merkle.prove(spark.createDataFrame([(1, None, digest("a"))], schema)).collect()
    assert (one["subroot"], one["root"], bytes(one["proof"])) == (digest("a"), digest("a"), b"")
    same = [(3, "a", digest("x"))] * 40
    assert proved(merkle.prove(spark.createDataFrame(same, schema))) == Counter(manifest(same))


def test_tampering_shows(spark):
    table = [(i, "ab"[i % 2], digest(str(i))) for i in range(100)]
    proofs = merkle.prove(spark.createDataFrame(table, "doc_id bigint, source string, leaf string"))
    shown = proofs.withColumn("leaf", F.when(F.col("doc_id") % 3 == 0, F.sha2(F.lit("no").cast("binary"), 256)).when(F.col("doc_id") != 1, F.col("leaf")))
    again = merkle.prove(spark.createDataFrame(table, "doc_id bigint, source string, leaf string").withColumn("shown", F.when(F.col("doc_id") != 1, F.sha2(F.col("leaf").cast("binary"), 256))), presented="shown")
    assert all((r["folded_root"] is None) == (r["doc_id"] == 1) and r["folded_root"] != r["root"] for r in again.collect())
    for r in merkle.verify(shown).collect():
        assert (r["folded_root"] == r["root"]) == (r["doc_id"] % 3 != 0 and r["doc_id"] != 1)
        assert (r["folded_root"] is None) == (r["doc_id"] == 1)


def test_missing_nodes_are_minimal_and_enough():
    rng = np.random.default_rng(4)
    for leaves in (1, 2, 16, 17, 300, 5000):
        for _ in range(10):
            known = np.unique(rng.integers(0, leaves, rng.integers(1, 40)))
            lacking = merkle.missing_nodes(known, leaves)
            needed, derived = [], []
            at = set(known.tolist())
            for size in merkle.level_sizes(leaves):
                needed.append({j for i in at for j in range(i // 16 * 16, min(i // 16 * 16 + 16, size))} - at)
                derived.append(at)
                at = {i // 16 for i in at}
            assert [set(x.tolist()) for x in lacking] == needed


def test_digest_of_values(spark):
    df = spark.createDataFrame([(1, "é", None), (None, "", "a:b")], "a bigint, b string, c string")
    found = [r[0] for r in df.select(merkle.digest_of([F.col(c) for c in "abc"])).collect()]
    assert found == [leaf_of(1, "é", None), leaf_of(None, "", "a:b")]


def test_empty(spark):
    df = spark.createDataFrame([], "doc_id bigint, source string, leaf string")
    assert merkle.verify(merkle.prove(df)).collect() == []
