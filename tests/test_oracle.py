"""Every query with a SQL twin gives the same rows in a second engine."""

import math
import os

import duckdb
import pytest

import __spark_entry__ as entry
from opinionlens.fixtures import catalog

QUERIES, ORACLES = catalog.QUERIES, entry.oracle_sql()
TYPES = {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE", "date": "DATE"}


@pytest.fixture(scope="module")
def tables(sf_dir):
    connection = duckdb.connect()
    for file in os.listdir(sf_dir):
        name = file.removesuffix(".parquet")
        connection.execute(f"create view {name} as select * from '{sf_dir}/{file}'")
    return connection


def _ordered(rows):
    return sorted(rows, key=lambda r: tuple((x is None, str(x)) for x in r))


@pytest.mark.parametrize("name", [n for n in QUERIES if n in ORACLES])
def test_same_rows(spark, sf_dir, tables, name):
    df = QUERIES[name](spark, sf_dir)
    columns = sorted(df.columns)
    result = tables.execute(ORACLES[name])
    found = {c[0]: str(c[1]) for c in result.description}
    names = [c[0] for c in result.description]
    expected = _ordered(tuple(r[names.index(c)] for c in columns) for r in result.fetchall())
    assert found == {f.name: TYPES[f.dataType.simpleString()] for f in df.schema}
    assert _ordered(tuple(r[c] for c in columns) for r in df.collect()) == expected
    assert expected


@pytest.mark.parametrize("name", [n for n in QUERIES if n not in ORACLES])
def test_rows_only(spark, sf_dir, name):
    rows = QUERIES[name](spark, sf_dir).collect()
    assert rows
    assert not any(isinstance(v, float) and math.isnan(v) for r in rows for v in r)


def test_entry_points(spark):
    assert set(ORACLES) <= set(entry.queries()) and set(QUERIES) <= set(entry.queries())
    assert entry.entry(spark).count() > 0
