"""Every registered query with SQL gives the rows that DuckDB gives."""

import math
import os

import duckdb
import pytest

from tracewell.plans.registry import queries_and_oracles

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
QUERIES, ORACLES = queries_and_oracles()
TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "pages", "conversations")


def plain(v):
    if v is None or isinstance(v, (bool, str)):
        return v
    if isinstance(v, (int, float)) or hasattr(v, "as_tuple"):
        return None if isinstance(v, float) and math.isnan(v) else float(v)
    return str(v)


def order(row):
    return tuple((x is None, f"{x:.4f}" if isinstance(x, float) else str(x)) for x in row)


def same(x, y):
    return x == y or (isinstance(x, float) and isinstance(y, float) and abs(x - y) <= 1e-6 * max(1, abs(x)))


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in TABLES:
        con.sql(f"CREATE VIEW {name} AS SELECT * FROM '{SF}/{name}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_same_rows(spark, duck, name):
    df = QUERIES[name](spark, SF)
    columns = sorted(df.columns)
    want = duck.sql(ORACLES[name])
    assert sorted(want.columns) == columns
    at = [want.columns.index(c) for c in columns]
    ours = sorted((tuple(plain(r[c]) for c in columns) for r in df.collect()), key=order)
    theirs = sorted((tuple(plain(r[i]) for i in at) for r in want.fetchall()), key=order)
    assert len(ours) == len(theirs)
    assert [(a, b) for a, b in zip(ours, theirs) if not all(map(same, a, b))] == []


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_runs(spark, name):
    assert QUERIES[name](spark, SF).limit(1).count() == 1
