"""Every registered query against its SQL twin in DuckDB on the smallest
test tables: same column names, same rows (order-insensitive, exact values)."""

import math

import duckdb
import pytest

import __spark_entry__ as E
from quarry.plans import catalog

SF = "/root/testdata/sf0.001"
TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    yield con
    con.close()


def norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(v)
    if hasattr(v, "isoformat"):
        return v.isoformat()
    return v


def key(row):
    return tuple((x is None, str(x)) for x in row)


def test_every_query_has_sql():
    assert set(E.oracle_sql()) <= set(E.queries())
    missing = set(catalog.QUERIES) - set(E.oracle_sql())
    assert missing == set(), missing


def test_columns_are_unique_and_named(spark):
    for name, fn in catalog.QUERIES.items():
        cols = fn(spark, SF).columns
        assert len(cols) == len(set(cols)), (name, cols)
        assert all(c and not c.startswith("_") and "(" not in c for c in cols), (name, cols)


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.columns == ["title", "avg_rating", "n_ratings"] and df.count() > 0


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_query_matches_sql(spark, duck, name):
    sdf = E.queries()[name](spark, SF)
    res = duck.execute(E.oracle_sql()[name])
    dcols = [d[0] for d in res.description]
    assert sorted(sdf.columns) == sorted(dcols)
    idx = [dcols.index(c) for c in sdf.columns]
    drows = sorted((tuple(norm(r[i]) for i in idx) for r in res.fetchall()), key=key)
    srows = sorted((tuple(norm(x) for x in r) for r in sdf.collect()), key=key)
    assert srows == drows
