"""Every query of the core with SQL against DuckDB on the smallest tables."""

import glob
import os

import duckdb
import pytest

from recordloom.plans import catalog, general

QUERIES = general.queries() | catalog.queries()
SQL = general.oracle_sql() | catalog.oracle_sql()


@pytest.fixture(scope="module")
def con(small):
    c = duckdb.connect()
    for f in glob.glob(f"{small}/*.parquet"):
        c.execute(f"CREATE VIEW {os.path.basename(f)[:-8]} AS SELECT * FROM read_parquet('{f}')")
    return c


def plain(x):
    if isinstance(x, float):
        return f"{x:.9g}"
    if isinstance(x, (list, tuple)):
        return "[" + ",".join(map(plain, x)) + "]"
    return str(x)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, small, con, name):
    df = QUERIES[name](spark, small)
    cols = sorted(df.columns)
    mine = sorted(tuple(plain(r[c]) for c in cols) for r in df.collect())
    rel = con.sql(SQL[name])
    assert sorted(rel.columns) == cols
    at = [rel.columns.index(c) for c in cols]
    assert mine == sorted(tuple(plain(r[i]) for i in at) for r in rel.fetchall())


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_query_runs(spark, small, name):
    assert QUERIES[name](spark, small).count() >= 0


def test_entry_runs(spark):
    import __spark_entry__ as e

    assert e.entry(spark).count() > 0
    assert set(e.oracle_sql()) <= set(e.queries())
