"""Every registered query against its DuckDB oracle at sf0.001, and entry()."""

import math

import duckdb
import pytest

import __spark_entry__ as entry
from conftest import SF_SMALL

TABLES = ["orders", "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]
ORACLE = entry.oracle_sql()


def norm(v):
    if isinstance(v, float):
        return round(v, 9)
    if isinstance(v, (list, tuple)):
        return tuple(norm(x) for x in v)
    return v


def rows(cols, data):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted((tuple(norm(r[i]) for i in order) for r in data), key=repr)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return c


@pytest.mark.parametrize("key", sorted(ORACLE))
def test_query_matches_oracle(spark, con, key):
    df = entry.queries()[key](spark, SF_SMALL)
    res = con.execute(ORACLE[key])
    dcols = [d[0] for d in res.description]
    assert sorted(df.columns) == sorted(dcols)
    assert rows(df.columns, df.collect()) == rows(dcols, res.fetchall())


@pytest.mark.parametrize("key", sorted(set(entry.queries()) - set(ORACLE)))
def test_query_without_oracle_runs(spark, key):
    assert entry.queries()[key](spark, SF_SMALL).count() >= 0


def test_entry(spark):
    out = entry.entry(spark).collect()
    assert out and sum(r["rows"] for r in out) > 0
