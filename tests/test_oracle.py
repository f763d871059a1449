"""Every registered query against its DuckDB statement (sf0.001)."""

import hashlib

import duckdb
import pytest

import __spark_entry__ as entry_mod
from quillrank.plans.registry import QUERIES
from conftest import SF_SMALL

TABLES = ["pages", "lineitem", "part", "documents", "benchmark"]
CORE = sorted(QUERIES)


def digest(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    norm = lambda v: repr(round(v, 9)) if isinstance(v, float) else repr(v)
    return hashlib.sha256("\n".join(sorted("\x1f".join(norm(r[i]) for i in order) for r in rows)).encode()).hexdigest()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


def test_every_query_has_an_oracle():
    assert set(CORE) <= set(entry_mod.queries()) and set(CORE) <= set(entry_mod.oracle_sql())
    assert set(entry_mod.oracle_sql()) <= set(entry_mod.queries())


@pytest.mark.parametrize("name", CORE)
def test_matches_duckdb(spark, duck, name):
    df = entry_mod.queries()[name](spark, SF_SMALL)
    srows = [tuple(r) for r in df.collect()]
    res = duck.execute(entry_mod.oracle_sql()[name])
    drows = res.fetchall()
    dcols = [d[0] for d in res.description]
    assert sorted(df.columns) == sorted(dcols)
    assert len(srows) == len(drows)
    assert digest(df.columns, srows) == digest(dcols, drows)


def test_entry_smoke(spark):
    df = entry_mod.entry(spark)
    assert df.columns == ["title", "w"] and 0 < df.count() <= 100
