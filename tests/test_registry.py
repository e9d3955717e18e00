"""Every registry key against its hand-written DuckDB SQL (the driver's gate), at sf0.001."""

from decimal import Decimal

import duckdb
import pytest

import __spark_entry__ as entry
from conftest import SMOKE_DIR
from tierwise.plans.registry import QUERIES

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def _norm(v):
    if isinstance(v, float):
        return v  # exact doubles
    if isinstance(v, Decimal):
        return str(v)
    if hasattr(v, "isoformat"):
        return v.isoformat()
    return v


def _rows(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted((tuple(_norm(r[i]) for i in order) for r in rows), key=repr)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SMOKE_DIR}/{t}.parquet')")
    return con


def test_every_query_has_an_oracle():
    assert set(QUERIES) <= set(entry.queries())
    missing = set(QUERIES) - set(entry.oracle_sql())
    assert missing == set(), missing


@pytest.mark.parametrize("key", sorted(QUERIES))
def test_query_matches_oracle(spark, duck, key):
    df = entry.queries()[key](spark, SMOKE_DIR)
    s_cols, s_rows = df.columns, [tuple(r) for r in df.collect()]
    res = duck.execute(entry.oracle_sql()[key])
    d_cols, d_rows = [c[0] for c in res.description], res.fetchall()
    assert sorted(s_cols) == sorted(d_cols)
    assert len(s_rows) == len(d_rows)
    assert _rows(s_cols, s_rows) == _rows(d_cols, d_rows)


def test_entry_runs(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert "revenue" in df.columns
