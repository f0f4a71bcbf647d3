"""Differential test: every registered query equals its DuckDB oracle (sf0.001)."""

import os
import sys

import duckdb
import pytest

import __spark_entry__ as E

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

from wattflow.plans.oracle import ORACLE  # noqa: E402
from wattflow.plans.registry import QUERIES  # noqa: E402
from compare import TABLES, rows_of  # noqa: E402
from conftest import SF_SMALL  # noqa: E402


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return c


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE)


@pytest.mark.parametrize("key", sorted(QUERIES))
def test_query_matches_oracle(spark, con, key):
    df = QUERIES[key](spark, SF_SMALL)
    s_cols, s_rows = df.columns, [tuple(r) for r in df.collect()]
    cur = con.execute(ORACLE[key])
    o_cols = [d[0] for d in cur.description]
    o_rows = cur.fetchall()
    assert sorted(s_cols) == sorted(o_cols)
    assert len(s_rows) == len(o_rows)
    assert rows_of(s_cols, s_rows) == rows_of(o_cols, o_rows)


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert "pct_renovavel" in df.columns
