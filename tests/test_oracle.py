"""Correctness gate: every registered query vs its DuckDB oracle (sf0.001)."""

import os
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

import __spark_entry__ as E  # noqa: E402
from conftest import SF_SMALL  # noqa: E402
from oracle_check import canon, duck  # noqa: E402

from ballotlens.registry import queries as own_queries  # noqa: E402

KEYS = sorted(own_queries())


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


def test_every_query_has_an_oracle():
    assert set(KEYS) <= set(E.queries()) and set(KEYS) <= set(E.oracle_sql())


@pytest.mark.parametrize("key", KEYS)
def test_query_matches_oracle(spark, con, key):
    df = E.queries()[key](spark, SF_SMALL)
    cur = con.execute(E.oracle_sql()[key])
    o_cols = [d[0] for d in cur.description]
    o_rows = cur.fetchall()
    assert sorted(df.columns) == sorted(o_cols)
    assert canon(df.columns, [tuple(r) for r in df.collect()]) == canon(o_cols, o_rows)


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() >= 0 and len(df.columns) > 0
