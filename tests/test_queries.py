"""Every core query with SQL, held against DuckDB on the smallest tables; the rest must run."""

from __future__ import annotations

import pytest
from oracle import agree

from rovermill import queries as core

SF = "/root/testdata/sf0.001"
QUERIES, SQL = core.queries(), core.oracle_sql()


@pytest.mark.parametrize("name", sorted(SQL))
def test_against_sql(spark, name):
    agree(spark, QUERIES[name], SQL[name], SF)


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_runs(spark, name):
    assert QUERIES[name](spark, SF).count() > 0


def test_entry(spark):
    import __spark_entry__ as e

    assert e.entry(spark).count() > 0
    assert set(SQL) <= set(e.oracle_sql()) <= set(e.queries())
