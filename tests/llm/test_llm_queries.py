from __future__ import annotations

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
from oracle import agree  # noqa: E402

from rovermill.llm import queries as llm  # noqa: E402

SF = "/root/testdata/sf0.001"
QUERIES, SQL = llm.queries(), llm.oracle_sql()


@pytest.mark.parametrize("name", sorted(SQL))
def test_against_sql(spark, name):
    agree(spark, QUERIES[name], SQL[name], SF)


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_runs(spark, name):
    assert QUERIES[name](spark, SF).count() > 0


def test_nothing_else_imports_the_package():
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    for folder, _, names in os.walk(f"{root}/rovermill"):
        for n in names:
            if n.endswith(".py") and "/llm" not in folder:
                with open(f"{folder}/{n}") as f:
                    assert "rovermill.llm" not in f.read(), n
