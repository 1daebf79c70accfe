"""Compares a query with its SQL in DuckDB, as multisets of rows."""

from __future__ import annotations

import os
from collections import Counter

import duckdb


def _value(v):
    if v is None or v != v:
        return None
    if isinstance(v, float):
        return round(v, 9) + 0.0
    return tuple(map(_value, v)) if isinstance(v, list | tuple) else v


def rows(names: list[str], data: list) -> Counter:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return Counter(tuple(_value(r[i]) for i in order) for r in data)


def agree(spark, query, sql: str, sf_dir: str) -> None:
    con = duckdb.connect()
    for f in os.listdir(sf_dir):
        con.execute(f"create view {f.split('.')[0]} as select * from '{sf_dir}/{f}'")
    want = con.execute(sql)
    names = [c[0] for c in want.description]
    df = query(spark, sf_dir)
    assert sorted(df.columns) == sorted(names)
    assert rows(df.columns, [tuple(r) for r in df.collect()]) == rows(names, want.fetchall())
