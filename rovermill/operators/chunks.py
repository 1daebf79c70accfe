"""Ordered work on long sequences, in time chunks instead of whole entities.

One ride may hold a third of all rows, so no operator here gathers a ride in one task. Rows go to groups (entity, chunk
of its order), each with a halo of its neighbours' rows; what crosses a border is merged from small summaries.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType, _parse_datatype_string

Arrays = dict[str, np.ndarray]


def with_halo(df: DataFrame, order: Column, span: int, before: int, after: int) -> DataFrame:
    """Adds chunk = floor(order / span) and own. Rows at most `before` ahead of a chunk or `after` behind it are repeated there with own = false."""
    at = F.floor(order / F.lit(span))
    first, last = F.floor((order - F.lit(after)) / F.lit(span)), F.floor((order + F.lit(before)) / F.lit(span))
    return df.withColumn("chunk", F.explode(F.sequence(first, last))).withColumn("own", F.col("chunk") == at)


def numpy_of(col: pa.Array | pa.ChunkedArray) -> np.ndarray:
    return col.to_numpy(zero_copy_only=False) if isinstance(col, pa.Array) else col.to_numpy()


def map_groups(df: DataFrame, keys: list[str], order: list[str], fn: Callable[[dict, Arrays], Arrays | None], schema: str | StructType, flush_rows: int = 20_000, clustered: bool = False) -> DataFrame:
    """fn over every group of keys, its rows in order; fn returns columns of equal length, or None.

    The rows are hashed and sorted by Spark (both spill); a task holds one group and the current Arrow batch. Keys must not
    be null. Adaptive execution may join small partitions, but never splits a group. clustered: df is hashed by some of the keys already, as by
    the windows that made it, so it is only sorted.
    """
    out = schema if isinstance(schema, StructType) else _parse_datatype_string(schema)
    arrow = to_arrow_schema(out)
    types = [(f.name, f.type) for f in arrow]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts: list[dict] = []
        waiting: list[pa.RecordBatch] = []
        rows = 0

        def done(bs: list[pa.RecordBatch]) -> int:
            t = pa.Table.from_batches(bs)
            key = {k: t.column(k)[0].as_py() for k in keys}
            res = fn(key, {c: numpy_of(t.column(c)) for c in t.column_names if c not in keys})
            if not res:
                return 0
            n = len(res[types[0][0]])
            if n:
                parts.append(res)
            return n

        def flush() -> pa.RecordBatch:
            cols = [pa.concat_arrays([pa.array(p[name], type=kind, from_pandas=True) for p in parts]) for name, kind in types]
            parts.clear()
            return pa.RecordBatch.from_arrays(cols, schema=arrow)

        for b in batches:
            if b.num_rows == 0:
                continue
            ks = [numpy_of(b.column(b.schema.get_field_index(k))) for k in keys]
            change = np.zeros(b.num_rows, bool)
            for k in ks:
                change[1:] |= k[1:] != k[:-1]
            if waiting:
                last = waiting[-1]
                change[0] = any(last.column(last.schema.get_field_index(k))[-1].as_py() != b.column(b.schema.get_field_index(k))[0].as_py() for k in keys)
            cuts = np.flatnonzero(change).tolist()
            at = 0
            for c in cuts:
                if c > at:
                    waiting.append(b.slice(at, c - at))
                rows += done(waiting)
                waiting = []
                at = c
                if rows >= flush_rows:
                    yield flush()
                    rows = 0
            waiting.append(b.slice(at))
        if waiting:
            done(waiting)
        if parts:
            yield flush()

    return (df if clustered else df.repartition(*keys)).sortWithinPartitions(*keys, *order).mapInArrow(run, out)


def fold_groups(df: DataFrame, keys: list[str], order: list[str], begin: Callable[[dict], Callable[[Arrays], Arrays | None]], schema: str | StructType) -> DataFrame:
    """An ordered pass over every group of keys that holds one Arrow batch at a time, however long the group.

    begin gives the fold of a group, which takes its rows piece by piece, in order, and returns what is done. The rows are hashed
    and sorted by Spark (both spill). Keys must not be null.
    """
    out = schema if isinstance(schema, StructType) else _parse_datatype_string(schema)
    arrow = to_arrow_schema(out)
    types = [(f.name, f.type) for f in arrow]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, fold = None, None
        for b in batches:
            if b.num_rows == 0:
                continue
            ks = [numpy_of(b.column(b.schema.get_field_index(k))) for k in keys]
            change = np.zeros(b.num_rows, bool)
            for k in ks:
                change[1:] |= k[1:] != k[:-1]
            edges = [0, *np.flatnonzero(change).tolist(), b.num_rows]
            for lo, hi in zip(edges[:-1], edges[1:], strict=True):
                now = tuple(k[lo] for k in ks)
                if now != key:
                    key, fold = now, begin(dict(zip(keys, now, strict=True)))
                piece = b.slice(lo, hi - lo)
                res = fold({c: numpy_of(piece.column(i)) for i, c in enumerate(piece.schema.names) if c not in keys})
                if res and len(res[types[0][0]]):
                    yield pa.RecordBatch.from_arrays([pa.array(res[name], type=kind, from_pandas=True) for name, kind in types], schema=arrow)

    return df.repartition(*keys).sortWithinPartitions(*keys, *order).mapInArrow(run, out)


def first_of_key(ids: np.ndarray) -> np.ndarray:
    """Mask of the first row of each run of equal ids, for rows whose order puts repeats of one key side by side."""
    keep = np.ones(len(ids), bool)
    keep[1:] = ids[1:] != ids[:-1]
    return keep


def runs(change: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends (exclusive) of the runs of a change mask whose first entry counts as a change."""
    n = len(change)
    if n == 0:
        return np.zeros(0, int), np.zeros(0, int)
    c = change.copy()
    c[0] = True
    s = np.flatnonzero(c)
    return s, np.r_[s[1:], n]
