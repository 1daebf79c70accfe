"""Deeply nested records into related flat tables, linked by interval labels.

Every node of a cell gets a pre-order and a post-order number by one depth-first walk. Nodes go to a table per type; node a
contains node b if a.pre < b.pre and b.post < a.post within the same row and sensor, so a parent is found without paths.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rovermill.functions.cells import KINDS, SAMPLE, read_cell
from rovermill.runtime import cut

SENSORS = ("compass", "accelerometer", "gyroscope")
NODES = "imu_id long, ride_id long, sensor string, kind string, pre long, post long, idx long, x double, y double, z double, timestamp double, temp double, name string, value string"


def one_per_key(df: DataFrame, key: str) -> DataFrame:
    """Rows that repeat a key, kept once. Repeats hold equal values; should they not, one whole row is kept."""
    return df.where(F.col(key).isNotNull()).dropDuplicates([key])


def cell_nodes(imu: DataFrame, full: bool = True) -> DataFrame:
    """All nodes of the cells of imu (imu_id, ride_id, compass, accelerometer, gyroscope; other columns are ignored), or the samples alone.

    kind is 'cell' (the root of a readable cell), 'array', 'object', 'sample' or 'field' (a value beside a sample's own four: name and text).
    Cells that are null or not valid JSON give no node. x, y, z and timestamp are null where missing or no finite number. The
    name of an object is its unit, if it has one. Repeated imu_id count once, rows with a null imu_id not at all.
    """
    arrow = pa.schema([("imu_id", pa.int64()), ("ride_id", pa.int64()), ("sensor", pa.string()), ("kind", pa.string()), ("pre", pa.int64()), ("post", pa.int64()), ("idx", pa.int64()), ("x", pa.float64()), ("y", pa.float64()), ("z", pa.float64()), ("timestamp", pa.float64()), ("temp", pa.float64()), ("name", pa.string()), ("value", pa.string())])
    sensors, kinds, sample = SENSORS, KINDS, KINDS[SAMPLE]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple] = []

        def flush() -> pa.RecordBatch:
            cols = list(zip(*rows, strict=True))
            b = pa.RecordBatch.from_arrays([pa.array(c, type=f.type, from_pandas=True) for c, f in zip(cols, arrow, strict=True)], schema=arrow)
            rows.clear()
            return b

        for b in batches:
            d = {n: b.column(b.schema.get_field_index(n)).to_pylist() for n in ("imu_id", "ride_id", *sensors)}
            for r, (imu_id, ride_id) in enumerate(zip(d["imu_id"], d["ride_id"], strict=True)):
                for sensor in sensors:
                    t = read_cell(d[sensor][r], full)
                    if t is None:
                        continue
                    rows += [(imu_id, ride_id, sensor, sample, *q, None, None) for q in t.samples]
                    rows += [(imu_id, ride_id, sensor, kinds[q[0]], q[1], q[2], q[3], None, None, None, None, None, q[4], q[5]) for q in t.others]
                if len(rows) >= 20_000:
                    yield flush()
        if rows:
            yield flush()

    return one_per_key(imu.select("imu_id", "ride_id", *SENSORS), "imu_id").mapInArrow(run, NODES)


def node_tables(imu: DataFrame) -> dict[str, DataFrame]:
    """A table per node type, from one walk: imu_id, ride_id, sensor, pre, post, idx and the type's own columns."""
    nodes = cut(cell_nodes(imu), "nodes")
    own = {"cell": [], "array": ["name"], "object": [F.col("name").alias("unit")], "sample": ["x", "y", "z", "timestamp", "temp"], "field": ["name", "value"]}
    return {k: nodes.where(F.col("kind") == k).select("imu_id", "ride_id", "sensor", "pre", "post", "idx", *cols) for k, cols in own.items()}


def sample_table(imu: DataFrame) -> DataFrame:
    """The flat table of usable samples: imu_id, ride_id, sensor, sample_idx, pre, post, x, y, z, timestamp, temp."""
    ok = " and ".join(f"{c} is not null" for c in ("x", "y", "z", "timestamp"))
    return cell_nodes(imu, full=False).where(ok).select("imu_id", "ride_id", "sensor", F.col("idx").alias("sample_idx"), "pre", "post", "x", "y", "z", "timestamp", "temp")


def innermost(inner: DataFrame, outer: DataFrame, keep: dict[str, str], take: dict[str, str]) -> DataFrame:
    """Each node of inner with the innermost node of outer that contains it, by interval containment; null where none does.

    keep and take: columns of inner and of outer with their names in the result, beside imu_id and sensor. Pairs are built within a cell only.
    """
    a = inner.select("imu_id", "sensor", "pre", "post", *[F.col(c).alias(n) for c, n in keep.items()])
    b = outer.select("imu_id", "sensor", F.struct(F.col("pre").alias("o_pre"), F.col("post").alias("o_post"), *[F.col(c).alias(n) for c, n in take.items()]).alias("o"))
    on = [a.imu_id == b.imu_id, a.sensor == b.sensor, b.o.o_pre < a.pre, a.post < b.o.o_post]
    pairs = a.join(b, on, "left").select(a.imu_id, a.sensor, "pre", *keep.values(), "o")
    best = pairs.groupBy("imu_id", "sensor", "pre", *keep.values()).agg(F.max("o").alias("o"))
    return best.select("imu_id", "sensor", *keep.values(), *[F.col(f"o.{n}").alias(n) for n in take.values()])
