"""As-of joins of two event tables per entity: nearest with or without tolerance, and forward.

Both sides are merged in time order and each left row looks at the last right row before it and the first one after it.
Windows run per (entity, time chunk); the right rows next to a chunk come from a summary of one row a chunk, so neither a
long-lived entity nor a long silence makes a task large, and no left row is compared with more than two right rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rovermill.operators.sequences import HOUR_US


def _neighbours(left: DataFrame, right: DataFrame, entity: str, left_id: str, right_id: str, span_us: int) -> DataFrame:
    """left (entity, us, left_id) with before and after: struct (us, right_id) of the last right row at or before us (of equal times the lowest id) and the first at or after it."""
    r = right.groupBy(entity, "us").agg(F.min(right_id).alias(right_id))
    side = lambda df, k, own, other, kind: df.select(entity, "us", F.lit(k).alias("kind"), F.col(own).alias(own), F.lit(None).cast(kind).alias(other))
    both = side(left, 1, left_id, right_id, right.schema[right_id].dataType).unionByName(side(r, 0, right_id, left_id, left.schema[left_id].dataType)).withColumn("chunk", F.floor(F.col("us") / F.lit(span_us)))
    hit = F.when(F.col("kind") == 0, F.struct("us", right_id))
    keys = [entity, "chunk"]
    w = Window.partitionBy(*keys).orderBy("us", "kind")
    up = w.rowsBetween(Window.unboundedPreceding, 0)
    down = Window.partitionBy(*keys).orderBy(F.col("us").desc(), F.col("kind").asc()).rowsBetween(Window.unboundedPreceding, 0)
    e = both.groupBy(*keys).agg(F.max(hit).alias("_max"), F.min(hit).alias("_min"))
    v = Window.partitionBy(entity).orderBy("chunk")
    e = e.select(*keys, F.max("_max").over(v.rowsBetween(Window.unboundedPreceding, -1)).alias("_from"), F.min("_min").over(v.rowsBetween(1, Window.unboundedFollowing)).alias("_to"), F.max("_max").over(Window.partitionBy(entity)).alias("last"))
    near = both.withColumn("before", F.max(hit).over(up)).withColumn("after", F.min(hit).over(down)).where("kind = 1")
    return near.join(e, keys, "left").select(entity, "us", left_id, F.coalesce("before", "_from").alias("before"), F.coalesce("after", "_to").alias("after"), "last")


def nearest(left: DataFrame, right: DataFrame, entity: str, left_id: str, right_id: str, tolerance_us: int | None = None, span_us: int = HOUR_US) -> DataFrame:
    """entity, left_id, us, right_id, right_us, distance_us: the nearest right row of every left row.

    left and right need entity, us (not null) and their ids, which may be structs; other columns are ignored. Of equally near rows the earlier time
    counts, then the lower id. A distance of exactly tolerance_us still matches; a left row without match gives no row.
    """
    n = _neighbours(left, right, entity, left_id, right_id, span_us)
    d0, d1 = F.col("us") - F.col("before.us"), F.col("after.us") - F.col("us")
    pick = F.when(F.col("before").isNotNull() & (F.col("after").isNull() | (d0 <= d1)), F.col("before")).otherwise(F.col("after"))
    out = n.withColumn("hit", pick).where("hit is not null").select(entity, left_id, "us", F.col(f"hit.{right_id}").alias(right_id), F.col("hit.us").alias("right_us"), F.abs(F.col("us") - F.col("hit.us")).alias("distance_us"))
    return out if tolerance_us is None else out.where(F.col("distance_us") <= tolerance_us)


def forward(left: DataFrame, right: DataFrame, entity: str, left_id: str, right_id: str, clamp: bool = True, span_us: int = HOUR_US) -> DataFrame:
    """entity, left_id, us, right_id, right_us: the first right row at or after every left row; with clamp the entity's last one where none follows."""
    n = _neighbours(left, right, entity, left_id, right_id, span_us)
    hit: Column = F.coalesce("after", "last") if clamp else F.col("after")
    return n.withColumn("hit", hit).where("hit is not null").select(entity, left_id, "us", F.col(f"hit.{right_id}").alias(right_id), F.col("hit.us").alias("right_us"))
