"""Window operators on long sequences: previous row, running sums, row numbers and islands per entity.

A plain window per ride would put a ride that holds a third of all rows into one task. Here windows run per (entity, time
chunk), and what comes from earlier chunks is carried in from one summary row a chunk.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rovermill.runtime import cut

HOUR_US = 3_600_000_000


def chunked(df: DataFrame, span_us: int = HOUR_US) -> DataFrame:
    """Adds chunk, the time chunk of us."""
    return df.withColumn("chunk", F.floor(F.col("us") / F.lit(span_us)))


def previous(df: DataFrame, cols: Sequence[str], entity: Sequence[str] = ("ride_id",), order: Sequence[str] = ("us", "control_id"), settle: bool = False) -> DataFrame:
    """Adds prev, a struct of order and cols of the entity's row before (null at its first). df has a chunk column; order is unique within the entity.

    df is read twice, for the rows and for the summary. settle writes it to the shared folder first: right for anything dearer than a scan.
    """
    df = cut(df, "rows") if settle else df
    keys = [*entity, "chunk"]
    row = F.struct(*dict.fromkeys([*order, *cols]))
    w = Window.partitionBy(*keys).orderBy(*order)
    edge = df.groupBy(*keys).agg(F.max(row).alias("_last"))
    edge = edge.withColumn("_carry", F.lag("_last").over(Window.partitionBy(*entity).orderBy("chunk"))).drop("_last")
    out = df.withColumn("prev", F.lag(row).over(w)).join(edge, keys, "left")
    return out.withColumn("prev", F.coalesce("prev", "_carry")).drop("_carry")


def running(df: DataFrame, sums: dict[str, Column], entity: Sequence[str] = ("ride_id",), order: Sequence[str] = ("us", "control_id"), settle: bool = True) -> DataFrame:
    """Adds running sums (null terms count as 0) up to and with each row of its entity. settle as in previous, so that stacked calls don't double the work below them each time."""
    df = cut(df, "rows") if settle else df
    keys = [*entity, "chunk"]
    w = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    before = Window.partitionBy(*entity).orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    zero = {n: F.coalesce(c, F.lit(0)) for n, c in sums.items()}
    total = df.groupBy(*keys).agg(*[F.sum(c).alias(f"_t_{n}") for n, c in zero.items()])
    total = total.select(*keys, *[F.coalesce(F.sum(f"_t_{n}").over(before), F.lit(0)).alias(f"_b_{n}") for n in sums])
    out = df.withColumns({n: F.sum(c).over(w) for n, c in zero.items()}).join(total, keys, "left")
    return out.withColumns({n: F.col(n) + F.col(f"_b_{n}") for n in sums}).drop(*[f"_b_{n}" for n in sums])


def numbered(df: DataFrame, name: str = "seq", entity: Sequence[str] = ("ride_id",), order: Sequence[str] = ("us", "control_id")) -> DataFrame:
    """Adds the 0-based position of each row in its entity."""
    return running(df, {name: F.lit(1).cast("long")}, entity, order, settle=False).withColumn(name, F.col(name) - 1)


def islands(df: DataFrame, flag: Column, entity: Sequence[str] = ("ride_id",), order: Sequence[str] = ("us", "control_id")) -> DataFrame:
    """Adds flag and island, a number that is constant along a run of equal flags of an entity."""
    marked = previous(df.withColumn("flag", F.coalesce(flag, F.lit(False))), ["flag"], entity, order)
    change = F.when(F.col("prev.flag") == F.col("flag"), 0).otherwise(1).cast("long")
    return running(marked, {"island": change}, entity, order).drop("prev")
