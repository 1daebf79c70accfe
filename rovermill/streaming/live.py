"""Live counterparts of the batch statistics (an extension; the reference has no streams)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rovermill.functions.timeline import finite, micros


def distinct_readings(control: DataFrame, lateness: str = "10 minutes") -> DataFrame:
    """A stream of control rows with `at`, their time, each control_id once among rows at most `lateness` apart; rows without time are left out."""
    timed = control.withColumn("at", F.timestamp_micros(micros(F.col("timestamp")))).where("at is not null and control_id is not null")
    return timed.withWatermark("at", lateness).dropDuplicatesWithinWatermark(["control_id"])


def ride_minutes(control: DataFrame, lateness: str = "10 minutes") -> DataFrame:
    """ride_id, minute, total, stationary of a stream of control rows; a minute is emitted once the watermark has passed it, later rows are dropped."""
    c = distinct_readings(control, lateness).where(finite(F.col("linear")) & finite(F.col("angular")))
    still = F.count_if((F.col("linear") == 0) & (F.col("angular") == 0))
    g = c.groupBy("ride_id", F.window("at", "1 minute").alias("w")).agg(F.count(F.lit(1)).alias("total"), still.alias("stationary"))
    return g.select("ride_id", F.col("w.start").alias("minute"), "total", "stationary")
