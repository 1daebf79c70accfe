from __future__ import annotations

from rovermill.runtime import shared_dir
from rovermill.streaming.live import ride_minutes

COLS = "control_id long, ride_id long, linear double, angular double, timestamp double"
T0 = 1_325_376_000.0


def test_minutes_behind_the_watermark(spark):
    work = shared_dir(spark, "live")
    batch = lambda rows: spark.createDataFrame(rows, COLS).coalesce(1).write.mode("append").parquet(f"{work}/in")
    batch([(1, 1, 0.0, 0.0, T0), (2, 1, 0.5, 0.0, T0 + 30), (1, 1, 0.0, 0.0, T0), (3, 1, float("nan"), 0.0, T0 + 31), (4, 1, 0.0, 0.0, None)])

    def run():
        s = spark.readStream.schema(COLS).parquet(f"{work}/in")
        q = ride_minutes(s, "1 minute").writeStream.format("parquet").option("path", f"{work}/out").option("checkpointLocation", f"{work}/ck").trigger(availableNow=True).start()
        q.awaitTermination()
        return sorted((r.ride_id, r.total, r.stationary) for r in spark.read.parquet(f"{work}/out").collect())

    assert run() == []
    # a repeat and a late row within the lateness, and one that closes the minute
    batch([(2, 1, 0.5, 0.0, T0 + 30), (5, 1, 0.0, 0.0, T0 + 10), (6, 1, 1.0, 0.0, T0 + 200)])
    assert run() == [(1, 3, 2)]
