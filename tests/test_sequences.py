from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from rovermill.operators import asof
from rovermill.operators.sequences import HOUR_US, chunked, islands, numbered, previous, running


def events(n=400, seed=1):
    rng = np.random.default_rng(seed)
    # one ride holds most rows and spans many chunks, one is a single row
    ride = np.where(np.arange(n) < n * 0.8, 7, rng.integers(0, 3, n))
    ride[-1] = 99
    return pd.DataFrame({"ride_id": ride, "us": rng.integers(0, 40, n) * (HOUR_US // 5), "control_id": np.arange(n), "v": rng.integers(0, 5, n).astype(float)})


def test_previous_running_numbered(spark):
    p = events()
    df = chunked(spark.createDataFrame(p))
    out = numbered(running(previous(df, ["v"]), {"total": F.col("v")})).select("control_id", "prev.v", "total", "seq").toPandas().set_index("control_id").sort_index()
    p = p.sort_values(["ride_id", "us", "control_id"])
    g = p.groupby("ride_id").v
    want = pd.DataFrame({"control_id": p.control_id, "v": g.shift(), "total": g.cumsum(), "seq": g.cumcount()}).set_index("control_id").sort_index()
    pd.testing.assert_frame_equal(out.astype(float), want.astype(float))


def test_islands_treat_null_as_false(spark):
    df = chunked(spark.createDataFrame([(1, 0, 1, 1), (1, 1, 2, None), (1, 2, 3, 0), (1, 3 * HOUR_US, 4, 1)], "ride_id long, us long, control_id long, f int"))
    out = {r.control_id: (r.flag, r.island) for r in islands(df, F.col("f") == 1).collect()}
    assert [out[i][0] for i in (1, 2, 3, 4)] == [True, False, False, True]
    assert out[2][1] == out[3][1] and len({out[1][1], out[2][1], out[4][1]}) == 3


def brute(left, right, tol):
    out = {}
    for l in left.itertuples():
        c = [(abs(r.us - l.us), r.us, r.rid) for r in right.itertuples() if r.ride_id == l.ride_id]
        if c and (tol is None or min(c)[0] <= tol):
            out[l.lid] = min(c)[2]
    return out


def test_nearest_against_brute_force(spark):
    rng = np.random.default_rng(3)
    left = pd.DataFrame({"ride_id": rng.integers(0, 3, 120), "us": rng.integers(0, 20, 120) * 7, "lid": np.arange(120)})
    right = pd.DataFrame({"ride_id": rng.integers(0, 2, 40), "us": rng.integers(0, 20, 40) * 7 + rng.integers(0, 3, 40), "rid": np.arange(40)})
    sl, sr = spark.createDataFrame(left).withColumn("us2", F.lit(1)), spark.createDataFrame(right).withColumn("lid", F.lit(5))
    for tol in (None, 7, 0):
        got = {r.lid: r.rid for r in asof.nearest(sl, sr, "ride_id", "lid", "rid", tol, span_us=31).collect()}
        assert got == brute(left, right, tol)


def test_forward_clamps_and_empty(spark):
    left = spark.createDataFrame([(1, 50, 1), (1, 200, 2), (1, 900, 3), (2, 5, 4)], "ride_id long, us long, lid long")
    right = spark.createDataFrame([(1, t, t) for t in (0, 100, 200, 300)], "ride_id long, us long, rid long")
    go = lambda **k: {r.lid: r.rid for r in asof.forward(left, right, "ride_id", "lid", "rid", span_us=60, **k).collect()}
    assert go() == {1: 100, 2: 200, 3: 300}
    assert go(clamp=False) == {1: 100, 2: 200}
    assert asof.nearest(left.limit(0), right, "ride_id", "lid", "rid").count() == 0
    assert asof.nearest(left, right.limit(0), "ride_id", "lid", "rid").count() == 0
