from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from rovermill.llm.nearest_stream import NearestRules, match_stream, nearest, replay, replay_matches
from rovermill.runtime import shared_dir

TRAJ = "traj_id long, ride_id long, timestamps array<double>, control_timestamps array<double>, side string"
FRAMES = "ride_id long, frame_id long, timestamp double, us string"
T0 = 1_325_376_000.0


def us(v):
    return None if v is None or not np.isfinite(v) else int(np.floor((v / 1000 if abs(v) >= 1e11 else v) * 1e6 + 0.5))


def brute(traj, frames):
    out, seen = set(), set()
    for tid, ride, ts, ct, _ in traj:
        if tid is None or tid in seen:
            continue
        seen.add(tid)
        right = {"control": [(us(v), i) for i, v in enumerate(ct or []) if us(v) is not None], "camera": [(us(v), f) for r, f, v, _ in frames if r is not None and r == ride and us(v) is not None]}
        for i, v in enumerate(ts or []):
            if us(v) is None:
                continue
            for side, c in right.items():
                best = min(((abs(t - us(v)), t, k) for t, k in c), default=None)
                if best and best[0] <= 100_000:
                    out.add((tid, i, side, best[2]))
    return out


def test_nearest_ties():
    m, d = nearest(np.array([100, 200, 500]), np.array([150, 50, 50, 150]), np.array([9, 3, 2, 8]), 50)
    assert m.tolist() == [2, 8, -1] and d.tolist()[:2] == [50, 50]
    assert nearest(np.array([1]), np.array([], int), np.array([], int), 5)[0].tolist() == [-1]


def test_replay_against_brute_force(spark):
    rng = np.random.default_rng(0)
    traj, frames = [], []
    for tid in range(1, 7):
        base = T0 + tid * 590.0
        ts = [base + float(x) for x in np.round(np.cumsum(rng.choice([0.0, 0.05, 0.3], 60)), 2)]
        ct = [base + float(x) for x in np.round(np.cumsum(rng.choice([0.05, 0.1, 0.35], 50)), 2)]
        ts[3], ts[4], ct[5], ct[6] = None, float("nan"), float("inf"), None
        traj.append((tid, tid % 2, [v * 1000 if v and tid == 3 else v for v in ts], ct, "x"))
        frames += [(tid % 2, tid * 1000 + k, base + float(rng.integers(0, 300)) / 10, "x") for k in range(80)]
    traj += [traj[0], (50, None, [T0], [T0], "x"), (51, 1, None, None, "x"), (52, 1, [], [T0], "x"), (None, 1, [T0], [T0], "x")]
    frames += frames[:9] + [(1, 9999, None, "x"), (None, 5, T0, "x"), (0, 77, frames[1][2], "x"), (0, 76, frames[1][2], "x")]
    work = shared_dir(spark, "in")
    # several files, so rows of one record's ride come in any order
    spark.createDataFrame(traj, TRAJ).repartition(3).write.parquet(f"{work}/t.parquet")
    spark.createDataFrame(frames, FRAMES).repartition(4).write.parquet(f"{work}/f.parquet")
    for block in (600_000_000, 3_000_000):
        got = replay_matches(spark, f"{work}/t.parquet", f"{work}/f.parquet", NearestRules(block_us=block))
        rows = [(r.traj_id, r.odom_idx, r.side, r.match_id) for r in got.collect()]
        assert len(rows) == len(set(rows)) and set(rows) == brute(traj, frames)


def test_empty_tables(spark):
    work = shared_dir(spark, "in")
    spark.createDataFrame([], TRAJ).write.parquet(f"{work}/t.parquet")
    spark.createDataFrame([], FRAMES).write.parquet(f"{work}/f.parquet")
    assert replay_matches(spark, f"{work}/t.parquet", f"{work}/f.parquet").count() == 0


def test_live_stream_emits_behind_the_watermark_and_evicts(spark):
    """Three micro-batches: a left row comes out only once the watermark has passed its horizon; late candidates within the lateness still count."""
    work = shared_dir(spark, "live")
    schema = "side string, kind int, entity long, us long, owner long, ident long, block long"
    base = int(T0 * 1e6)

    def batch(k, rows):
        spark.createDataFrame([("camera", kind, 1, base + t, 1, i, 0) for kind, t, i in rows], schema).coalesce(1).write.mode("append").parquet(f"{work}/in{k}")

    batch(1, [(0, 1_000_000, 1), (1, 1_090_000, 10)])
    batch(2, [(1, 1_020_000, 11), (0, 5_000_000, 2)])
    batch(3, [(1, 5_050_000, 12), (2, 60_000_000, 0)])
    spark.createDataFrame([], schema).coalesce(1).write.parquet(f"{work}/in0")
    rules = NearestRules(lateness="1 seconds")
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).option("latestFirst", False).parquet(f"{work}/in[123]")
    q = match_stream(stream, rules).writeStream.format("memory").queryName("live_matches").option("checkpointLocation", f"{work}/ck").trigger(availableNow=True).start()
    q.awaitTermination()
    got = {(r.odom_idx, r.match_id) for r in spark.table("live_matches").collect()}
    assert got == {(1, 11), (2, 12)}
    spark.sql("drop view if exists live_matches")
    assert F is not None


def test_replay_moves_the_watermark_and_keeps_state_small(spark):
    """Forty records one after another: most batches emit, none holds more keys than two batches bring, nothing is dropped as late."""
    traj = [(k, k % 3, [T0 + 1000.0 * k + 0.5 * i for i in range(100)], [T0 + 1000.0 * k + 0.5 * i + 0.04 for i in range(100)], "x") for k in range(40)]
    frames = [(k % 3, 1000 * k + i, T0 + 1000.0 * k + 0.5 * i - 0.03, "x") for k in range(40) for i in range(100)]
    found, progress = replay(spark.createDataFrame(traj, TRAJ), spark.createDataFrame(frames, FRAMES), NearestRules(least_batches=8, block_us=1_800_000_000))
    assert {(r.traj_id, r.odom_idx, r.side, r.match_id) for r in found.collect()} == brute(traj, frames)
    state = [p["stateOperators"][0] for p in progress if p["stateOperators"]]
    keys = spark.createDataFrame(traj, TRAJ).count() * 2
    assert len([p for p in progress if p["sink"]["numOutputRows"]]) >= 6
    assert max(q["numRowsTotal"] for q in state) <= keys * 2 / 5 and state[-1]["numRowsTotal"] == 0
    assert sum(q["numRowsDroppedByWatermark"] for q in state) == 0
    marks = [p["eventTime"]["watermark"] for p in progress if "watermark" in p["eventTime"]]
    assert marks == sorted(marks) and len(set(marks)) >= 6
