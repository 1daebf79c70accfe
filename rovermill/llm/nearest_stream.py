"""Nearest-in-time matching of two streams, per entity and within a tolerance, as a stateful streaming join.

Left and right readings of an entity are buffered in keyed state. A left reading is emitted once the watermark has passed its
tolerance horizon (no candidate can come any more), candidates out of reach of every waiting one are evicted. State is keyed by
time block and a hash of the entity; candidates near a block's border go to both blocks, so one long-lived entity is many keys, and
many small entities share one, as a key costs far more than its readings.

An event is a piece: readings of one entity and block in arrays, with the time of its earliest one. What comes later is never
earlier than the watermark, so a reading past it is sure of its match, however long the pieces are. Stored tables are replayed
in time order: their pieces are written range-partitioned by time, and the stream takes those files in order, some in each
micro-batch, so the watermark moves on, matches leave with every batch, and state holds what the last batches brought.
"""

from __future__ import annotations

import math
import time
from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rovermill.functions.timeline import micros
from rovermill.runtime import cut, shared_dir

LEFT, RIGHT, END = 0, 1, 2
CODE = "case when side = 'camera' then 1 else 0 end"
FOUND = "entity array<long>, owner array<long>, at array<long>, match array<long>, distance array<long>"
ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
LEFTS, RIGHTS = ("us", "entity", "owner", "ident"), ("us", "entity", "ident")
STATE = ", ".join([f"left_{c} binary" for c in LEFTS] + [f"right_{c} binary" for c in RIGHTS])


@dataclass(frozen=True)
class NearestRules:
    """tolerance_us: inclusive; block_us: time covered by one state key; buckets: keys that share a block's entities; lateness: how far behind the newest event one may arrive.

    For a replay, which chooses buckets by key_readings, the readings of a key: piece_us, the time of frames in one event; batch_readings, readings a micro-batch takes for each core of the
    cluster; least_batches, how many micro-batches a small table is still split into.
    """

    tolerance_us: int = 100_000
    block_us: int = 21_600_000_000
    buckets: int = 64
    key_readings: int = 200_000
    lateness: str = "0 seconds"
    piece_us: int = 300_000_000
    batch_readings: int = 500_000
    least_batches: int = 4


def nearest(left: np.ndarray, right: np.ndarray, ids: np.ndarray, tolerance: int) -> tuple[np.ndarray, np.ndarray]:
    """For each left time the id of the nearest right (-1 if none) and the distance; ties go to the earlier time, then the lower id."""
    if len(right) == 0 or len(left) == 0:
        return np.full(len(left), -1, np.int64), np.zeros(len(left), np.int64)
    order = np.lexsort((ids, right))
    r, k = right[order], ids[order]
    first = np.r_[True, r[1:] != r[:-1]]
    r, k = r[first], k[first]
    at = np.searchsorted(r, left)
    before, after = np.maximum(at - 1, 0), np.minimum(at, len(r) - 1)
    d0, d1 = np.abs(left - r[before]), np.abs(r[after] - left)
    pick = np.where(d0 <= d1, before, after)
    d = np.minimum(d0, d1)
    return np.where(d <= tolerance, k[pick], -1), d


def nearest_of(lu: np.ndarray, le: np.ndarray, ru: np.ndarray, re: np.ndarray, ids: np.ndarray, tolerance: int) -> tuple[np.ndarray, np.ndarray]:
    """nearest within each entity: entities are laid out one behind the other, farther apart than the tolerance."""
    if len(lu) == 0 or len(ru) == 0:
        return nearest(lu, ru, ids, tolerance)
    place = np.unique(np.r_[le, re], return_inverse=True)[1]
    base = min(int(lu.min()), int(ru.min()))
    span = max(int(lu.max()), int(ru.max())) - base + 2 * tolerance + 2
    return nearest(lu - base + place[: len(le)] * span, ru - base + place[len(le) :] * span, ids, tolerance)


def _matcher(rules: NearestRules):  # noqa: ANN202
    tol = rules.tolerance_us

    def fold(key: tuple, frames: Iterator[pd.DataFrame], state) -> Iterator[pd.DataFrame]:  # noqa: ANN001
        had = [np.frombuffer(b, np.int64) for b in state.get] if state.exists else [np.zeros(0, np.int64)] * (len(LEFTS) + len(RIGHTS))
        left, right = had[: len(LEFTS)], had[len(LEFTS) :]
        for f in frames:
            kind, size = f["kind"].to_numpy(), np.array([len(u) for u in f["us"]], np.int64)
            for side, cols, which in ((left, LEFTS, kind == LEFT), (right, RIGHTS, kind == RIGHT)):
                for k, c in enumerate(cols):
                    v = f[c].to_numpy()[which]
                    side[k] = np.concatenate([side[k], *v]) if c in ("us", "ident") else np.r_[side[k], np.repeat(v.astype(np.int64), size[which])]
        mark = state.getCurrentWatermarkMs() * 1000
        due = np.ones(len(left[0]), bool) if state.hasTimedOut else left[0] + tol < mark
        if due.any():
            lu, le, lo, li = (v[due] for v in left)
            match, dist = nearest_of(lu, le, *right, tol)
            # a reading that came twice counts once
            hit = np.flatnonzero(match >= 0)
            hit = hit[np.lexsort((li[hit], lo[hit], le[hit]))]
            again = np.ones(len(hit), bool)
            again[1:] = np.logical_or.reduce([v[hit][1:] != v[hit][:-1] for v in (le, lo, li)])
            hit = hit[again]
            if len(hit):
                yield pd.DataFrame({"entity": [le[hit]], "owner": [lo[hit]], "at": [li[hit]], "match": [match[hit]], "distance": [dist[hit]]})
            left = [v[~due] for v in left]
        lu, ru = left[0], right[0]
        # candidates that no waiting and no coming left reading can reach
        reach = min(int(lu.min()) if len(lu) else mark, mark) - tol if mark > 0 else None
        if reach is not None:
            right = [v[ru >= reach] for v in right]
            ru = right[0]
        if state.hasTimedOut or (len(lu) == 0 and len(ru) == 0):
            if state.exists:
                state.remove()
            return
        state.update(tuple(v.tobytes() for v in (*left, *right)))
        # the last waiting left reading is due at its horizon; candidates alone wait for their own
        last = int(lu.max() if len(lu) else ru.max())
        state.setTimeoutTimestamp(max((last + tol) // 1000 + 2, state.getCurrentWatermarkMs() + 1))

    return fold


def pieces(df: DataFrame, side: str, kind: int, entity: Column, owner: Column, readings: Column, rules: NearestRules) -> DataFrame:
    """Events of one kind from rows with an array of readings (us, id): one for each block; candidates near a border of their block are repeated in the next."""
    rows = df.select(F.lit(side).alias("side"), F.lit(kind).alias("kind"), entity.alias("entity"), owner.alias("owner"), F.filter(readings, lambda e: e["us"].isNotNull() & e["id"].isNotNull()).alias("e"))
    reach = rules.tolerance_us if kind == RIGHT else 0
    first, last = (lambda us: F.floor((us - reach) / F.lit(rules.block_us))), (lambda us: F.floor((us + reach) / F.lit(rules.block_us)))
    blocks = F.array_distinct(F.flatten(F.transform("e", lambda e: F.array(first(e["us"]), last(e["us"])))))
    rows = rows.where("entity is not null").withColumn("block", F.explode(blocks))
    rows = rows.withColumn("e", F.filter("e", lambda e: (first(e["us"]) <= F.col("block")) & (last(e["us"]) >= F.col("block"))))
    return rows.select("side", "kind", "entity", F.col("e.us").alias("us"), "owner", F.col("e.id").alias("ident"), "block")


def odometry_events(traj: DataFrame, frames: DataFrame, rules: NearestRules) -> DataFrame:
    """Trajectory records and frames as events; every record once."""
    t = traj.where("traj_id is not null").select("traj_id", "ride_id", "timestamps", "control_timestamps").dropDuplicates(["traj_id"])
    timed = lambda c: F.transform(c, lambda v, i: F.struct(micros(v).alias("us"), i.cast("long").alias("id")))
    t = t.select("traj_id", "ride_id", timed("timestamps").alias("odom"), timed("control_timestamps").alias("ctrl"))
    f = frames.select("ride_id", "frame_id", micros(F.col("timestamp")).alias("us")).where("us is not null and ride_id is not null and frame_id is not null")
    f = f.groupBy("ride_id", F.floor(F.col("us") / F.lit(rules.piece_us)).alias("piece")).agg(F.collect_list(F.struct("us", F.col("frame_id").alias("id"))).alias("e"))
    traj_id, ride_id = F.col("traj_id"), F.col("ride_id")
    parts = [
        pieces(t, "control", LEFT, traj_id, traj_id, F.col("odom"), rules),
        pieces(t, "camera", LEFT, ride_id, traj_id, F.col("odom"), rules),
        pieces(t, "control", RIGHT, traj_id, traj_id, F.col("ctrl"), rules),
        pieces(f, "camera", RIGHT, ride_id, F.lit(0).cast("long"), F.col("e"), rules),
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2]).unionByName(parts[3])


def match_stream(stream: DataFrame, rules: NearestRules | None = None) -> DataFrame:
    """The stateful join of an event stream (side, kind, entity, us, owner, ident, block): one row per matched left reading, in append mode.

    us and ident are arrays, or single values of one reading. Events later than `lateness` behind the watermark are too late and dropped by
    the engine, as in any event-time stream; a replay has none. END events only carry the watermark on.
    """
    r = rules or NearestRules()
    if stream.schema["us"].dataType.typeName() == "long":
        stream = stream.withColumns({"us": F.array("us"), "ident": F.array("ident")})
    timed = stream.withColumn("at", F.timestamp_micros(F.array_min("us"))).withWatermark("at", r.lateness)
    # an entity of each side is a number of its own
    keyed = timed.withColumn("entity", F.col("entity") * 2 + F.expr(CODE)).withColumn("bucket", F.pmod(F.xxhash64("entity"), F.lit(r.buckets)))
    found = keyed.groupBy("bucket", "block").applyInPandasWithState(_matcher(r), FOUND, STATE, "append", "EventTimeTimeout")
    # a row for each call of the matcher, taken apart in the JVM
    rows = found.select(F.explode(F.arrays_zip("entity", "owner", "at", "match", "distance")).alias("m"))
    side = F.when(F.pmod("m.entity", F.lit(2)) == 1, "camera").otherwise("control")
    return rows.select(F.col("m.owner").alias("traj_id"), F.col("m.at").alias("odom_idx"), side.alias("side"), F.col("m.match").alias("match_id"), F.col("m.distance").alias("distance_us"))


def in_time_order(events: DataFrame, rules: NearestRules) -> tuple[str, int, int]:
    """Writes events in files by time whose order of change is that of time, and an END past all horizons; gives their folder, the files of a micro-batch and the buckets of a block."""
    spark = events.sparkSession
    rows = cut(events, "pieces")
    n, last, blocks = rows.agg(F.coalesce(F.sum(F.size("us")), F.lit(0)), F.coalesce(F.max(F.array_max("us")), F.lit(0)), F.approx_count_distinct("block")).first()
    slots = spark.sparkContext.defaultParallelism
    batches = max(rules.least_batches, math.ceil(n / (slots * rules.batch_readings)))
    end = spark.range(1).select(F.lit("control").alias("side"), F.lit(END).alias("kind"), F.lit(0).cast("long").alias("entity"), F.array(F.lit(last + 2 * rules.tolerance_us + 86_400_000_000)).alias("us"), F.lit(0).cast("long").alias("owner"), F.array(F.lit(0).cast("long")).alias("ident"), F.lit(0).cast("long").alias("block"))
    path = shared_dir(spark, "ordered")
    rows.unionByName(end).withColumn("at", F.array_min("us")).repartitionByRange(batches * slots, "at").drop("at").write.parquet(path)
    # a file stream takes files by their time of change; partitions are numbered by range
    jvm = spark._jvm
    folder = jvm.org.apache.hadoop.fs.Path(path)
    fs = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    files = sorted((f.getPath() for f in fs.listStatus(folder) if f.getPath().getName().startswith("part-")), key=lambda p: p.getName())
    now = int(time.time() * 1000) - 10 * len(files)
    for k, f in enumerate(files):
        fs.setTimes(f, now + 10 * k, -1)
    # as many keys as keep each small, and the cores of a micro-batch busy
    buckets = math.ceil(max(n / rules.key_readings, 4 * slots * batches) / max(1, blocks))
    return path, max(1, math.ceil(len(files) / batches)), max(1, buckets)


def replay(traj: DataFrame, frames: DataFrame, rules: NearestRules) -> tuple[DataFrame, list]:
    """The matches of replay_matches and the progress of the stream's micro-batches."""
    spark = traj.sparkSession
    path, files, buckets = in_time_order(odometry_events(traj, frames, rules), rules)
    stream = spark.readStream.schema(spark.read.parquet(path).schema).option("maxFilesPerTrigger", files).parquet(path)
    found = match_stream(stream, replace(rules, buckets=buckets))
    work = shared_dir(spark, "nearest")
    # state on local disk with change logs in the shared folder: it may outgrow the heap, and survives a lost executor
    conf = {"spark.sql.streaming.stateStore.providerClass": ROCKS, "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true"}
    before = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        query = found.writeStream.format("parquet").option("path", f"{work}/out").option("checkpointLocation", f"{work}/state").outputMode("append").trigger(availableNow=True).start()
        query.awaitTermination()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v) if v is not None else spark.conf.unset(k)
    return spark.read.schema(found.schema).parquet(f"{work}/out"), query.recentProgress


def replay_matches(spark: SparkSession, traj_path: str, frames_path: str, rules: NearestRules | None = None) -> DataFrame:
    """Runs the streaming join over stored tables to its end and returns what it wrote: traj_id, odom_idx, side, match_id, distance_us.

    traj: traj_id, ride_id, timestamps, control_timestamps; frames: ride_id, frame_id, timestamp. Null, NaN and infinite times
    are left out; repeated records and frames count once. A left row without a candidate within the tolerance gives no row.
    """
    return replay(spark.read.parquet(traj_path), spark.read.parquet(frames_path), rules or NearestRules())[0]
