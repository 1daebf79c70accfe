"""Many tiny files into few well-sized ones, holding every distinct record once.

The records are derived once, into a table of the shared folder, while their count and an order-free checksum are observed. That
table is range-partitioned by the clustering keys (Spark samples the boundaries); the number of ranges follows from the bytes it
takes and the target size, and each range is written sorted. Count and checksum of what was written are held against the observed
ones before the new folder takes the place of the old one.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from rovermill.functions.timeline import micros
from rovermill.runtime import file_system, shared_dir

TARGET_BYTES = 128 * 1024 * 1024
#: Below the target a table is still written by all cores at once, as long as no file gets smaller than this.
LEAST_BYTES = 64 * 1024


class ReconcileError(RuntimeError):
    """What was written does not hold what was read; nothing was swapped."""


@dataclass(frozen=True)
class Compacted:
    path: str
    rows: int
    files: int


def recover(spark: SparkSession, path: str) -> None:
    """Ends a swap that a crash cut short: where path is gone, path.old is renamed back; where both exist, path.old is the remains of a finished swap."""
    fs, at = file_system(spark, path)
    _, old = file_system(spark, path + ".old")
    if not fs.exists(old):
        return
    if fs.exists(at):
        fs.delete(old, True)
    elif not fs.rename(old, at):
        raise OSError(f"cannot move {path}.old back")


def swap(spark: SparkSession, staged: str, path: str) -> None:
    """staged takes the place of path: two renames, and a removal of the old folder at the end. What a crash between them leaves, recover mends, as does the next swap."""
    recover(spark, path)
    fs, new = file_system(spark, staged)
    _, at = file_system(spark, path)
    _, old = file_system(spark, path + ".old")
    had = fs.exists(at)
    if had and not fs.rename(at, old):
        raise OSError(f"cannot move {path} aside")
    if not fs.rename(new, at):
        if had:
            fs.rename(old, at)
        raise OSError(f"cannot move {staged} to {path}")
    if had:
        fs.delete(old, True)


def checksum(df: DataFrame) -> tuple[Column, Column]:
    """Aggregates that depend on the rows, not on their order: how many, and the sum of their hashes."""
    return F.count(F.lit(1)).alias("n"), F.coalesce(F.sum((F.xxhash64(*df.columns).cast("decimal(38,0)"))), F.lit(0)).alias("h")


def compact(df: DataFrame, keys: list[str], path: str, target_bytes: int = TARGET_BYTES, least_bytes: int = LEAST_BYTES) -> Compacted:
    """Writes df, sorted and range-partitioned by keys, in files of about target_bytes, and swaps it into path.

    df is evaluated once. Every row is written exactly once, or ReconcileError is raised and path stays as it was. An empty frame
    gives an empty folder of its schema. Null keys sort first.
    """
    spark = df.sparkSession
    seen = Observation()
    once = shared_dir(spark, "distinct")
    df.observe(seen, *checksum(df)).write.parquet(once)
    before = seen.get
    fs, folder = file_system(spark, once)
    size = fs.getContentSummary(folder).getLength()
    files = max(1, math.ceil(size / target_bytes), min(spark.sparkContext.defaultParallelism, size // least_bytes))
    staged = path.rstrip("/") + ".staged"
    rows = spark.read.schema(df.schema).parquet(once)
    rows.repartitionByRange(files, *keys).sortWithinPartitions(*keys).write.mode("overwrite").parquet(staged)
    back = spark.read.schema(df.schema).parquet(staged)
    after = back.agg(*checksum(back)).first()
    if (before["n"], before["h"]) != (after["n"], after["h"]):
        raise ReconcileError(f"{before['n']} rows read, {after['n']} written to {staged}")
    swap(spark, staged, path)
    fs.delete(folder, True)
    return Compacted(path, int(after["n"]), files)


def recording_lines(recordings: DataFrame) -> DataFrame:
    """ride_id, stream, frame_id, timestamp, rec_id: a row for every record line of every file.

    Header lines, blank lines and lines that aren't two numbers are no records; null and empty payloads have none. Number
    format, spaces, line ends (LF, CRLF, CR) and line order make no difference. rec_id must not be null.
    """
    line = F.explode(F.split("payload", r"\r\n|\r|\n")).alias("line")
    parts = F.split(F.col("line"), ",")
    value = lambda i: F.trim(F.get(parts, F.lit(i))).try_cast("double")
    return (
        recordings.where("payload is not null and rec_id is not null")
        .select("ride_id", "stream", "rec_id", line)
        .where(F.size(parts) == 2)
        .select("ride_id", "stream", value(0).alias("frame_id"), value(1).alias("timestamp"), "rec_id")
        .where("frame_id is not null and timestamp is not null and not isnan(frame_id) and not isnan(timestamp)")
    )


def distinct_records(recordings: DataFrame) -> DataFrame:
    """Every distinct record once: ride_id, stream, frame_id, timestamp and rec_ids, the sorted ids of the files that hold it. Files listed twice count once."""
    return recording_lines(recordings).groupBy("ride_id", "stream", "frame_id", "timestamp").agg(F.sort_array(F.collect_set("rec_id")).alias("rec_ids"))


def compact_recordings(recordings: DataFrame, path: str, target_bytes: int = TARGET_BYTES) -> Compacted:
    """The distinct records of all recordings, clustered by ride, stream and time."""
    return compact(distinct_records(recordings), ["ride_id", "stream", "timestamp", "frame_id"], path, target_bytes)


def shared_files(records: DataFrame) -> DataFrame:
    """rec_id_a < rec_id_b of the files of one ride and stream that share a record; records as compact_recordings wrote them.

    Equal sets of files are joined before any pair is built, so a pair that shares thousands of records is built once a set.
    """
    sets = records.where(F.size("rec_ids") > 1).select("ride_id", "stream", "rec_ids").distinct()
    pair = F.explode(F.flatten(F.transform("rec_ids", lambda a, i: F.transform(F.slice("rec_ids", i + 2, F.size("rec_ids")), lambda b: F.struct(a.alias("rec_id_a"), b.alias("rec_id_b"))))))
    return sets.select(pair.alias("p")).select("p.rec_id_a", "p.rec_id_b").distinct()


def shared_members(records: DataFrame) -> DataFrame:
    """first, rec_id: every file that shares a record with others, beside the first file of each such set (itself included). Links in proportion to the files, where shared_files gives every pair."""
    sets = records.where(F.size("rec_ids") > 1).select("rec_ids").distinct()
    return sets.select(F.get("rec_ids", F.lit(0)).alias("first"), F.explode("rec_ids").alias("rec_id")).distinct()


def compact_trajectories(traj: DataFrame, path: str, target_bytes: int = TARGET_BYTES) -> Compacted:
    """Every trajectory record once (by traj_id), clustered by ride and start."""
    one = traj.where("traj_id is not null").dropDuplicates(["traj_id"])
    start = F.array_min(F.transform("timestamps", micros))
    return compact(one.withColumn("start_us", start), ["ride_id", "start_us", "traj_id"], path, target_bytes)
