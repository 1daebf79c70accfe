"""Registry of the core queries: name -> callable(spark, folder of tables), and the SQL each is held against."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rovermill.operators import compaction, nested, regular_grid, spikes, trips
from rovermill.plans import reference
from rovermill.runtime import shared_dir, table

Query = Callable[[SparkSession, str], DataFrame]


def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trips.found_stops(table(spark, sf_dir, "gps_data"))


def p1_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trips.stops_and_trips(table(spark, sf_dir, "gps_data"))


def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spikes.implausible_rows(*(table(spark, sf_dir, n) for n in ("control_data", "gps_data", "imu_data")))


def _compacted(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = compaction.compact_recordings(table(spark, sf_dir, "recordings"), shared_dir(spark, "recordings") + "/table")
    return spark.read.parquet(done.path)


def p5_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compaction.shared_files(_compacted(spark, sf_dir))


def p5_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _compacted(spark, sf_dir).select("ride_id", "stream", F.col("frame_id").cast("long").alias("frame_id"), "timestamp", F.size("rec_ids").cast("long").alias("n_files"))


def p5_members(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compaction.shared_members(_compacted(spark, sf_dir))


def p5_trajectories(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = compaction.compact_trajectories(table(spark, sf_dir, "traj_data"), shared_dir(spark, "trajectories") + "/table")
    return spark.read.parquet(done.path).select("traj_id", "ride_id", "uri", F.size("timestamps").cast("long").alias("n"))


def p6_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return regular_grid.missing_slots(table(spark, sf_dir, "traj_data"))


def p6_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    return regular_grid.regular_series(table(spark, sf_dir, "traj_data"))


def p7_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nested.sample_table(table(spark, sf_dir, "imu_data")).select("imu_id", "sensor", "sample_idx")


def p7_linked(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = nested.node_tables(table(spark, sf_dir, "imu_data"))
    return nested.innermost(t["sample"], t["object"], {"idx": "sample_idx"}, {"idx": "object_idx", "unit": "unit"})


def p7_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = nested.node_tables(table(spark, sf_dir, "imu_data"))
    return nested.innermost(t["field"], t["sample"], {"idx": "field_idx", "name": "name", "value": "value"}, {"idx": "sample_idx"})


def problem_queries() -> dict[str, Query]:
    return {f.__name__: f for f in (p1_found, p1_trips, p4_found, p5_found, p5_records, p5_members, p5_trajectories, p6_found, p6_series, p7_found, p7_linked, p7_fields)}


_US = "cast(floor((case when abs({c}) >= 1e11 then {c} / 1000 else {c} end) * 1e6 + 0.5) as bigint)"
_OK = "{c} is not null and not isnan({c}) and not isinf({c})"
_RECORDS = r"""with f as (select distinct rec_id, ride_id, stream, payload from recordings where payload is not null and rec_id is not null),
l as (select rec_id, ride_id, stream, unnest(regexp_split_to_array(payload, '\r\n|\r|\n')) as line from f),
v as (select distinct rec_id, ride_id, stream, try_cast(trim(split_part(line, ',', 1)) as double) as frame_id, try_cast(trim(split_part(line, ',', 2)) as double) as timestamp from l),
r as (select * from v where frame_id is not null and timestamp is not null)"""


def problem_sql() -> dict[str, str]:
    us, ok = (lambda c: _US.format(c=c)), (lambda c: _OK.format(c=c))
    return {
        "p5_found": f"{_RECORDS} select distinct a.rec_id as rec_id_a, b.rec_id as rec_id_b from r a join r b on a.ride_id = b.ride_id and a.stream = b.stream and a.frame_id = b.frame_id and a.timestamp = b.timestamp and a.rec_id < b.rec_id",
        "p5_records": f"{_RECORDS} select ride_id, stream, cast(frame_id as bigint) as frame_id, timestamp, count(*) as n_files from r group by all",
        "p5_members": f"{_RECORDS}, g as (select min(rec_id) as first, list(rec_id) as ids from r group by ride_id, stream, frame_id, timestamp having count(*) > 1) select distinct first, unnest(ids) as rec_id from g",
        "p5_trajectories": "select distinct traj_id, ride_id, uri, cast(len(timestamps) as bigint) as n from traj_data where traj_id is not null",
        "p6_found": f"""
with t as (select distinct on (traj_id) traj_id, timestamps, position, yaw from traj_data where traj_id is not null),
e as (select traj_id, unnest(timestamps) as ts, unnest(position) as p, unnest(yaw) as yaw from t),
v as (select traj_id, {us("ts")} as us from e where {ok("ts")} and {ok("p.x")} and {ok("p.y")} and {ok("yaw")}),
g as (select traj_id, us, lead(us) over (partition by traj_id order by us) as nxt from v)
select distinct traj_id, unnest(range(us // 250000 + 1, cast(ceil(nxt / 250000.0) as bigint))) as slot from g where nxt - us > 1000000""",
    }


def queries() -> dict[str, Query]:
    return problem_queries() | reference.QUERIES


def oracle_sql() -> dict[str, str]:
    return problem_sql() | reference.SQL
