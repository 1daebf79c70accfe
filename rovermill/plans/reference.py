"""The reference's operators as queries over the ride tables, each with the SQL it is held against.

Names follow the inventory: ref_<id>_<what>. Every query reads its whole tables.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from rovermill.functions import geo
from rovermill.functions.kinematics import FIRST, GPS, RPM, Robot, command_speed, compass_yaw, gauss, wheel_speed
from rovermill.functions.timeline import finite, micros
from rovermill.operators import asof, ekf, flow, nested, resample, signal
from rovermill.operators.sequences import chunked, islands, numbered, previous, running
from rovermill.plans.views import WHEELS, clean_control, commands, control, fixes, frames, odometry
from rovermill.runtime import cut, shared_dir, table
from rovermill.sources import files

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}

# SQL of the views
CTL = "ctl as (select distinct control_id, ride_id, linear, angular, rpm_1, rpm_2, rpm_3, rpm_4, cast(floor(timestamp * 1e6 + 0.5) as bigint) as us from control_data where isfinite(timestamp))"
CLN = CTL + ", cln as (select * from ctl where isfinite(linear) and isfinite(angular) and isfinite(rpm_1) and isfinite(rpm_2) and isfinite(rpm_3) and isfinite(rpm_4))"
_MS = "cast(floor((case when abs({0}) >= 1e11 then {0} / 1000 else {0} end) * 1e6 + 0.5) as bigint)"
FRM = f"frm as (select distinct ride_id, frame_id, {_MS.format('timestamp')} as us from front_camera_timestamps where isfinite(timestamp))"
FIX = f"fix as (select distinct gps_id, ride_id, latitude, longitude, {_MS.format('timestamp')} as us from gps_data where isfinite(timestamp) and isfinite(latitude) and isfinite(longitude) and latitude between -80 and 84 and longitude between -180 and 180)"
ODO = f"odo as (select traj_id, ride_id, idx, x, y, yaw, {_MS.format('ts')} as us from (select traj_id, ride_id, cast(generate_subscripts(timestamps, 1) - 1 as bigint) as idx, unnest(timestamps) as ts, unnest(position).x as x, unnest(position).y as y, unnest(yaw) as yaw from (select distinct on (traj_id) * from traj_data)) where isfinite(ts))"
CMD = f"cmd as (select traj_id, cidx, linear, angular, {_MS.format('ts')} as us from (select traj_id, cast(generate_subscripts(control_timestamps, 1) - 1 as bigint) as cidx, unnest(control_timestamps) as ts, unnest(linear) as linear, unnest(angular) as angular from (select distinct on (traj_id) * from traj_data)) where isfinite(ts))"
_ORD = "(partition by ride_id order by us, control_id)"


def ref(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def put(f: Query) -> Query:
        QUERIES[name] = f
        if sql:
            SQL[name] = sql
        return f

    return put


def r6(c):  # noqa: ANN001, ANN201
    return F.round(c, 6)


def plain(c: str):  # noqa: ANN201
    """A double, null where it is NaN."""
    return F.nanvl(F.col(c), F.lit(None).cast("double")).alias(c)


# --- scans


@ref("ref_s01_rides", r"select distinct regexp_extract(uri, 'ride_(\d+)_(\d{14})', 0) as ride_key, cast(regexp_extract(uri, 'ride_(\d+)_(\d{14})', 1) as bigint) as ride_id from recordings where regexp_matches(uri, 'ride_(\d+)_(\d{14})')")
def s01(spark: SparkSession, d: str) -> DataFrame:
    uri = F.col("uri")
    return table(spark, d, "recordings").select(files.ride_key(uri).alias("ride_key"), files.ride_id(uri).alias("ride_id")).where("ride_id is not null").distinct()


@ref("ref_s02_folder", "select ride_id, count(*) as n_files, cast(sum(n_bytes) as bigint) as n_bytes from (select distinct rec_id, ride_id, n_bytes from recordings) group by ride_id")
def s02(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "recordings").select("rec_id", "ride_id", "n_bytes").distinct().groupBy("ride_id").agg(F.count(F.lit(1)).alias("n_files"), F.sum("n_bytes").alias("n_bytes"))


@ref("ref_s03_csv", "select distinct ride_id, frame_id, timestamp from front_camera_timestamps")
def s03(spark: SparkSession, d: str) -> DataFrame:
    """A CSV stream written and scanned with its declared schema."""
    path = shared_dir(spark, "csv")
    table(spark, d, "front_camera_timestamps").select("ride_id", "frame_id", "timestamp").write.option("header", True).csv(path)
    schema = "ride_id long, " + files.SCHEMAS["front_camera_timestamps"]
    return spark.read.schema(schema).option("header", True).csv(path).distinct()


@ref("ref_s04_columns", "select ride_id, minute, count(*) as n, arg_min(linear, (us, control_id)) as first, arg_max(linear, (us, control_id)) as last from (select *, us // 60000000 as minute from (with " + CLN + " select * from cln)) group by ride_id, minute")
def s04(spark: SparkSession, d: str) -> DataFrame:
    """Columns as arrays, a minute each: an array of a whole ride would grow without bound."""
    rows = clean_control(spark, d).withColumn("minute", F.floor(F.col("us") / F.lit(60_000_000)))
    return rows.groupBy("ride_id", "minute").agg(F.transform(F.array_sort(F.collect_list(F.struct("us", "control_id", "linear"))), lambda s: s["linear"]).alias("linear")).select("ride_id", "minute", F.size("linear").cast("long").alias("n"), F.element_at("linear", 1).alias("first"), F.element_at("linear", -1).alias("last"))


@ref("ref_s05_first_file", "select ride_id, stream, min(uri) as uri from recordings group by ride_id, stream")
def s05(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "recordings").groupBy("ride_id", "stream").agg(F.min("uri").alias("uri"))


@ref("ref_s06_playlist", r"select regexp_extract(uri, '^(.*)_\d+\.csv$', 1) || '.m3u8' as path, row_number() over (partition by regexp_extract(uri, '^(.*)_\d+\.csv$', 1) order by segment_no, uri) - 1 as segment_idx, uri from (select distinct uri, segment_no from recordings)")
def s06(spark: SparkSession, d: str) -> DataFrame:
    """Playlists of one stream of one leg, built from the files and parsed again into segments."""
    base = F.regexp_extract("uri", r"^(.*)_\d+\.csv$", 1)
    body = F.concat(F.lit("#EXTM3U\n#EXT-X-VERSION:3\n"), F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("segment_no", "uri"))), lambda s: F.concat(F.lit("#EXTINF:10,\n"), s["uri"])), "\r\n"))
    lists = table(spark, d, "recordings").select("uri", "segment_no").distinct().groupBy(F.concat(base, F.lit(".m3u8")).alias("path")).agg(body.alias("content"))
    return files.playlist_segments(lists).select("path", F.col("segment_idx").cast("long").alias("segment_idx"), "uri")


@ref("ref_s08_frame_at", f"with {FRM} select ride_id, frame_id, us from (select *, row_number() over (partition by ride_id order by us, frame_id) - 1 as n from frm) where n = 30")
def s08(spark: SparkSession, d: str) -> DataFrame:
    return numbered(frames(spark, d), "n", order=("us", "frame_id")).where("n = 30").select("ride_id", "frame_id", "us")


@ref("ref_s09_trajectories", f"with {ODO} select traj_id, ride_id, idx, case when isnan(x) then null else x end as x, case when isnan(y) then null else y end as y, case when isnan(yaw) then null else yaw end as yaw, us from odo")
def s09(spark: SparkSession, d: str) -> DataFrame:
    return odometry(spark, d).select("traj_id", "ride_id", "idx", plain("x"), plain("y"), plain("yaw"), "us")


@ref("ref_s10_counts", "select ride_id, count(distinct rec_id) as n from recordings where stream = 'front' group by ride_id")
def s10(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "recordings").where("stream = 'front'").select("ride_id", "rec_id").distinct().groupBy("ride_id").agg(F.count(F.lit(1)).alias("n"))


@ref("ref_s11_manifest", "select distinct uri as url, split_part(uri, '/', -1) as file from recordings")
def s11(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "recordings").select(F.col("uri").alias("url"), files.last_part(F.col("uri")).alias("file")).distinct()


@ref("ref_s12_imu_samples")
def s12(spark: SparkSession, d: str) -> DataFrame:
    """JSON cells to sample rows; several firmware layouts, so no SQL is given."""
    return nested.sample_table(table(spark, d, "imu_data")).select("imu_id", "ride_id", "sensor", "sample_idx", "x", "y", "z", "timestamp")


# --- sinks


@ref("ref_k01_write_trajectories", "select traj_id, ride_id, cast(len(timestamps) as bigint) as n_odom, cast(len(control_timestamps) as bigint) as n_control from (select distinct on (traj_id) * from traj_data)")
def k01(spark: SparkSession, d: str) -> DataFrame:
    out = cut(table(spark, d, "traj_data").dropDuplicates(["traj_id"]).repartitionByRange("ride_id"), "trajectories")
    return out.select("traj_id", "ride_id", F.size("timestamps").cast("long").alias("n_odom"), F.size("control_timestamps").cast("long").alias("n_control"))


@ref("ref_k02_stats", f"with {CLN}, {FRM}, s as (select *, us - lag(us) over {_ORD} as dt from cln), c as (select ride_id, count(*) filter (linear = 0 and angular = 0) as stationary_control, count(*) as total_control, avg(dt) / 1e6 as mean_dt from s group by ride_id), f as (select ride_id, count(*) as total_frames from frm group by ride_id), m as (select ride_id, count(distinct frame_id) as missing_frames from front_camera_timestamps where timestamp is null group by ride_id) select ride_id, stationary_control, total_control, round(stationary_control / total_control, 6) as ratio, coalesce(total_frames, 0) as total_frames, total_control as total_odom, round(mean_dt, 4) as mean_dt, coalesce(missing_frames, 0) as missing_frames from c left join f using (ride_id) left join m using (ride_id)")
def k02(spark: SparkSession, d: str) -> DataFrame:
    """A record of statistics for every ride, written as JSON lines and read back."""
    c = g01(spark, d).select("ride_id", F.col("stationary").alias("stationary_control"), F.col("total").alias("total_control"), "ratio", "mean_dt")
    f = frames(spark, d).groupBy("ride_id").agg(F.count(F.lit(1)).alias("total_frames"))
    m = table(spark, d, "front_camera_timestamps").where("timestamp is null").select("ride_id", "frame_id").distinct().groupBy("ride_id").agg(F.count(F.lit(1)).alias("missing_frames"))
    zero = lambda n: F.coalesce(n, F.lit(0).cast("long")).alias(n)
    stats = c.join(f, "ride_id", "left").join(m, "ride_id", "left").select("ride_id", "stationary_control", "total_control", "ratio", zero("total_frames"), F.col("total_control").alias("total_odom"), "mean_dt", zero("missing_frames"))
    path = shared_dir(spark, "stats")
    stats.write.json(path)
    return spark.read.schema(stats.schema).json(path)


@ref("ref_k05_renumber", f"with {FRM} select ride_id, frame_id, row_number() over (partition by ride_id order by us, frame_id) - 1 as new_idx from frm")
def k05(spark: SparkSession, d: str) -> DataFrame:
    return numbered(frames(spark, d), "new_idx", order=("us", "frame_id")).select("ride_id", "frame_id", "new_idx")


@ref("ref_k07_pending", "select distinct ride_id from rides where ride_id not in (select ride_id from traj_data where ride_id is not null)")
def k07(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "rides").select("ride_id").distinct().join(table(spark, d, "traj_data").select("ride_id").distinct(), "ride_id", "left_anti")


@ref("ref_k08_complete", f"with {FRM}, {ODO}, f as (select ride_id, count(*) as n_frames from frm group by ride_id), o as (select ride_id, count(*) as n_odom from odo group by ride_id) select ride_id, n_frames, n_odom, n_frames = n_odom as complete from f join o using (ride_id)")
def k08(spark: SparkSession, d: str) -> DataFrame:
    f = frames(spark, d).groupBy("ride_id").agg(F.count(F.lit(1)).alias("n_frames"))
    o = odometry(spark, d).groupBy("ride_id").agg(F.count(F.lit(1)).alias("n_odom"))
    return f.join(o, "ride_id").select("ride_id", "n_frames", "n_odom", (F.col("n_frames") == F.col("n_odom")).alias("complete"))


@ref("ref_k09_done", "select distinct traj_id from traj_data t where len(timestamps) > 0 and exists (select 1 from recordings r where r.ride_id = t.ride_id and stream = 'front')")
def k09(spark: SparkSession, d: str) -> DataFrame:
    has = table(spark, d, "recordings").where("stream = 'front'").select("ride_id").distinct()
    return table(spark, d, "traj_data").where(F.size("timestamps") > 0).select("traj_id", "ride_id").distinct().join(has, "ride_id", "left_semi").select("traj_id")


@ref("ref_k10_rejected", "select r.ride_id, case when c.ride_id is null then 'no control' else 'no frames' end as reason from (select distinct ride_id from rides) r left join (select distinct ride_id from control_data) c using (ride_id) left join (select distinct ride_id from front_camera_timestamps) f on f.ride_id = r.ride_id where c.ride_id is null or f.ride_id is null")
def k10(spark: SparkSession, d: str) -> DataFrame:
    """Incomplete rides go to a table of rejects; nothing is deleted."""
    has = lambda n, c: table(spark, d, n).select("ride_id").distinct().withColumn(c, F.lit(True))
    r = table(spark, d, "rides").select("ride_id").distinct().join(has("control_data", "c"), "ride_id", "left").join(has("front_camera_timestamps", "f"), "ride_id", "left")
    return r.where("c is null or f is null").select("ride_id", F.when(F.col("c").isNull(), "no control").otherwise("no frames").alias("reason"))


@ref("ref_f14_rejected_records", "with t as (select distinct traj_id, ride_id, uri from traj_data), f as (select distinct ride_id from recordings where stream = 'front') select traj_id, t.ride_id, 'no front files' as reason from t anti join f using (ride_id)")
def f14(spark: SparkSession, d: str) -> DataFrame:
    """Trajectory records whose ride has no front file at all (the list of the rejected)."""
    t = table(spark, d, "traj_data").select("traj_id", "ride_id", "uri").distinct()
    f = table(spark, d, "recordings").where("stream = 'front'").select("ride_id").distinct()
    return t.join(f, "ride_id", "left_anti").select("traj_id", "ride_id", F.lit("no front files").alias("reason"))


@ref("ref_k04_numbered_files", "select 'ride_' || ride_id || '_' || stream as folder, row_number() over (partition by ride_id, stream order by rec_id) - 1 as n, cast(octet_length(encode(payload)) as bigint) as n_bytes from (select distinct rec_id, ride_id, stream, payload from recordings where payload is not null)")
def k04(spark: SparkSession, d: str) -> DataFrame:
    """Binary cells as numbered files of a folder each, and their listing."""
    r = table(spark, d, "recordings").where("payload is not null").select("rec_id", "ride_id", "stream", "payload").distinct()
    n = (F.row_number().over(Window.partitionBy("ride_id", "stream").orderBy("rec_id")) - 1).cast("long")
    rows = r.select(F.format_string("ride_%d_%s", "ride_id", "stream").alias("folder"), n.alias("n"), F.encode("payload", "UTF-8").alias("content"))
    return files.write_numbered(rows, shared_dir(spark, "numbered"), "csv").select("folder", "n", "n_bytes")


@ref("ref_k13_summary", f"with {CTL}, {FRM} select (select count(distinct ride_id) from rides) as n_rides, (select count(*) from ctl) as n_control, (select count(*) from frm) as n_frames, (select count(distinct traj_id) from traj_data) as n_records")
def k13(spark: SparkSession, d: str) -> DataFrame:
    n = lambda df, c: df.agg(F.count(F.lit(1)).alias("n")).withColumn("what", F.lit(c))
    parts = [n(table(spark, d, "rides").select("ride_id").distinct(), "n_rides"), n(control(spark, d, ()), "n_control"), n(frames(spark, d), "n_frames"), n(table(spark, d, "traj_data").select("traj_id").distinct(), "n_records")]
    rows = parts[0].unionByName(parts[1]).unionByName(parts[2]).unionByName(parts[3])
    return rows.agg(*[F.max(F.when(F.col("what") == c, F.col("n"))).alias(c) for c in ("n_rides", "n_control", "n_frames", "n_records")])


# --- projections and filters


@ref("ref_p02_rename", f"with {ODO} select traj_id, idx, case when isnan(x) then null else x end as position_x, case when isnan(y) then null else y end as position_y from odo")
def p02(spark: SparkSession, d: str) -> DataFrame:
    return odometry(spark, d).select("traj_id", "idx", plain("x"), plain("y")).withColumnsRenamed({"x": "position_x", "y": "position_y"})


@ref("ref_p03_matrix", f"with {CLN} select control_id, rpm_1 as left_front, rpm_4 as right_rear, greatest(rpm_1, rpm_2, rpm_3, rpm_4) as top from cln")
def p03(spark: SparkSession, d: str) -> DataFrame:
    return clean_control(spark, d).select("control_id", F.array(*WHEELS).alias("m")).select("control_id", F.element_at("m", 1).alias("left_front"), F.element_at("m", 4).alias("right_rear"), F.array_max("m").alias("top"))


@ref("ref_p04_clocks", f"with {CTL}, {FIX} select 'control' as stream, control_id as id, us - 500000 as us from ctl union all select 'gps', gps_id, us - 6000000 from fix")
def p04(spark: SparkSession, d: str) -> DataFrame:
    c = control(spark, d, ()).select(F.lit("control").alias("stream"), F.col("control_id").alias("id"), (F.col("us") + RPM.control_offset_us).alias("us"))
    return c.unionByName(fixes(spark, d).select(F.lit("gps").alias("stream"), F.col("gps_id").alias("id"), (F.col("us") - 6_000_000).alias("us")))


@ref("ref_p05_rebase", f"with {ODO}, o as (select * from odo where isfinite(x) and isfinite(y)) select traj_id, idx, round(x - first_value(x) over w, 6) as x, round(y - first_value(y) over w, 6) as y from o window w as (partition by traj_id order by idx)")
def p05(spark: SparkSession, d: str) -> DataFrame:
    w = resample.by_record()
    o = odometry(spark, d).where(finite(F.col("x")) & finite(F.col("y")))
    return o.select("traj_id", "idx", r6(F.col("x") - F.first("x").over(w)).alias("x"), r6(F.col("y") - F.first("y").over(w)).alias("y"))


@ref("ref_f01_clean", f"with {CLN} select control_id, ride_id, us, linear, angular, rpm_1 from cln")
def f01(spark: SparkSession, d: str) -> DataFrame:
    return clean_control(spark, d).select("control_id", "ride_id", "us", "linear", "angular", "rpm_1")


@ref("ref_f02_nonempty", f"with {CLN} select ride_id from rides where ride_id in (select ride_id from cln)")
def f02(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "rides").join(clean_control(spark, d).select("ride_id").distinct(), "ride_id", "left_semi").select("ride_id")


@ref("ref_f03_first_fix", f"select ride_id from (select ride_id, arg_min(struct_pack(a := latitude, o := longitude), (us, gps_id)) as f from (select distinct gps_id, ride_id, latitude, longitude, {_MS.format('timestamp')} as us from gps_data where isfinite(timestamp)) group by ride_id) where f.a between -80 and 84 and f.o between -180 and 180")
def f03(spark: SparkSession, d: str) -> DataFrame:
    """Rides whose first fix lies in the range of UTM."""
    g = table(spark, d, "gps_data").select("ride_id", "gps_id", "latitude", "longitude", micros(F.col("timestamp")).alias("us")).where("us is not null")
    f = g.groupBy("ride_id").agg(F.min_by(F.struct("latitude", "longitude"), F.struct("us", "gps_id")).alias("f"))
    return f.where("f.latitude between -80 and 84 and f.longitude between -180 and 180").select("ride_id")


@ref("ref_f04_cutoff", f"with {CTL}, {FRM}, z as (select ride_id, arg_min(us, frame_id) as t0 from frm group by ride_id) select control_id, ride_id from ctl join z using (ride_id) where us - t0 >= -100000")
def f04(spark: SparkSession, d: str) -> DataFrame:
    """Rows from 0.1 s before the first listed frame on."""
    t0 = frames(spark, d).groupBy("ride_id").agg(F.min_by("us", "frame_id").alias("t0"))
    return control(spark, d, ()).join(t0, "ride_id").where("us - t0 >= -100000").select("control_id", "ride_id")


@ref("ref_f06_min_rows", f"with {CLN} select ride_id, count(*) as n from cln group by ride_id having count(*) >= 5")
def f06(spark: SparkSession, d: str) -> DataFrame:
    return clean_control(spark, d).groupBy("ride_id").agg(F.count(F.lit(1)).alias("n")).where("n >= 5")


@ref("ref_f07_drop_first", f"with {CLN} select control_id from (select control_id, row_number() over {_ORD} as n from cln) where n > 1")
def f07(spark: SparkSession, d: str) -> DataFrame:
    return previous(clean_control(spark, d), []).where("prev is not null").select("control_id")


@ref("ref_f09_stationary", f"with {CTL} select control_id from ctl where linear = 0 and angular = 0")
def f09(spark: SparkSession, d: str) -> DataFrame:
    return control(spark, d).where("linear = 0 and angular = 0").select("control_id")


@ref("ref_f10_still", f"with {CLN} select control_id from cln where abs(linear) < 0.05 and abs(angular) < 0.05")
def f10(spark: SparkSession, d: str) -> DataFrame:
    return clean_control(spark, d).where(resample.paused(F.col("linear"), F.col("angular"))).select("control_id")


@ref("ref_f11_straight", f"with {CLN} select control_id, abs(linear) > 0.1 and angular < 0.05 as straight, abs(linear) > 0.1 and abs(angular) < 0.05 as straight_abs from cln")
def f11(spark: SparkSession, d: str) -> DataFrame:
    a, b = F.col("linear"), F.col("angular")
    return clean_control(spark, d).select("control_id", resample.straight(a, b).alias("straight"), resample.straight(a, b, abs_angular=True).alias("straight_abs"))


@ref("ref_f13_mismatch", "select traj_id, cast(len(timestamps) as bigint) as n, cast(len(control_timestamps) as bigint) as m from (select distinct on (traj_id) * from traj_data) where len(timestamps) <> len(control_timestamps)")
def f13(spark: SparkSession, d: str) -> DataFrame:
    t = table(spark, d, "traj_data").select("traj_id", F.size("timestamps").cast("long").alias("n"), F.size("control_timestamps").cast("long").alias("m"))
    return t.where("n <> m").dropDuplicates(["traj_id"])


# --- joins


def _asof_sql(left: str, lid: str, right: str, rid: str, key: str, where: str = "") -> str:
    return f""", rr as (select {key}, us, min({rid}) as {rid} from {right} group by {key}, us),
a as (select l.{key}, l.{lid}, l.us, r.us as u0, r.{rid} as r0 from {left} l asof left join rr r on l.{key} = r.{key} and l.us >= r.us),
b as (select a.*, r.us as u1, r.{rid} as r1 from a asof left join rr r on a.{key} = r.{key} and a.us <= r.us),
n as (select {lid}, case when u0 is not null and (u1 is null or us - u0 <= u1 - us) then r0 else r1 end as {rid}, case when u0 is not null and (u1 is null or us - u0 <= u1 - us) then us - u0 else u1 - us end as distance_us from b)
select {lid}, {rid}, distance_us from n where {rid} is not null {where}"""


@ref("ref_a01_nearest_frame", f"with {CTL}, {FRM} {_asof_sql('ctl', 'control_id', 'frm', 'frame_id', 'ride_id', 'and distance_us <= 100000')}")
def a01(spark: SparkSession, d: str) -> DataFrame:
    """Nearest frame of every control row within 0.1 s (with F05)."""
    return asof.nearest(control(spark, d, ()), frames(spark, d), "ride_id", "control_id", "frame_id", 100_000).select("control_id", "frame_id", "distance_us")


@ref("ref_a02_odom_control", f"with {ODO}, {CMD}, o as (select struct_pack(traj_id := traj_id, idx := idx) as oid, traj_id, us from odo) {_asof_sql('o', 'oid', 'cmd', 'cidx', 'traj_id')}".replace("select oid, cidx", "select oid.traj_id as traj_id, oid.idx as idx, cidx"))
def a02(spark: SparkSession, d: str) -> DataFrame:
    """Nearest command of every odometry row of a record, whatever the distance."""
    return asof.nearest(odometry(spark, d), commands(spark, d), "traj_id", "idx", "cidx").select("traj_id", "idx", "cidx", "distance_us")


@ref("ref_a03_odom_frame", f"with {ODO}, {FRM}, o as (select struct_pack(traj_id := traj_id, idx := idx) as oid, ride_id, us from odo) {_asof_sql('o', 'oid', 'frm', 'frame_id', 'ride_id')}".replace("select oid, frame_id", "select oid.traj_id as traj_id, oid.idx as idx, frame_id"))
def a03(spark: SparkSession, d: str) -> DataFrame:
    o = odometry(spark, d).select("ride_id", F.struct("traj_id", "idx").alias("oid"), "us")
    return asof.nearest(o, frames(spark, d), "ride_id", "oid", "frame_id").select("oid.traj_id", "oid.idx", "frame_id", "distance_us")


@ref("ref_a04_anchor", f"with {CTL}, {FIX}, g as (select ride_id, min(us) as t from fix group by ride_id), c as (select ride_id, arg_min(struct_pack(i := control_id, u := us), (abs(us - t), us, control_id)) as a from ctl join g using (ride_id) group by ride_id) select ride_id, c.a.i as control_id, arg_min(gps_id, (abs(us - c.a.u), us, gps_id)) as gps_id from fix join c using (ride_id) group by ride_id, c.a")
def a04(spark: SparkSession, d: str) -> DataFrame:
    """First fix -> nearest control row -> its nearest fix."""
    g = fixes(spark, d)
    first = g.groupBy("ride_id").agg(F.min("us").alias("t"))
    c = control(spark, d, ()).join(first, "ride_id").groupBy("ride_id").agg(F.min_by(F.struct("control_id", "us"), F.struct(F.abs(F.col("us") - F.col("t")), "us", "control_id")).alias("a"))
    back = g.join(c, "ride_id").groupBy("ride_id").agg(F.first("a.control_id").alias("control_id"), F.min_by("gps_id", F.struct(F.abs(F.col("us") - F.col("a.us")), "us", "gps_id")).alias("gps_id"))
    return back


@ref("ref_a05_fix_compass")
def a05(spark: SparkSession, d: str) -> DataFrame:
    """Nearest compass sample of every fix (JSON cells, no SQL)."""
    s = nested.sample_table(table(spark, d, "imu_data")).where("sensor = 'compass'")
    s = s.select("ride_id", F.struct("imu_id", "sample_idx").alias("sid"), F.floor(F.col("timestamp") * 1e6 + 0.5).alias("us"))
    return asof.nearest(fixes(spark, d), s, "ride_id", "gps_id", "sid").select("gps_id", "sid.imu_id", "sid.sample_idx", "distance_us")


@ref("ref_a06_forward", f"with {CTL}, {FIX}, rr as (select ride_id, us, min(control_id) as control_id from ctl group by ride_id, us), z as (select ride_id, arg_max(control_id, us) as zid from rr group by ride_id) select gps_id, coalesce(r.control_id, zid) as control_id from fix l asof left join rr r on l.ride_id = r.ride_id and l.us <= r.us join z on z.ride_id = l.ride_id")
def a06(spark: SparkSession, d: str) -> DataFrame:
    """First control row at or after every fix, the ride's last one where none follows."""
    return asof.forward(fixes(spark, d), control(spark, d, ()), "ride_id", "gps_id", "control_id").select("gps_id", "control_id")


@ref("ref_a07_next_frame", f"with {CTL}, {FRM}, rr as (select ride_id, us, min(frame_id) as frame_id from frm group by ride_id, us) select control_id, frame_id from ctl l asof join rr r on l.ride_id = r.ride_id and l.us <= r.us")
def a07(spark: SparkSession, d: str) -> DataFrame:
    """First frame at or after every control row; control rows after the last frame have none."""
    return asof.forward(control(spark, d, ()), frames(spark, d), "ride_id", "control_id", "frame_id", clamp=False).select("control_id", "frame_id")


@ref("ref_w12_frame_pairs", f"with {FRM} select ride_id, frame_id, prev_frame_id, us, step_us from (select ride_id, frame_id, lag(frame_id) over w as prev_frame_id, us, us - lag(us) over w as step_us from frm window w as (partition by ride_id order by us, frame_id)) where prev_frame_id is not null")
def w12(spark: SparkSession, d: str) -> DataFrame:
    """Every frame with the one before it, as an operator on image pairs takes them."""
    return flow.frame_pairs(frames(spark, d))


@ref("ref_a08_zip", f"with {FRM}, {CTL}, a as (select ride_id, frame_id, row_number() over (partition by ride_id order by us, frame_id) as n from frm), b as (select ride_id, control_id, row_number() over {_ORD} as n from ctl) select ride_id, frame_id, control_id from a join b using (ride_id, n)")
def a08(spark: SparkSession, d: str) -> DataFrame:
    a = numbered(frames(spark, d), "n", order=("us", "frame_id")).select("ride_id", "n", "frame_id")
    b = numbered(control(spark, d, ()), "n").select("ride_id", "n", "control_id")
    return a.join(b, ["ride_id", "n"]).select("ride_id", "frame_id", "control_id")


@ref("ref_a09_semi", f"with {FRM}, {CTL} select distinct ride_id, frame_id from frm where (ride_id, us // 1000) in (select (ride_id, us // 1000) from ctl)")
def a09(spark: SparkSession, d: str) -> DataFrame:
    """Frames whose millisecond is that of a control row."""
    ms = lambda df, *c: df.select("ride_id", F.floor(F.col("us") / F.lit(1000)).alias("ms"), *c)
    return ms(frames(spark, d), "frame_id").join(ms(control(spark, d, ())), ["ride_id", "ms"], "left_semi").select("ride_id", "frame_id")


@ref("ref_a10_missing_frames", "with l as (select distinct ride_id, frame_id from front_camera_timestamps where timestamp is null), o as (select distinct ride_id, frame_id from front_camera_timestamps where timestamp is not null) select ride_id, frame_id from l anti join o using (ride_id, frame_id)")
def a10(spark: SparkSession, d: str) -> DataFrame:
    """Listed frames without any time (anti join)."""
    f = table(spark, d, "front_camera_timestamps").select("ride_id", "frame_id", "timestamp")
    return f.where("timestamp is null").select("ride_id", "frame_id").distinct().join(f.where("timestamp is not null"), ["ride_id", "frame_id"], "left_anti")


@ref("ref_a12_lookup", "select distinct c.rec_id, r.ride_key, r.robot_id from recordings c join rides r using (ride_id)")
def a12(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "recordings").select("rec_id", "ride_id").distinct().join(table(spark, d, "rides").select("ride_id", "ride_key", "robot_id"), "ride_id").select("rec_id", "ride_key", "robot_id")


_SPEED = f"{CLN}, s as (select ride_id, row_number() over {_ORD} - 1 as i, (rpm_1 + rpm_2 + rpm_3 + rpm_4) / 4 as a, linear as b from cln)"


def _series(spark: SparkSession, d: str) -> DataFrame:
    return numbered(clean_control(spark, d)).select("ride_id", "seq", ((F.col("rpm_1") + F.col("rpm_2") + F.col("rpm_3") + F.col("rpm_4")) / 4).alias("a"), F.col("linear").alias("b"))


_LAGS = """, k as (select unnest(range(-20, 20)) as lag), p as (select x.ride_id, lag, x.a, y.b from s y cross join k join s x on x.ride_id = y.ride_id and x.i = y.i + lag),
t as (select ride_id, lag, count(*) as n, var_pop(a) as va, var_pop(b) as vb, covar_pop(a, b) as c from p group by ride_id, lag having count(*) >= 2)"""


@ref("ref_a13_lag_join", f"with {_SPEED}{_LAGS} select ride_id, lag, n, round(case when va > 1e-9 and vb > 1e-9 then c / sqrt(va * vb) end, 5) as r from t")
def a13(spark: SparkSession, d: str) -> DataFrame:
    """Correlation of wheel speed and command at 40 lags."""
    return signal.lagged_correlation(_series(spark, d), "a", "b", (-20, 20)).select("ride_id", "lag", "n", F.round("r", 5).alias("r"))


@ref("ref_a13_all_lags", f"with {_SPEED}{_LAGS.replace('range(-20, 20)', 'range(-100, 100)')} select ride_id, lag, n, round(case when va > 1e-9 and vb > 1e-9 then c / sqrt(va * vb) end, 5) as r from t")
def a13_all(spark: SparkSession, d: str) -> DataFrame:
    """The same at all 200 lags of the inventory, -100 to 99."""
    return signal.lagged_correlation(_series(spark, d), "a", "b").select("ride_id", "lag", "n", F.round("r", 5).alias("r"))


@ref("ref_e02_alignment", f"with {_SPEED}{_LAGS.replace('range(-20, 20)', 'range(-100, 100)')}, q as (select ride_id, lag, case when va > 1e-9 and vb > 1e-9 then c / sqrt(va * vb) end as r from t), b as (select ride_id, bool_or(r is null) as undefined, arg_min(lag, (-r, lag)) as lag, max(r) as r from q group by ride_id) select ride_id, case when not undefined then lag end as lag, round(case when not undefined then r end, 5) as r, coalesce(not undefined and r > 0.7, false) as aligned from b")
def e02(spark: SparkSession, d: str) -> DataFrame:
    """The lag of greatest correlation among 200, and whether it is above 0.7 (G13). ref_a13_all_lags holds the correlations against SQL."""
    return signal.best_lag(signal.lagged_correlation(_series(spark, d), "a", "b")).withColumn("r", F.round("r", 5))


@ref("ref_w15_shift", f"with {_SPEED} select x.ride_id, x.i as seq, round(x.a, 6) as a, y.b from s x join s y on x.ride_id = y.ride_id and y.i = x.i + 3")
def w15(spark: SparkSession, d: str) -> DataFrame:
    """Commands shifted by 3 rows against wheel speeds."""
    s = _series(spark, d)
    lags = table(spark, d, "rides").select("ride_id").distinct().withColumn("lag", F.lit(3).cast("long"))
    return signal.shifted(s, lags, ["b"], ["a"]).select("ride_id", "seq", r6(F.col("a")).alias("a"), "b")


@ref("ref_w15_aligned")
def w15_aligned(spark: SparkSession, d: str) -> DataFrame:
    """Every ride's commands with the wheels `lag` rows later, lag being ref_e02's where it is aligned, else 0; seq is the wheels' row.

    These are the pairs whose correlation ref_e02 found greatest. The reference slices the other way round and then drops the result.
    """
    rows = numbered(clean_control(spark, d)).select("ride_id", "seq", "control_id", "us", "linear", "angular", *WHEELS)
    lags = e02(spark, d).select("ride_id", F.when(F.col("aligned"), -F.col("lag")).alias("lag"))
    return signal.shifted(rows, lags, ["control_id", "us", "linear", "angular"], list(WHEELS))


# --- aggregations


@ref("ref_g01_ride_stats", f"with {CLN}, s as (select *, us - lag(us) over {_ORD} as dt from cln) select ride_id, count(*) filter (linear = 0 and angular = 0) as stationary, count(*) as total, round(count(*) filter (linear = 0 and angular = 0) / count(*), 6) as ratio, round(avg(dt) / 1e6, 4) as mean_dt from s group by ride_id")
def g01(spark: SparkSession, d: str) -> DataFrame:
    """Stationary rows, rows, their ratio and the mean time step of every ride."""
    s = previous(clean_control(spark, d), ["us"])
    still = F.count_if((F.col("linear") == 0) & (F.col("angular") == 0))
    return s.groupBy("ride_id").agg(still.alias("stationary"), F.count(F.lit(1)).alias("total"), F.round(F.try_divide(still, F.count(F.lit(1))), 6).alias("ratio"), F.round(F.avg(F.col("us") - F.col("prev.us")) / 1e6, 4).alias("mean_dt"))


@ref("ref_g05_late_step", f"with {CLN}, s as (select ride_id, us, row_number() over {_ORD} - 1 as i, count(*) over (partition by ride_id) as n from cln), t as (select ride_id, us - lag(us) over (partition by ride_id order by i) as dt from s where i >= floor(n * 0.2)) select ride_id, round(avg(dt) / 1e6, 4) as mean_dt from t group by ride_id")
def g05(spark: SparkSession, d: str) -> DataFrame:
    """Mean time step over the last 80 % of the rows."""
    s = numbered(clean_control(spark, d))
    n = s.groupBy("ride_id").agg(F.count(F.lit(1)).alias("n"))
    late = s.join(n, "ride_id").where(F.col("seq") >= F.floor(F.col("n") * 0.2)).select("ride_id", "chunk", "control_id", "us")
    return previous(late, ["us"], settle=True).groupBy("ride_id").agg(F.round(F.avg(F.col("us") - F.col("prev.us")) / 1e6, 4).alias("mean_dt"))


@ref("ref_g06_missing_list", "with l as (select distinct ride_id, frame_id from front_camera_timestamps where timestamp is null) select ride_id, frame_id // 1000 as block, string_agg(cast(frame_id as varchar), ',' order by frame_id) as missing from l group by all")
def g06(spark: SparkSession, d: str) -> DataFrame:
    """Frames without time as lists, per thousand frames of a ride so that no list grows without bound."""
    f = table(spark, d, "front_camera_timestamps").where("timestamp is null").select("ride_id", "frame_id").distinct()
    return f.groupBy("ride_id", F.floor(F.col("frame_id") / F.lit(1000)).alias("block")).agg(F.array_join(F.sort_array(F.collect_list("frame_id")), ",").alias("missing"))


@ref("ref_g07_totals", f"with {CLN} select count(*) filter (linear = 0 and angular = 0) as stationary, count(*) as total, round(100.0 * count(*) filter (linear = 0 and angular = 0) / count(*), 6) as percent from cln")
def g07(spark: SparkSession, d: str) -> DataFrame:
    still = F.count_if((F.col("linear") == 0) & (F.col("angular") == 0))
    return clean_control(spark, d).agg(still.alias("stationary"), F.count(F.lit(1)).alias("total"), r6(F.try_divide(still * F.lit(100.0), F.count(F.lit(1)))).alias("percent"))


_GOOD = f"{ODO}, g as (select * from odo where isfinite(x) and isfinite(y)), s as (select *, sqrt(pow(x - lag(x) over w, 2) + pow(y - lag(y) over w, 2)) as step, us - lag(us) over w as dt from g window w as (partition by traj_id order by idx))"


def _good(spark: SparkSession, d: str) -> DataFrame:
    return resample.spacing(odometry(spark, d).where(finite(F.col("x")) & finite(F.col("y"))))


@ref("ref_g08_spacing", f"with {_GOOD} select round(avg(step), 6) as mean_step, round(avg(dt) / 1e6, 6) as mean_dt from s")
def g08(spark: SparkSession, d: str) -> DataFrame:
    """Mean spacing and time step of the whole dataset."""
    return _good(spark, d).agg(r6(F.avg("step_m")).alias("mean_step"), r6(F.avg("step_us") / 1e6).alias("mean_dt"))


@ref("ref_g14_normalise", f"with {CLN}, m as (select ride_id, max(abs(linear)) as m from cln group by ride_id) select control_id, round(linear / m, 6) as linear from cln join m using (ride_id) where m > 0")
def g14(spark: SparkSession, d: str) -> DataFrame:
    c = clean_control(spark, d)
    m = c.groupBy("ride_id").agg(F.max(F.abs("linear")).alias("m")).where("m > 0")
    return c.join(m, "ride_id").select("control_id", r6(F.col("linear") / F.col("m")).alias("linear"))


@ref("ref_g15_distinct_first", f"with {FRM} select ride_id, us, min(frame_id) as frame_id from frm group by ride_id, us")
def g15(spark: SparkSession, d: str) -> DataFrame:
    return frames(spark, d).groupBy("ride_id", "us").agg(F.min("frame_id").alias("frame_id"))


@ref("ref_g16_duplicates", f"with {FRM} select ride_id, frame_id from (select *, row_number() over (partition by ride_id, us order by frame_id) as n from frm) where n > 1")
def g16(spark: SparkSession, d: str) -> DataFrame:
    return frames(spark, d).withColumn("n", F.row_number().over(Window.partitionBy("ride_id", "chunk", "us").orderBy("frame_id"))).where("n > 1").select("ride_id", "frame_id")


@ref("ref_g18_bad_rows", f"with {CTL} select ride_id, count(*) filter (not coalesce(isfinite(linear) and isfinite(angular), false)) as bad from ctl group by ride_id")
def g18(spark: SparkSession, d: str) -> DataFrame:
    return control(spark, d).groupBy("ride_id").agg(F.count_if(~(finite(F.col("linear")) & finite(F.col("angular")))).alias("bad"))


# --- windows


@ref("ref_w01_difference", f"with {CLN} select control_id, us - lag(us) over {_ORD} as dt_us, round(linear - lag(linear) over {_ORD}, 6) as d_linear from cln")
def w01(spark: SparkSession, d: str) -> DataFrame:
    p = previous(clean_control(spark, d), ["us", "linear"])
    return p.select("control_id", (F.col("us") - F.col("prev.us")).alias("dt_us"), r6(F.col("linear") - F.col("prev.linear")).alias("d_linear"))


@ref("ref_w02_spacing", f"with {_GOOD} select traj_id, idx, round(step, 6) as step_m from s where step is not null")
def w02(spark: SparkSession, d: str) -> DataFrame:
    return _good(spark, d).where("step_m is not null").select("traj_id", "idx", r6("step_m").alias("step_m"))


@ref("ref_w03_heading", f"with {_GOOD} select traj_id, idx, round(coalesce(atan2(y - lag(y) over w, x - lag(x) over w), 0), 6) as heading from g window w as (partition by traj_id order by idx)")
def w03(spark: SparkSession, d: str) -> DataFrame:
    w = resample.by_record()
    dy, dx = (F.col(c) - F.lag(c).over(w) for c in ("y", "x"))
    return odometry(spark, d).where(finite(F.col("x")) & finite(F.col("y"))).select("traj_id", "idx", r6(F.coalesce(F.atan2(dy, dx), F.lit(0.0))).alias("heading"))


@ref("ref_w04_speed", f"with {_GOOD}, v as (select traj_id, idx, us, dt, case when dt > 0 then step / (dt / 1e6) end as speed, case when dt > 0 then atan2(y - lag(y) over w, x - lag(x) over w) end as h from s window w as (partition by traj_id order by idx)) select traj_id, idx, round(speed, 4) as speed, round((h - lag(h) over (partition by traj_id order by idx)) / (dt / 1e6), 4) as yaw_rate from v where dt > 0 ")
def w04(spark: SparkSession, d: str) -> DataFrame:
    """Speed and yaw rate from positions; the heading is not unwrapped."""
    w = resample.by_record()
    dy, dx = (F.col(c) - F.lag(c).over(w) for c in ("y", "x"))
    s = _good(spark, d).withColumn("h", F.when(F.col("step_us") > 0, F.atan2(dy, dx))).where("step_us > 0")
    dt = F.col("step_us") / 1e6
    return s.select("traj_id", "idx", F.round(F.col("step_m") / dt, 4).alias("speed"), F.round((F.col("h") - F.lag("h").over(w)) / dt, 4).alias("yaw_rate"))


def integrate(rows: DataFrame) -> DataFrame:
    """x, y, theta of every row. rows: ride_id, chunk, us, control_id, dt (s, from the row before), v and w to apply over it; null terms count as 0. A column spin, if there, adds to theta without turning the way: whole turns.

    Each time chunk is integrated from a pose of its own, in windows that need no second shuffle. The pose a chunk begins at comes
    from one row a chunk (the headings' running sum turns the chunks' ways, theirs adds them up), and moves its rows into place.
    """
    keys, last = ["ride_id", "chunk"], F.struct("us", "control_id")
    w = Window.partitionBy(*keys).orderBy("us", "control_id").rowsBetween(Window.unboundedPreceding, 0)
    total = lambda c: F.sum(F.coalesce(c, F.lit(0.0))).over(w)
    way = F.col("v") * F.col("dt")
    spin = F.col("spin") if "spin" in rows.columns else F.lit(0.0)
    local = rows.withColumns({"_t": total(F.col("w") * F.col("dt")), "_s": total(spin)})
    local = cut(local.withColumns({"_x": total(way * F.cos("_t")), "_y": total(way * F.sin("_t"))}), "local")
    before = Window.partitionBy("ride_id").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    start = lambda c: F.coalesce(F.sum(c).over(before), F.lit(0.0))
    pose = local.groupBy(*keys).agg(F.max_by(F.struct("_t", "_s", "_x", "_y"), last).alias("_e")).select(*keys, "_e.*").withColumns({"_t0": start("_t"), "_s0": start("_s")})
    turned = lambda x, y, t: (x * F.cos(t) - y * F.sin(t), x * F.sin(t) + y * F.cos(t))
    x, y = turned(F.col("_x"), F.col("_y"), F.col("_t0"))
    pose = pose.select(*keys, "_t0", "_s0", x.alias("_dx"), y.alias("_dy")).withColumns({"_x0": start("_dx"), "_y0": start("_dy")}).drop("_dx", "_dy")
    x, y = turned(F.col("_x"), F.col("_y"), F.col("_t0"))
    out = local.join(pose, keys).withColumns({"x": F.col("_x0") + x, "y": F.col("_y0") + y, "theta": F.col("_t0") + F.col("_t") + F.col("_s0") + F.col("_s")})
    return out.drop("spin", "_t", "_s", "_x", "_y", "_t0", "_s0", "_x0", "_y0")


def _dead_reckoning(spark: SparkSession, d: str, wheels: bool) -> DataFrame:
    c = clean_control(spark, d)
    v, w = wheel_speed(*(F.col(x) for x in WHEELS), RPM) if wheels else command_speed(F.col("linear"), F.col("angular"), RPM)
    p = previous(c.withColumn("v", v).withColumn("w", w), ["us", "v", "w"])
    use = ["v", "w"] if wheels else ["prev.v", "prev.w"]
    dt, w = (F.col("us") - F.col("prev.us")) / 1e6, F.col(use[1])
    # an impossible wheel speed turns the robot round millions of times in a step: the way is turned by the rest only, which stays exact
    spin = F.floor(w * dt / _TURN) * _TURN
    w, cols = (F.when(dt > 0, (w * dt - spin) / dt).otherwise(0.0), [spin.alias("spin")]) if wheels else (w, [])
    rows = p.select("ride_id", "chunk", "us", "control_id", dt.alias("dt"), F.col(use[0]).alias("v"), w.alias("w"), *cols, F.col("prev").isNotNull().alias("_later"))
    return integrate(rows).where("_later").select("control_id", *[F.round(x, 2).alias(x) for x in ("x", "y", "theta")])


_TURN = 2 * math.pi


def _reckon_sql(v: str, w: str, lagged: bool) -> str:
    a, b = (f"lag({v}) over {_ORD}", f"lag({w}) over {_ORD}") if lagged else (v, w)
    turn = "w * dt" if lagged else f"w * dt - floor(w * dt / {_TURN!r}) * {_TURN!r}"
    return f"with {CLN}, s as (select ride_id, control_id, us, (us - lag(us) over {_ORD}) / 1e6 as dt, {a} as v, {b} as w from cln), t as (select *, sum({turn}) over {_ORD} as heading, sum(w * dt) over {_ORD} as theta from s), u as (select *, sum(v * dt * cos(heading)) over {_ORD} as x, sum(v * dt * sin(heading)) over {_ORD} as y from t) select control_id, round(x, 2) as x, round(y, 2) as y, round(theta, 2) as theta from u where dt is not null"


@ref("ref_w05_integrate", _reckon_sql("(linear * 0.83)", "((angular - 0.0) * 0.9)", True))
def w05(spark: SparkSession, d: str) -> DataFrame:
    """Position from commands: each step applies the command of the row before and the heading after it."""
    return _dead_reckoning(spark, d, wheels=False)


_PER = repr(math.pi * RPM.wheel_m / 60.0)


@ref("ref_w05b_wheels", _reckon_sql(f"(((rpm_2 + rpm_4) * {_PER} + (rpm_1 + rpm_3) * {_PER}) / 2.0)", f"(((rpm_2 + rpm_4) * {_PER} - (rpm_1 + rpm_3) * {_PER}) / 0.306)", False))
def w05b(spark: SparkSession, d: str) -> DataFrame:
    """The same from wheel speeds of the row itself."""
    return _dead_reckoning(spark, d, wheels=True)


@ref("ref_w06_straight_runs", f"with {CLN}, f as (select *, abs(linear) > 0.1 and angular < 0.05 as s from cln), c as (select *, case when lag(s) over {_ORD} = s then 0 else 1 end as ch from f), g as (select *, sum(ch) over {_ORD} as run from c) select ride_id, arg_min(control_id, (us, control_id)) as first_id, arg_max(control_id, (us, control_id)) as last_id, count(*) as n from g where s group by ride_id, run")
def w06(spark: SparkSession, d: str) -> DataFrame:
    """Maximal straight runs of control rows (gaps and islands)."""
    g = islands(clean_control(spark, d), resample.straight(F.col("linear"), F.col("angular"))).where("flag")
    at = F.struct("us", "control_id")
    return g.groupBy("ride_id", "island").agg(F.min(at).alias("a"), F.max(at).alias("b"), F.count(F.lit(1)).alias("n")).select("ride_id", F.col("a.control_id").alias("first_id"), F.col("b.control_id").alias("last_id"), "n")


_REC = f"{ODO}, {CMD}, o as (select struct_pack(traj_id := traj_id, idx := idx) as oid, traj_id, us from odo)"
_WITH_CMD = _asof_sql("o", "oid", "cmd", "cidx", "traj_id").replace("select oid, cidx, distance_us from n where cidx is not null", "").strip()
_STILL = f"with {_REC} {_WITH_CMD}, q as (select odo.traj_id, odo.idx, odo.us, coalesce(isfinite(linear) and isfinite(angular) and abs(linear) < 0.05 and abs(angular) < 0.05, false) as still, coalesce(isfinite(linear) and isfinite(angular) and abs(linear) > 0.1 and angular < 0.05, false) as straight from odo join n on n.oid.traj_id = odo.traj_id and n.oid.idx = odo.idx join cmd on cmd.traj_id = odo.traj_id and cmd.cidx = n.cidx)"


def _with_commands(spark: SparkSession, d: str) -> DataFrame:
    """Odometry rows with the nearest command: traj_id, idx, us, paused, straight."""
    o = odometry(spark, d).select("traj_id", "idx", "us")
    c = commands(spark, d)
    near = asof.nearest(o, c, "traj_id", "idx", "cidx").select("traj_id", "idx", "us", "cidx").join(c.drop("us"), ["traj_id", "cidx"])
    a, b = F.col("linear"), F.col("angular")
    ok = finite(a) & finite(b)
    return near.select("traj_id", "idx", "us", (ok & resample.paused(a, b)).alias("paused"), (ok & resample.straight(a, b)).alias("straight"))


_FIN = "fin as (select traj_id, cidx, us, abs(linear) < 0.05 and abs(angular) < 0.05 as still from cmd where isfinite(linear) and isfinite(angular))"
_PAUSE = f"with {_REC}, {_FIN} {_asof_sql('o', 'oid', 'fin', 'cidx', 'traj_id').replace('select oid, cidx, distance_us from n where cidx is not null', '').strip()}" + """,
mv as (select *, min(case when not still then cidx end) over (partition by traj_id order by cidx rows between 1 following and unbounded following) as nm, max(cidx) over (partition by traj_id) as lastc from fin),
met as (select n.oid.traj_id as traj_id, n.oid.idx as idx, mv.cidx, still, mv.us as c_us, coalesce(nm, lastc) as end_cidx from n join mv on mv.traj_id = n.oid.traj_id and mv.cidx = n.cidx),
ps as (select traj_id, end_cidx, min(idx) as start_idx, arg_min(cidx, idx) as start_cidx, arg_min(c_us, idx) as start_us from met where still group by traj_id, end_cidx),
rs as (select ps.traj_id, ps.end_cidx, arg_min(met.idx, (abs(met.cidx - ps.end_cidx), met.cidx, met.idx)) as end_idx from ps join met on met.traj_id = ps.traj_id group by ps.traj_id, ps.end_cidx),
pauses as (select ps.traj_id, start_idx, end_idx, start_cidx, ps.end_cidx, round((fin.us - start_us) / 1e6, 6) as pause_s from ps join rs on rs.traj_id = ps.traj_id and rs.end_cidx = ps.end_cidx join fin on fin.traj_id = ps.traj_id and fin.cidx = ps.end_cidx),
removed as (select distinct traj_id, unnest(range(start_idx, end_idx)) as idx from pauses),
q as (select distinct traj_id, idx from met)"""


def _on_control(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    """Odometry rows with their nearest finite command (traj_id, idx, cidx), and the pauses that they meet."""
    c = commands(spark, d).where(finite(F.col("linear")) & finite(F.col("angular")))
    near = asof.nearest(odometry(spark, d), c, "traj_id", "idx", "cidx").select("traj_id", "idx", "cidx")
    return near, resample.pauses(near, c.withColumn("still", resample.paused(F.col("linear"), F.col("angular"))))


@ref("ref_w07_pauses", _PAUSE + " select * from pauses")
def w07(spark: SparkSession, d: str) -> DataFrame:
    """Pauses of the command rows of records, from the command of the first odometry row in them to the first moving one, and the odometry rows they cover."""
    r = _on_control(spark, d)[1]
    return r.select("traj_id", "start_idx", "end_idx", "start_cidx", "end_cidx", r6((F.col("end_us") - F.col("start_us")) / 1e6).alias("pause_s"))


@ref("ref_w08_without_pauses", _PAUSE + ", m as (select traj_id, idx, row_number() over (partition by traj_id order by idx) - 1 as new_idx, count(*) over (partition by traj_id) as c from q anti join removed using (traj_id, idx)) select traj_id, idx, new_idx from m where c >= 10")
def w08(spark: SparkSession, d: str) -> DataFrame:
    """Records without their pauses, renumbered; what is left of fewer than 10 rows is rejected."""
    near, pauses = _on_control(spark, d)
    return resample.renumbered(near.join(resample.removed(pauses), ["traj_id", "idx"], "left_anti")).select("traj_id", "idx", "new_idx")


@ref("ref_w08_legacy")
def w08_legacy(spark: SparkSession, d: str) -> DataFrame:
    """The same as the reference's scan does it, with its early end and its one-row gaps (an ordered pass over a record, no SQL)."""
    c = commands(spark, d).where(finite(F.col("linear")) & finite(F.col("angular")))
    near = asof.nearest(odometry(spark, d), c, "traj_id", "idx", "cidx").select("traj_id", "idx", "cidx")
    return resample.scanned(near, c.withColumn("still", resample.paused(F.col("linear"), F.col("angular"))))


@ref("ref_w09_stride", f"with {ODO} select traj_id, idx from (select traj_id, idx, row_number() over (partition by traj_id order by idx) - 1 as k from odo) where k % 2 = 0")
def w09(spark: SparkSession, d: str) -> DataFrame:
    return resample.every(odometry(spark, d), 2).select("traj_id", "idx")


_V2 = _STILL + f""", st as (select q.*, sqrt(pow(odo.x - lag(odo.x) over w, 2) + pow(odo.y - lag(odo.y) over w, 2)) as step from q join odo on odo.traj_id = q.traj_id and odo.idx = q.idx window w as (partition by q.traj_id order by q.idx)),
fac as (select greatest(1, cast(ceil(0.75 / avg(step) filter (straight and isfinite(step) and step > 0)) as bigint)) as k from st),
bb as (select traj_id, idx, straight and idx > min(idx) over (partition by traj_id) and idx < max(idx) over (partition by traj_id) as s from q),
cc as (select *, case when lag(s) over w = s then 0 else 1 end as ch from bb window w as (partition by traj_id order by idx)),
g as (select *, sum(ch) over (partition by traj_id order by idx) as seg from cc),
h as (select *, row_number() over (partition by traj_id, seg order by idx) - 1 as p from g)
select traj_id, idx from h, fac where p % (case when s then k else 4 end) = 0"""


@ref("ref_w10_segments", _V2)
def w10(spark: SparkSession, d: str) -> DataFrame:
    """Two-pass resampling: the dataset's mean straight spacing gives the stride on straights (A15, G10), 4 elsewhere."""
    q = cut(_with_commands(spark, d), "commands")
    o = odometry(spark, d).select("traj_id", "idx", "x", "y")
    s = resample.spacing(q.join(o, ["traj_id", "idx"]))
    mean = s.agg(F.avg(F.when(F.col("straight") & finite(F.col("step_m")) & (F.col("step_m") > 0), F.col("step_m"))).alias("m"))
    k = mean.select(F.greatest(F.lit(1), F.ceil(F.lit(0.75) / F.col("m"))).alias("k"))
    return resample.by_segment(q.withColumn("k", k.scalar()), F.col("k")).select("traj_id", "idx")


_HALF = _V2[: _V2.index("h as (select")].rstrip().rstrip(",")


@ref("ref_w06_segments", _HALF + " select traj_id, min(idx) as start_idx, max(idx) + 1 as end_idx, count(*) as n from g where s group by traj_id, seg")
def w06_segments(spark: SparkSession, d: str) -> DataFrame:
    """Straight runs of records, half open: row 0 is in none, and a run that reaches the last row leaves it to the tail."""
    return resample.straight_segments(_with_commands(spark, d)).select("traj_id", "start_idx", "end_idx", "n")


def _kernel_sql() -> str:
    vals = ", ".join(f"({k}, {w!r})" for k, w in zip(range(-6, 7), signal.gaussian_kernel(1.5), strict=True))
    return f"""with {FIX}, s as (select gps_id, ride_id, latitude, longitude, row_number() over (partition by ride_id order by us, gps_id) - 1 as i, count(*) over (partition by ride_id) as n from fix), k(o, w) as (values {vals}),
e as (select s.gps_id, s.ride_id, w, (((i + o) % (2 * n)) + 2 * n) % (2 * n) as j, n from s cross join k), f as (select gps_id, ride_id, w, case when j >= n then 2 * n - 1 - j else j end as j from e)
select f.gps_id, round(sum(w * s.latitude), 6) as latitude, round(sum(w * s.longitude), 6) as longitude from f join s on s.ride_id = f.ride_id and s.i = f.j group by f.gps_id"""


@ref("ref_w11_gaussian", _kernel_sql())
def w11(spark: SparkSession, d: str) -> DataFrame:
    s = signal.smooth(numbered(fixes(spark, d), order=("us", "gps_id")), ["latitude", "longitude"], 1.5)
    return s.select("gps_id", r6("latitude_smooth").alias("latitude"), r6("longitude_smooth").alias("longitude"))


# --- sorts, sets


@ref("ref_o01_numeric_sort", r"select rec_id, n, row_number() over (partition by ride_id, stream, leg order by n, rec_id) as rank from (select distinct rec_id, ride_id, stream, regexp_extract(uri, 'leg(\d+)', 1) as leg, cast(regexp_extract(uri, '(\d+)\.csv$', 1) as bigint) as n from recordings)")
def o01(spark: SparkSession, d: str) -> DataFrame:
    r = table(spark, d, "recordings").select("rec_id", "ride_id", "stream", F.regexp_extract("uri", r"leg(\d+)", 1).alias("leg"), files.file_number(F.col("uri")).alias("n")).distinct()
    return r.select("rec_id", "n", F.row_number().over(Window.partitionBy("ride_id", "stream", "leg").orderBy("n", "rec_id")).cast("long").alias("rank"))


@ref("ref_o03_head", f"with {CTL} select ride_id, control_id, rank from (select ride_id, control_id, row_number() over {_ORD} as rank from ctl) where rank <= 5")
def o03(spark: SparkSession, d: str) -> DataFrame:
    """The first five rows of every ride (a top-k report)."""
    return numbered(control(spark, d, ())).where("seq < 5").select("ride_id", "control_id", (F.col("seq") + 1).alias("rank"))


@ref("ref_o04_first_ten", f"with {CTL} select ride_id, control_id, us from ctl order by ride_id, us, control_id limit 10")
def o04(spark: SparkSession, d: str) -> DataFrame:
    """The first ten rows of all (a top-k report)."""
    return control(spark, d, ()).select("ride_id", "control_id", "us").orderBy("ride_id", "us", "control_id").limit(10)


@ref("ref_o05_top1", f"with {CLN} select ride_id, arg_max(control_id, (linear, -control_id)) as control_id from cln group by ride_id")
def o05(spark: SparkSession, d: str) -> DataFrame:
    return clean_control(spark, d).groupBy("ride_id").agg(F.max_by("control_id", F.struct("linear", -F.col("control_id"))).alias("control_id"))


@ref("ref_o07_every_third", f"with {FRM} select ride_id, frame_id from (select *, row_number() over (partition by ride_id order by us, frame_id) - 1 as i from frm) where i < 30 and i % 3 = 0")
def o07(spark: SparkSession, d: str) -> DataFrame:
    return numbered(frames(spark, d), "i", order=("us", "frame_id")).where("i < 30 and i % 3 = 0").select("ride_id", "frame_id")


@ref("ref_u02_removed_ranges", _PAUSE + " select traj_id, idx from removed semi join q using (traj_id, idx)")
def u02(spark: SparkSession, d: str) -> DataFrame:
    """Indices of the removed ranges, from their starts and ends (element lists of a range join)."""
    near, pauses = _on_control(spark, d)
    return resample.removed(pauses).join(near.select("traj_id", "idx"), ["traj_id", "idx"], "left_semi")


@ref("ref_u03_difference", "select ride_id from rides where ride_id in (select ride_id from gps_data) except select ride_id from front_camera_timestamps")
def u03(spark: SparkSession, d: str) -> DataFrame:
    one = lambda n: table(spark, d, n).select("ride_id").distinct()
    return one("rides").join(one("gps_data"), "ride_id", "left_semi").join(one("front_camera_timestamps"), "ride_id", "left_anti")


@ref("ref_u04_missing_and_duplicate", f"with {FRM} select distinct ride_id, frame_id, 'missing' as why from front_camera_timestamps where timestamp is null union all select ride_id, frame_id, 'duplicate' from (select *, row_number() over (partition by ride_id, us order by frame_id) as n from frm) where n > 1")
def u04(spark: SparkSession, d: str) -> DataFrame:
    """Masked frames, an index listed twice where it is both."""
    a = table(spark, d, "front_camera_timestamps").where("timestamp is null").select("ride_id", "frame_id").distinct().withColumn("why", F.lit("missing"))
    return a.unionByName(g16(spark, d).withColumn("why", F.lit("duplicate")))


# --- scalar functions


@ref("ref_m01_wheels", f"with {CLN} select control_id, round(((rpm_2 + rpm_4) * {_PER} + (rpm_1 + rpm_3) * {_PER}) / 2.0, 6) as v, round(((rpm_2 + rpm_4) * {_PER} - (rpm_1 + rpm_3) * {_PER}) / 0.306, 6) as omega from cln")
def m01(spark: SparkSession, d: str) -> DataFrame:
    v, w = wheel_speed(*(F.col(c) for c in WHEELS), RPM)
    return clean_control(spark, d).select("control_id", r6(v).alias("v"), r6(w).alias("omega"))


_UTM = geo.utm("latitude", "longitude", "zone")


@ref("ref_m02_utm", f"with {FIX}, z as (select *, {geo.zone('latitude', 'longitude')} as zone from fix) select gps_id, zone, round({_UTM[0]}, 3) as easting, round({_UTM[1]}, 3) as northing from z")
def m02(spark: SparkSession, d: str) -> DataFrame:
    z = fixes(spark, d).withColumn("zone", F.expr(geo.zone("latitude", "longitude")))
    return z.select("gps_id", "zone", F.round(F.expr(_UTM[0]), 3).alias("easting"), F.round(F.expr(_UTM[1]), 3).alias("northing"))


@ref("ref_m03_compass_yaw")
def m03(spark: SparkSession, d: str) -> DataFrame:
    """Heading and field of compass samples (JSON cells, no SQL)."""
    s = nested.sample_table(table(spark, d, "imu_data")).where("sensor = 'compass'")
    return s.select("imu_id", "sample_idx", r6(compass_yaw(F.col("y"), F.col("z"))).alias("yaw"), r6(gauss(F.col("x"))).alias("gauss_x"))


@ref("ref_m04_scalars", f"with {CLN} select control_id, round(sqrt(abs(rpm_1)), 6) as root, round(pow(linear, 2), 6) as square, round(atan2(angular, linear), 6) as angle, cast(ceil(rpm_2) as bigint) as up, cast(floor(rpm_3) as bigint) as down, cast(trunc(rpm_4) as bigint) as cut from cln")
def m04(spark: SparkSession, d: str) -> DataFrame:
    c = F.col
    return clean_control(spark, d).select("control_id", r6(F.sqrt(F.abs("rpm_1"))).alias("root"), r6(F.pow("linear", 2)).alias("square"), r6(F.atan2("angular", "linear")).alias("angle"), F.ceil("rpm_2").alias("up"), F.floor("rpm_3").alias("down"), c("rpm_4").cast("long").alias("cut"))


@ref("ref_t01_paths", r"select distinct uri, split_part(uri, '/', -1) as file, split_part(split_part(uri, '/', 1), '_', 2) as ride, 'ride_' || cast(ride_id as varchar) || '/' || stream as label from recordings")
def t01(spark: SparkSession, d: str) -> DataFrame:
    """Last path part, ride by underscore, interpolated labels."""
    r = table(spark, d, "recordings").select("uri", "ride_id", "stream").distinct()
    return r.select("uri", files.last_part(F.col("uri")).alias("file"), F.split_part(F.split_part("uri", F.lit("/"), F.lit(1)), F.lit("_"), F.lit(2)).alias("ride"), F.format_string("ride_%d/%s", "ride_id", "stream").alias("label"))


@ref("ref_t02_translate", "select imu_id, count(*) as n from (select imu_id, unnest(string_split(translate(compass, '[]\"', ''), ',')) as v from (select distinct imu_id, compass from imu_data where compass is not null)) group by imu_id")
def t02(spark: SparkSession, d: str) -> DataFrame:
    """Brackets and quotes stripped, numbers counted."""
    i = table(spark, d, "imu_data").where("compass is not null").select("imu_id", "compass").distinct()
    return i.select("imu_id", F.size(F.split(F.translate("compass", '[]"', ""), ",")).cast("long").alias("n"))


@ref("ref_t04_data_url", "select distinct rec_id, 'data:text/csv;base64,' || to_base64(encode(payload)) as url from recordings where payload is not null")
def t04(spark: SparkSession, d: str) -> DataFrame:
    r = table(spark, d, "recordings").where("payload is not null").select("rec_id", "payload").distinct()
    return r.select("rec_id", files.data_url(F.encode("payload", "UTF-8"), "text/csv").alias("url"))


@ref("ref_r01_arrays", "select traj_id, cast(len(timestamps) as bigint) as n, cast(len(list_filter(timestamps, lambda t: t is not null and isfinite(t))) as bigint) as n_ok, list_filter(timestamps, lambda t: t is not null and isfinite(t))[3] as third, cast(len(list_concat(linear, angular)) as bigint) as n_both from (select distinct on (traj_id) * from traj_data)")
def r01(spark: SparkSession, d: str) -> DataFrame:
    """Masks, slices, concatenation and lengths of arrays."""
    t = table(spark, d, "traj_data").select("traj_id", "timestamps", "linear", "angular").dropDuplicates(["traj_id"])
    ok = F.filter("timestamps", finite)
    return t.select("traj_id", F.size("timestamps").cast("long").alias("n"), F.size(ok).cast("long").alias("n_ok"), F.get(F.slice(ok, 1, 3), F.lit(2)).alias("third"), F.size(F.concat("linear", "angular")).cast("long").alias("n_both"))


@ref("ref_mp1_map", "select ride_id, count(distinct stream) as n_keys, bool_or(stream = 'rear') as has_rear from recordings group by ride_id")
def mp1(spark: SparkSession, d: str) -> DataFrame:
    """A map of stream to file count, its keys counted and tested."""
    n = table(spark, d, "recordings").groupBy("ride_id", "stream").agg(F.count(F.lit(1)).alias("n"))
    m = n.groupBy("ride_id").agg(F.map_from_entries(F.collect_list(F.struct("stream", "n"))).alias("m"))
    return m.select("ride_id", F.size(F.map_keys("m")).cast("long").alias("n_keys"), F.map_contains_key("m", "rear").alias("has_rear"))


# --- estimation and pipelines


def _filter_events(spark: SparkSession, d: str, robot: Robot = RPM, sigma: float = 0.0) -> DataFrame:
    """Wheel speeds (kind 1) and projected positions (kind 0) of every ride; with sigma positions are smoothed over that many fixes."""
    c = clean_control(spark, d)
    v, w = wheel_speed(*(F.col(x) for x in WHEELS), robot)
    c = c.select("ride_id", "us", F.lit(ekf.CONTROL).alias("kind"), F.col("control_id").alias("id"), v.alias("v"), w.alias("w"), F.lit(0.0).alias("x"), F.lit(0.0).alias("y"))
    g = fixes(spark, d).withColumn("zone", F.expr(geo.zone("latitude", "longitude")))
    g = g.select("ride_id", "us", "chunk", "gps_id", F.expr(_UTM[0]).alias("x"), F.expr(_UTM[1]).alias("y"))
    if sigma:
        g = signal.smooth(numbered(g, order=("us", "gps_id")), ["x", "y"], sigma).withColumns({"x": F.col("x_smooth"), "y": F.col("y_smooth")})
    g = g.select("ride_id", (F.col("us") + robot.gps_offset_us).alias("us"), F.lit(ekf.POSITION).alias("kind"), F.col("gps_id").alias("id"), F.lit(0.0).alias("v"), F.lit(0.0).alias("w"), "x", "y")
    return c.unionByName(g)


def _headed(track: DataFrame) -> DataFrame:
    """A filtered track with the direction of each step as yaw (the filter's heading at its first row)."""
    p = previous(chunked(track), ["x", "y"], order=("us", "idx"), settle=True)
    return p.withColumn("yaw", F.when(F.col("prev").isNull(), F.col("heading")).otherwise(F.atan2(F.col("y") - F.col("prev.y"), F.col("x") - F.col("prev.x")))).drop("prev", "heading")


@ref("ref_vgps_track")
def vgps(spark: SparkSession, d: str) -> DataFrame:
    """The converter by positions as one plan: smoothed positions six seconds back, filter, headings from steps, cutoff at the first frame, one row a time, nearest frame within 0.1 s, one row a frame."""
    t = _headed(ekf.filtered_track(_filter_events(spark, d, GPS, 1.5)))
    f = frames(spark, d)
    t0 = f.groupBy("ride_id").agg(F.min_by("us", "frame_id").alias("t0"))
    t = t.join(t0, "ride_id").where("us - t0 >= -100000")
    t = cut(t.groupBy("ride_id", "us").agg(F.min_by(F.struct("idx", "x", "y", "yaw"), "idx").alias("s")).select("ride_id", "us", "s.*"), "track")
    hit = asof.nearest(t, f, "ride_id", "idx", "frame_id", 100_000).select("ride_id", "idx", "frame_id", F.col("right_us").alias("frame_us"))
    rows = t.join(hit, ["ride_id", "idx"])
    first = F.min_by(F.struct("x", "y", "yaw"), "us").alias("s")
    return rows.groupBy("ride_id", "frame_id", "frame_us").agg(first).select("ride_id", "frame_id", *[F.round(f"s.{c}", 3).alias(c) for c in ("x", "y", "yaw")], "frame_us")


@ref("ref_v0_track")
def v0(spark: SparkSession, d: str) -> DataFrame:
    """The first converter as one plan: smoothed positions six seconds back, filter, headings from steps, nearest frame whatever the distance. Its optical flow is not built."""
    t = cut(_headed(ekf.filtered_track(_filter_events(spark, d, FIRST, 1.5))), "track")
    hit = asof.nearest(t, frames(spark, d), "ride_id", "idx", "frame_id").select("ride_id", "idx", "frame_id")
    return t.join(hit, ["ride_id", "idx"]).select("ride_id", "idx", "frame_id", *[F.round(c, 3).alias(c) for c in ("x", "y", "yaw")], "us")


@ref("ref_e01_filter")
def e01(spark: SparkSession, d: str) -> DataFrame:
    """Extended Kalman filter over wheels and positions of a whole ride (order-dependent, no SQL; tests hold it against hand-worked vectors)."""
    return ekf.filtered_track(_filter_events(spark, d))


@ref("ref_e01_legs")
def e01_legs(spark: SparkSession, d: str) -> DataFrame:
    """The same starting anew after every pause of ten minutes."""
    return ekf.filtered_track(ekf.legs(chunked(_filter_events(spark, d))), entity=("ride_id", "leg"))


def _on_frames(c: DataFrame, f: DataFrame, wheels: bool) -> DataFrame:
    """Readings of rides as a track at the frames: clock offset, cutoff at the first frame, one row a time, nearest frame within 0.1 s, integrated speeds, first row dropped, one row a frame."""
    c = c.withColumn("us", F.col("us") + RPM.control_offset_us)
    t0 = f.groupBy("ride_id").agg(F.min_by("us", "frame_id").alias("t0"))
    c = c.join(t0, "ride_id").where("us - t0 >= -100000").drop("t0")
    own = F.struct("control_id", "linear", "angular", *WHEELS)
    c = chunked(c.groupBy("ride_id", "us").agg(F.min_by(own, "control_id").alias("s")).select("ride_id", "us", "s.*"))
    hit = asof.nearest(c, f, "ride_id", "control_id", "frame_id", 100_000).select("control_id", "frame_id", "right_us")
    c = c.join(hit, "control_id")
    v, w = wheel_speed(*(F.col(x) for x in WHEELS), RPM) if wheels else command_speed(F.col("linear"), F.col("angular"), RPM)
    use = ["v", "w"] if wheels else ["prev.v", "prev.w"]
    p = previous(c.withColumn("v", v).withColumn("w", w), ["us", "v", "w"], settle=True)
    rows = p.select("ride_id", "chunk", "us", "control_id", "frame_id", "right_us", ((F.col("us") - F.col("prev.us")) / 1e6).alias("dt"), F.col(use[0]).alias("v"), F.col(use[1]).alias("w"), F.col("prev").isNotNull().alias("_later"))
    track = integrate(rows).where("_later")
    first = F.row_number().over(Window.partitionBy("ride_id", "frame_id").orderBy("us")) == 1
    return track.withColumn("_first", first).where("_first").select("ride_id", "control_id", "frame_id", F.round("x", 3).alias("x"), F.round("y", 3).alias("y"), F.round("theta", 3).alias("yaw"), F.col("right_us").alias("frame_us"))


@ref("ref_vrpm_track")
def vrpm(spark: SparkSession, d: str) -> DataFrame:
    """The newest converter as one plan, commands integrated. Its stages are held against SQL one by one; like the reference it finds a lag and does not apply it."""
    return _on_frames(clean_control(spark, d).drop("chunk"), frames(spark, d), wheels=False)


@ref("ref_vrpm_aligned")
def vrpm_aligned(spark: SparkSession, d: str) -> DataFrame:
    """The same with the lag of ref_e02 applied: wheel speeds, moved onto the commands they answer, are integrated."""
    return _on_frames(w15_aligned(spark, d), frames(spark, d), wheels=True)


# --- the rest of the inventory


@ref("ref_g03_counts", f"with {FRM}, {ODO}, f as (select ride_id, count(*) as n_frames from frm group by ride_id), o as (select ride_id, count(*) as n_odom from odo group by ride_id) select coalesce(f.ride_id, o.ride_id) as ride_id, coalesce(n_frames, 0) as n_frames, coalesce(n_odom, 0) as n_odom from f full join o on f.ride_id = o.ride_id")
def g03(spark: SparkSession, d: str) -> DataFrame:
    """Frames and odometry rows of every ride that has either."""
    f = frames(spark, d).groupBy("ride_id").agg(F.count(F.lit(1)).alias("n_frames"))
    o = odometry(spark, d).groupBy("ride_id").agg(F.count(F.lit(1)).alias("n_odom"))
    zero = lambda c: F.coalesce(c, F.lit(0).cast("long")).alias(c)
    return f.join(o, "ride_id", "full").select("ride_id", zero("n_frames"), zero("n_odom"))


@ref("ref_g10_straight_spacing", _V2[: _V2.index("fac as")].rstrip().rstrip(",") + " select round(avg(step) filter (straight and isfinite(step)), 6) as straight_step, round(avg(step) filter (isfinite(step)), 6) as step from st")
def g10(spark: SparkSession, d: str) -> DataFrame:
    """Mean spacing on straights and anywhere (a conditional mean)."""
    s = resample.spacing(_with_commands(spark, d).join(odometry(spark, d).select("traj_id", "idx", "x", "y"), ["traj_id", "idx"])).where(finite(F.col("step_m")))
    return s.agg(r6(F.avg(F.when(F.col("straight"), F.col("step_m")))).alias("straight_step"), r6(F.avg("step_m")).alias("step"))


@ref("ref_g11_mean_pause", "select count(*) as n, round(avg(pause_s), 6) as mean_s from (" + SQL["ref_w07_pauses"] + ")")
def g11(spark: SparkSession, d: str) -> DataFrame:
    return w07(spark, d).agg(F.count(F.lit(1)).alias("n"), r6(F.avg("pause_s")).alias("mean_s"))


@ref("ref_g11_running", "with p as (select traj_id, count(*) as n, sum(pause_s) as s from (" + SQL["ref_w07_pauses"] + ") group by traj_id) select traj_id, sum(n) over (order by traj_id)::bigint as n, round(sum(s) over (order by traj_id) / sum(n) over (order by traj_id), 6) as mean_s from p")
def g11_running(spark: SparkSession, d: str) -> DataFrame:
    """The mean of all pauses up to each record, by traj_id (a running mean over the whole dataset, in blocks of records)."""
    p = w07(spark, d).groupBy("traj_id").agg(F.count(F.lit(1)).alias("_n"), F.sum("pause_s").alias("_s")).withColumns({"one": F.lit(1), "chunk": F.floor(F.col("traj_id") / F.lit(4_096))})
    r = running(p, {"n": F.col("_n"), "s": F.col("_s")}, ("one",), ("traj_id",))
    return r.select("traj_id", "n", r6(F.col("s") / F.col("n")).alias("mean_s"))


@ref("ref_g17_rejects", "select reason, count(*) as n from (" + SQL["ref_k10_rejected"] + ") group by reason")
def g17(spark: SparkSession, d: str) -> DataFrame:
    return k10(spark, d).groupBy("reason").agg(F.count(F.lit(1)).alias("n"))


@ref("ref_f05_tolerance", "select count(*) as n, max(distance_us) as farthest from (" + SQL["ref_a01_nearest_frame"] + ")")
def f05(spark: SparkSession, d: str) -> DataFrame:
    """What the tolerance of 0.1 s leaves, its edge included."""
    return a01(spark, d).agg(F.count(F.lit(1)).alias("n"), F.max("distance_us").alias("farthest"))


@ref("ref_f08_unmasked", f"with {FRM}, m as (select ride_id, frame_id from (select *, row_number() over (partition by ride_id, us order by frame_id) as n from frm) where n > 1) select ride_id, frame_id from frm anti join m using (ride_id, frame_id)")
def f08(spark: SparkSession, d: str) -> DataFrame:
    """Frames without the masked duplicates (anti join)."""
    return frames(spark, d).select("ride_id", "frame_id").join(g16(spark, d), ["ride_id", "frame_id"], "left_anti")


@ref("ref_f12_convertible", f"select ride_id, count(*) as n, count(*) filter (latitude between -80 and 84 and longitude between -180 and 180) as n_ok from (select distinct gps_id, ride_id, latitude, longitude from gps_data) group by ride_id")
def f12(spark: SparkSession, d: str) -> DataFrame:
    """Fixes of every ride and how many of them can be projected."""
    g = table(spark, d, "gps_data").select("gps_id", "ride_id", "latitude", "longitude").dropDuplicates(["gps_id"])
    return g.groupBy("ride_id").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("latitude").between(-80, 84) & F.col("longitude").between(-180, 180)).alias("n_ok"))


@ref("ref_a11_kept", _PAUSE + " select traj_id, idx from q anti join removed using (traj_id, idx)")
def a11(spark: SparkSession, d: str) -> DataFrame:
    """Rows whose index is not among the removed ones (anti join)."""
    near, pauses = _on_control(spark, d)
    return near.select("traj_id", "idx").join(resample.removed(pauses), ["traj_id", "idx"], "left_anti")


@ref("ref_a15_against_mean", f"with {_GOOD}, a as (select avg(step) as m from s), r as (select traj_id, avg(step) as step from s group by traj_id) select traj_id, round(step / m, 4) as ratio from r, a where step is not null")
def a15(spark: SparkSession, d: str) -> DataFrame:
    """Each record's mean spacing against the dataset's (a scalar for every row)."""
    s = _good(spark, d)
    mean = s.agg(F.avg("step_m").alias("m"))
    r = s.groupBy("traj_id").agg(F.avg("step_m").alias("step")).where("step is not null")
    return r.withColumn("m", mean.scalar()).select("traj_id", F.round(F.col("step") / F.col("m"), 4).alias("ratio"))


@ref("ref_u01_concatenate", _STILL + " select 'straight' as part, traj_id, idx from q where straight union all select 'rest', traj_id, idx from q where not straight")
def u01(spark: SparkSession, d: str) -> DataFrame:
    """Segments of both classes in one table; one pass with a label instead of a union of two."""
    return _with_commands(spark, d).select(F.when(F.col("straight"), "straight").otherwise("rest").alias("part"), "traj_id", "idx")


@ref("ref_w13_prefix", f"with {_GOOD} select traj_id, idx, round(sum(step) over (partition by traj_id order by idx rows between unbounded preceding and current row), 4) as length from s where step is not null")
def w13(spark: SparkSession, d: str) -> DataFrame:
    """Length of the path up to each row (a running frame)."""
    w = resample.by_record().rowsBetween(Window.unboundedPreceding, 0)
    return _good(spark, d).where("step_m is not null").select("traj_id", "idx", F.round(F.sum("step_m").over(w), 4).alias("length"))


@ref("ref_d01_clock", f"with {CTL} select control_id, us // 1000000 as second, us % 1000000 as micro from ctl")
def d01(spark: SparkSession, d: str) -> DataFrame:
    return control(spark, d, ()).select("control_id", F.floor(F.col("us") / F.lit(1_000_000)).alias("second"), (F.col("us") % 1_000_000).alias("micro"))
