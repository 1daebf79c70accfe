"""Queries of the llm operators, and their SQL where SQL can say the same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rovermill.llm.encoding import encode_corpus, token_counts
from rovermill.llm.event_runs import anchored_runs, equal_runs
from rovermill.llm.nearest_stream import replay_matches
from rovermill.llm.packing import pack
from rovermill.llm.sentences import sentences
from rovermill.runtime import table

Query = Callable[[SparkSession, str], DataFrame]


def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return replay_matches(spark, f"{sf_dir}/traj_data.parquet", f"{sf_dir}/front_camera_timestamps.parquet").select("traj_id", "odom_idx", "side", "match_id")


def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return anchored_runs(table(spark, sf_dir, "control_data")).select("first_id", "last_id")


def p3_equal_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return equal_runs(table(spark, sf_dir, "control_data"))


def p8_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_corpus(table(spark, sf_dir, "documents"))


def p9_containers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(token_counts(table(spark, sf_dir, "documents")))


def p10_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sentences(table(spark, sf_dir, "documents"), with_text=False).select("doc_id", "sent_start", "sent_end")


def p10_sentences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sentences(table(spark, sf_dir, "documents")).select("doc_id", "sent_idx", F.col("sentence"))


def queries() -> dict[str, Query]:
    return {"p2_found": p2_found, "p3_found": p3_found, "p3_equal_runs": p3_equal_runs, "p8_ids": p8_ids, "p9_containers": p9_containers, "p10_found": p10_found, "p10_sentences": p10_sentences}


_US = "cast(floor((case when abs({c}) >= 1e11 then {c} / 1000 else {c} end) * 1e6 + 0.5) as bigint)"
_OK = "{c} is not null and not isnan({c}) and not isinf({c})"


def oracle_sql() -> dict[str, str]:
    us, ok = (lambda c: _US.format(c=c)), (lambda c: _OK.format(c=c))
    return {
        "p2_found": f"""
with t as (select distinct on (traj_id) * from traj_data where traj_id is not null),
o as (select traj_id, ride_id, generate_subscripts(timestamps, 1) - 1 as odom_idx, unnest(timestamps) as ts from t),
l as (select traj_id, ride_id, cast(odom_idx as bigint) as odom_idx, {us("ts")} as us from o where {ok("ts")}),
d as (select traj_id, generate_subscripts(control_timestamps, 1) - 1 as id, unnest(control_timestamps) as ts from t),
c as (select traj_id, cast(id as bigint) as id, {us("ts")} as us from d where {ok("ts")}),
f as (select distinct ride_id, frame_id as id, {us("timestamp")} as us from front_camera_timestamps where {ok("timestamp")}),
m as (select l.traj_id, odom_idx, 'control' as side, c.id, abs(c.us - l.us) as dist, c.us from l join c on l.traj_id = c.traj_id and c.us between l.us - 100000 and l.us + 100000
union all select l.traj_id, odom_idx, 'camera', f.id, abs(f.us - l.us), f.us from l join f on l.ride_id = f.ride_id and f.us between l.us - 100000 and l.us + 100000)
select traj_id, odom_idx, side, id as match_id from (select *, row_number() over (partition by traj_id, odom_idx, side order by dist, us, id) as rn from m) where rn = 1""",
        "p3_equal_runs": f"""
with r as (select distinct control_id, ride_id, {us("timestamp")} as us, cast(sign(linear) * floor(abs(linear) * 1000 + 0.5) as bigint) as lin, cast(sign(angular) * floor(abs(angular) * 1000 + 0.5) as bigint) as ang
from control_data where {ok("linear")} and {ok("angular")} and {ok("timestamp")} and ride_id is not null and control_id is not null),
n as (select *, row_number() over (partition by ride_id order by us, control_id) - row_number() over (partition by ride_id, lin, ang order by us, control_id) as island from r)
select ride_id, arg_min(control_id, (us, control_id)) as first_id, arg_max(control_id, (us, control_id)) as last_id, count(*) as n, round((max(us) - min(us)) / 1e6, 6) as duration_s
from n group by ride_id, lin, ang, island""",
    }
