"""Typed, de-duplicated views of the ride tables, with whole microseconds as time."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rovermill.functions.timeline import finite, micros
from rovermill.operators.sequences import chunked
from rovermill.runtime import table

COMMANDS = ("linear", "angular")
WHEELS = ("rpm_1", "rpm_2", "rpm_3", "rpm_4")


def control(spark: SparkSession, sf_dir: str, cols: tuple[str, ...] = COMMANDS + WHEELS) -> DataFrame:
    """control_id, ride_id, cols, us, chunk; each control_id once. Repeats hold the same ride and time, so they meet in one (ride, chunk) partition, which later windows reuse."""
    df = table(spark, sf_dir, "control_data").select("control_id", "ride_id", *cols, micros(F.col("timestamp")).alias("us")).where("us is not null and ride_id is not null and control_id is not null")
    return chunked(df).repartition("ride_id", "chunk").dropDuplicates(["ride_id", "chunk", "control_id"])


def clean_control(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of control whose six readings are all finite."""
    df = control(spark, sf_dir)
    for c in COMMANDS + WHEELS:
        df = df.where(finite(F.col(c)))
    return df


def frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ride_id, frame_id, us, chunk of the front camera, each frame once; frames without time left out."""
    df = table(spark, sf_dir, "front_camera_timestamps").select("ride_id", "frame_id", micros(F.col("timestamp")).alias("us")).where("us is not null")
    return chunked(df).repartition("ride_id", "chunk").dropDuplicates(["ride_id", "chunk", "frame_id"])


def fixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """gps_id, ride_id, latitude, longitude, us, chunk of the fixes inside the range of UTM, each once."""
    df = table(spark, sf_dir, "gps_data").select("gps_id", "ride_id", "latitude", "longitude", micros(F.col("timestamp")).alias("us"))
    df = df.where("us is not null and latitude between -80 and 84 and longitude between -180 and 180")
    return chunked(df).repartition("ride_id", "chunk").dropDuplicates(["ride_id", "chunk", "gps_id"])


def odometry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """traj_id, ride_id, idx, x, y, yaw, us of the trajectory records, a row per element; each record once, elements without time left out."""
    one = table(spark, sf_dir, "traj_data").where("traj_id is not null").select("traj_id", "ride_id", "timestamps", "position", "yaw").dropDuplicates(["traj_id"])
    rows = one.select("traj_id", "ride_id", F.posexplode(F.arrays_zip("timestamps", "position", "yaw")).alias("idx", "e"))
    rows = rows.select("traj_id", "ride_id", F.col("idx").cast("long").alias("idx"), F.col("e.position.x").alias("x"), F.col("e.position.y").alias("y"), F.col("e.yaw").alias("yaw"), micros(F.col("e.timestamps")).alias("us"))
    return rows.where("us is not null")


def commands(spark: SparkSession, sf_dir: str) -> DataFrame:
    """traj_id, cidx, linear, angular, us of the commands stored with the trajectory records."""
    one = table(spark, sf_dir, "traj_data").where("traj_id is not null").select("traj_id", "control_timestamps", "linear", "angular").dropDuplicates(["traj_id"])
    rows = one.select("traj_id", F.posexplode(F.arrays_zip("control_timestamps", "linear", "angular")).alias("cidx", "e"))
    rows = rows.select("traj_id", F.col("cidx").cast("long").alias("cidx"), F.col("e.linear").alias("linear"), F.col("e.angular").alias("angular"), micros(F.col("e.control_timestamps")).alias("us"))
    return rows.where("us is not null")
