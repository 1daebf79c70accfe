"""Ride folders as DataFrames. Schemas are declared, never inferred; the ride is taken from the path."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# The columns of the logged streams.
SCHEMAS = {
    "control_data": "linear double, angular double, rpm_1 double, rpm_2 double, rpm_3 double, rpm_4 double, timestamp double",
    "gps_data": "latitude double, longitude double, timestamp double",
    "imu_data": "compass string, accelerometer string, gyroscope string",
    "front_camera_timestamps": "frame_id long, timestamp double",
    "rear_camera_timestamps": "frame_id long, timestamp double",
    "mic_audio_timestamps": "frame_id long, timestamp double",
    "speaker_audio_timestamps": "frame_id long, timestamp double",
}
RIDE = r"ride_(\d+)_(\d{14})"


def ride_id(path: Column) -> Column:
    """The number in a path's ride_<id>_<yyyymmddHHMMSS> part; null where there is none."""
    return F.regexp_extract(path, RIDE, 1).try_cast("long")


def ride_key(path: Column) -> Column:
    """The whole ride_<id>_<time> part of a path; empty where there is none."""
    return F.regexp_extract(path, RIDE, 0)


def last_part(path: Column) -> Column:
    """What follows the last slash of a path or address."""
    return F.substring_index(path, "/", -1)


def read_stream(spark: SparkSession, root: str, stream: str) -> DataFrame:
    """One CSV stream of all rides under root/*/ride_*/: ride_id, path and the stream's columns; malformed values become null."""
    df = spark.read.schema(SCHEMAS[stream]).option("header", True).option("mode", "PERMISSIVE").option("recursiveFileLookup", True).option("pathGlobFilter", f"{stream}*.csv").csv(root)
    path = F.col("_metadata.file_path")
    return df.select(ride_id(path).alias("ride_id"), path.alias("path"), *df.columns)


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    """url, file of a download manifest. Fetching is left to the caller."""
    return spark.read.schema("url string").option("header", True).csv(path).where("url is not null").withColumn("file", last_part(F.col("url")))


def read_binary(spark: SparkSession, root: str, pattern: str) -> DataFrame:
    """path, ride_id, length and content of binary files (frames, segments); content is read only if it is selected."""
    df = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", pattern).load(root)
    return df.select("path", ride_id(F.col("path")).alias("ride_id"), "length", "content")


def playlist_segments(playlists: DataFrame) -> DataFrame:
    """path, segment_idx, uri of the segments of HLS playlists (path, content): the lines that are neither blank nor begin with '#', in order."""
    lines = F.filter(F.transform(F.split("content", r"\r\n|\r|\n"), F.trim), lambda x: (x != "") & ~x.startswith("#"))
    return playlists.select("path", F.posexplode(lines).alias("segment_idx", "uri"))


def file_number(name: Column) -> Column:
    """The number at the end of a file's base name, for sorting 2.jpg before 10.jpg."""
    return F.regexp_extract(name, r"(\d+)(?:\.[A-Za-z0-9]+)?$", 1).try_cast("long")


def data_url(content: Column, mime: str = "image/jpeg") -> Column:
    return F.concat(F.lit(f"data:{mime};base64,"), F.translate(F.base64(content), "\r\n", ""))


def write_numbered(df: DataFrame, path: str, suffix: str = "jpg") -> DataFrame:
    """Writes each row's content to <path>/<folder>/<n>.<suffix> on the executors; folder, n, file, n_bytes of what was written.

    df: folder, n, content (binary). A file that a lost task began is written anew under the same name; rows with a null are left out.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        store, root = fs.FileSystem.from_uri(path if "://" in path else "file://" + path.removeprefix("file:"))
        made: set[str] = set()
        for b in batches:
            names, sizes = [], []
            folders, numbers = b.column(0).to_pylist(), b.column(1).to_pylist()
            for folder, n, content in zip(folders, numbers, b.column(2).to_pylist(), strict=True):
                if folder not in made:
                    store.create_dir(f"{root}/{folder}", recursive=True)
                    made.add(folder)
                names.append(f"{folder}/{n}.{suffix}")
                with store.open_output_stream(f"{root}/{names[-1]}") as f:
                    f.write(content)
                sizes.append(len(content))
            yield pa.RecordBatch.from_pydict({"folder": folders, "n": numbers, "file": names, "n_bytes": sizes}, schema=pa.schema([("folder", pa.string()), ("n", pa.int64()), ("file", pa.string()), ("n_bytes", pa.int64())]))

    rows = df.select("folder", "n", "content").where("folder is not null and n is not null and content is not null")
    return rows.mapInArrow(run, "folder string, n long, file string, n_bytes long")
