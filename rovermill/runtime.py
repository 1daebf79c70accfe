"""Session-level helpers: the shared folder, lineage cuts and table access."""

from __future__ import annotations

import atexit
import os
import shutil
import sys
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def shared_root(spark: SparkSession) -> str:
    """The folder spark.checkpoint.dir names, read from the session. Only a local session without it gets a temporary folder of this machine; a cluster must name one."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir is not set: intermediate tables need a folder that every executor can reach")
        own = tempfile.mkdtemp(prefix="rovermill-")
        atexit.register(shutil.rmtree, own, ignore_errors=True)
        root = "file://" + own
        spark.conf.set("spark.checkpoint.dir", root)
    return root.rstrip("/")


def file_system(spark: SparkSession, path: str):  # noqa: ANN201
    """The file system of a path and the path, both of the JVM."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def shared_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder in this application's own folder under shared_root; that folder is removed when the application ends."""
    home = f"{shared_root(spark)}/rovermill-{spark.sparkContext.applicationId}"
    fs, p = file_system(spark, home)
    if not fs.exists(p):
        fs.mkdirs(p)
        fs.deleteOnExit(p)
    return f"{home}/{name}-{uuid.uuid4().hex}"


def output_dir(spark: SparkSession, path: str, overwrite: bool = False) -> str:
    """An output folder by the converters' policy: with overwrite what is there is removed first, without it is kept and added to."""
    fs, p = file_system(spark, path)
    if overwrite and fs.exists(p):
        fs.delete(p, True)
    fs.mkdirs(p)
    return path.rstrip("/")


def cut(df: DataFrame, name: str = "cut") -> DataFrame:
    """The frame written to the shared folder and read again: cuts the lineage and survives lost executors."""
    spark = df.sparkSession
    path = shared_dir(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One table of a data folder, a Parquet file or a folder of them."""
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def process_cache() -> dict:
    """Objects kept for the life of a Python process. Functions that travel by value bring their module's globals along, so a worker's caches stay outside of them."""
    return sys.__dict__.setdefault("_rovermill_cache", {})


def spread(df: DataFrame, *by: str) -> DataFrame:
    """Rows of an input of fewer splits than the cluster has cores, hashed by columns over four tasks a core; others are left as they are.

    For work that costs far more than moving its rows. by should tell rows apart. Rows that come out of a shuffle are spread already.
    """
    slots = df.sparkSession.sparkContext.defaultParallelism
    plan = df._jdf.queryExecution()
    if "Exchange" in plan.executedPlan().toString() or plan.toRdd().getNumPartitions() >= 2 * slots:
        return df
    return df.repartition(4 * slots, F.xxhash64(*by))
