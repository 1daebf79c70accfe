"""Shared folders, output policy, numbered files, the command line and the entry without the subpackage."""

from __future__ import annotations

import builtins
import os
import sys

import pytest
from pyspark.sql import functions as F

from rovermill import runtime
from rovermill.sources import files


def local(path):
    return path.removeprefix("file://").removeprefix("file:")


def test_shared_folders_lie_in_the_application_s_own(spark):
    a, b = runtime.shared_dir(spark, "x"), runtime.shared_dir(spark, "x")
    assert a != b and os.path.dirname(a) == os.path.dirname(b) and spark.sparkContext.applicationId in a
    assert a.startswith(spark.sparkContext.getConf().get("spark.checkpoint.dir"))


def test_a_cluster_must_name_its_shared_folder():
    class Conf:
        def get(self, *_):
            return None

    class Context:
        master = "spark://host:7077"

        def getConf(self):
            return Conf()

    class Session:
        conf, sparkContext = Conf(), Context()

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        runtime.shared_root(Session())


def test_output_policy(spark, tmp_path):
    path = f"file://{tmp_path}/out"
    runtime.output_dir(spark, path)
    (tmp_path / "out" / "old").write_text("x")
    runtime.output_dir(spark, path)
    assert (tmp_path / "out" / "old").exists()
    runtime.output_dir(spark, path, overwrite=True)
    assert os.listdir(tmp_path / "out") == []


def test_few_splits_are_spread_and_rows_kept(spark):
    df = spark.range(0, 100, 1, 1).withColumn("t", F.lit("x"))
    out = runtime.spread(df, "id", "t")
    assert out.rdd.getNumPartitions() == 4 * spark.sparkContext.defaultParallelism and out.exceptAll(df).count() == 0 and out.count() == 100
    many = spark.range(0, 100, 1, 64)
    assert runtime.spread(many, "id") is many


def test_numbered_files(spark, tmp_path):
    rows = [("a", 0, b"one"), ("a", 1, b""), ("b/c", 7, b"three"), (None, 1, b"x"), ("a", None, b"x"), ("a", 2, None)]
    out = files.write_numbered(spark.createDataFrame(rows, "folder string, n long, content binary"), f"file://{tmp_path}", "jpg")
    assert sorted((r.file, r.n_bytes) for r in out.collect()) == [("a/0.jpg", 3), ("a/1.jpg", 0), ("b/c/7.jpg", 5)]
    assert (tmp_path / "b" / "c" / "7.jpg").read_bytes() == b"three" and not (tmp_path / "a" / "2.jpg").exists()


def test_command_line(spark, tmp_path):
    import run

    args = ["ref_s05_first_file", "--input_path", "/root/testdata/sf0.001", "--output_path", f"file://{tmp_path}"]
    run.main(args)
    n = spark.read.parquet(f"file://{tmp_path}/ref_s05_first_file").count()
    run.main([*args, "--overwrite"])
    assert n > 0 and spark.read.parquet(f"file://{tmp_path}/ref_s05_first_file").count() == n
    with pytest.raises(SystemExit):
        run.main(["no_such_query", *args[1:]])


def test_entry_without_what_the_subpackage_needs(monkeypatch):
    """A missing library takes the subpackage's queries away, never the core's."""
    import __spark_entry__ as e

    real = builtins.__import__

    def without(name, *args, **kwargs):
        if name.startswith("rovermill.llm"):
            raise ImportError(name)
        return real(name, *args, **kwargs)

    for m in [m for m in sys.modules if m.startswith("rovermill.llm")]:
        monkeypatch.delitem(sys.modules, m)
    monkeypatch.setattr(builtins, "__import__", without)
    names = set(e.queries())
    assert "p1_found" in names and "p8_ids" not in names and set(e.oracle_sql()) <= names
