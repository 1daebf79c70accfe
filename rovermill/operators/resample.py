"""Pauses, straight runs and strides on trajectory records (a record is bounded: one file of one leg)."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from rovermill.operators import asof
from rovermill.operators.chunks import map_groups


def by_record() -> WindowSpec:
    return Window.partitionBy("traj_id").orderBy("idx")


def spacing(odom: DataFrame) -> DataFrame:
    """Adds step_m and step_us, distance and time to the record's row before (null at its first)."""
    d = lambda c: F.col(c) - F.lag(c).over(by_record())
    return odom.withColumn("step_m", F.sqrt(F.pow(d("x"), 2) + F.pow(d("y"), 2))).withColumn("step_us", d("us"))


def paused(linear: Column, angular: Column, least: float = 0.05) -> Column:
    return (F.abs(linear) < least) & (F.abs(angular) < least)


def straight(linear: Column, angular: Column, least: float = 0.1, turn: float = 0.05, abs_angular: bool = False) -> Column:
    """Whether a command drives straight on. By default the turn is tested with its sign, so right turns count as straight; abs_angular tests its size."""
    return (F.abs(linear) > least) & ((F.abs(angular) if abs_angular else angular) < turn)


def runs_of(df: DataFrame, flag: str) -> DataFrame:
    """traj_id, run, start_idx, end_idx, start_us, end_us, n of the maximal runs of rows whose flag is true; end is the first row after the run, or the record's last one."""
    change = F.when(F.lag(flag).over(by_record()) == F.col(flag), 0).otherwise(1)
    last = Window.partitionBy("traj_id")
    nxt = F.struct(F.lead("idx").over(by_record()).alias("i"), F.lead("us").over(by_record()).alias("u"))
    d = df.withColumn("_next", nxt).withColumn("run", F.sum(change).over(by_record())).withColumn("_end", F.max(F.struct("idx", "us")).over(last))
    g = d.where(F.col(flag)).groupBy("traj_id", "run").agg(F.min(F.struct("idx", "us")).alias("a"), F.max_by("_next", "idx").alias("b"), F.max("_end").alias("e"), F.count(F.lit(1)).alias("n"))
    return g.select("traj_id", "run", F.col("a.idx").alias("start_idx"), F.coalesce("b.i", "e.idx").alias("end_idx"), F.col("a.us").alias("start_us"), F.coalesce("b.u", "e.us").alias("end_us"), "n")


def with_ends(control: DataFrame) -> DataFrame:
    """Adds end, (cidx, us) of the first moving row after each control row, or of the record's last one. control: traj_id, cidx, us, still."""
    # from the last row back: a frame that ends at the last row is summed up anew for every row
    w = Window.partitionBy("traj_id").orderBy(F.col("cidx").desc())
    at = F.struct("cidx", "us")
    moving = F.min(F.when(~F.col("still"), at)).over(w.rowsBetween(Window.unboundedPreceding, -1))
    return control.withColumn("end", F.coalesce(moving, F.max(at).over(Window.partitionBy("traj_id"))))


def pauses(near: DataFrame, control: DataFrame) -> DataFrame:
    """The runs of still control rows that odometry rows fall into: traj_id, start_idx, end_idx, start_cidx, end_cidx, start_us, end_us.

    near: traj_id, idx, cidx of the control row nearest to each odometry row. A pause begins at the first odometry row in it and its
    control row, and ends at the first moving control row; there the odometry row whose control row is nearest (of equal ones the earlier) goes on.
    """
    met = near.join(with_ends(control).select("traj_id", "cidx", "still", "us", "end"), ["traj_id", "cidx"])
    first = F.min(F.struct("idx", "cidx", "us"))
    p = met.where("still").groupBy("traj_id", "end").agg(first.alias("a")).select("traj_id", F.col("end.cidx").alias("end_cidx"), F.col("end.us").alias("end_us"), F.col("a.idx").alias("start_idx"), F.col("a.cidx").alias("start_cidx"), F.col("a.us").alias("start_us"))
    resume = asof.nearest(p.select("traj_id", F.col("end_cidx").alias("us"), "end_cidx"), near.select("traj_id", F.col("cidx").alias("us"), "idx"), "traj_id", "end_cidx", "idx", span_us=4_096)
    return p.join(resume.select("traj_id", "end_cidx", F.col("idx").alias("end_idx")), ["traj_id", "end_cidx"])


def removed(pauses_: DataFrame) -> DataFrame:
    """traj_id, idx of the odometry rows that pauses take out: from the first in a pause to the one that goes on."""
    r = pauses_.where("end_idx > start_idx")
    return r.select("traj_id", F.explode(F.sequence("start_idx", F.col("end_idx") - 1)).alias("idx")).distinct()


def scanned(near: DataFrame, control: DataFrame) -> DataFrame:
    """traj_id, new_idx, idx, image_idx of what one scan over each record keeps, with its quirks: new row new_idx holds the data of row idx and the image of row image_idx (null where the other list is longer).

    The row a pause ends at is not tested again; the scan ends early where a pause ends at the row the one before ended at; a
    stretch of one row between pauses keeps the row its pause began at. Times out of order can lead a pause to a row that an earlier one
    ended at: from there the scan would go round for ever, so it ends early there too. near and control as in pauses.
    """
    met = near.join(with_ends(control).select("traj_id", "cidx", "still", F.col("end.cidx").alias("end")), ["traj_id", "cidx"])

    def fn(key: dict, a: dict) -> dict:
        c, n = a["cidx"], len(a["cidx"])
        data: list[np.ndarray] = []
        gone = np.zeros(n, bool)
        ended: set[int] = set()
        at = resumed = 0
        while at < n:
            if a["still"][at]:
                to = int(np.argmin(np.abs(c - a["end"][at])))
                if to == resumed or to in ended:
                    break
                ended.add(to)
                gone[at:to] = True
                one = resumed and at - resumed == 1
                data.append(np.arange(at, at + 1) if one else np.arange(resumed, at))
                at = resumed = to
            at += 1
        data.append(np.arange(resumed, n))
        rows, images = np.concatenate(data), np.flatnonzero(~gone)
        size = max(len(rows), len(images))
        pad = lambda v: np.array([*a["idx"][v].tolist(), *[None] * (size - len(v))], object)
        return {"traj_id": np.full(size, key["traj_id"]), "new_idx": np.arange(size), "idx": pad(rows), "image_idx": pad(images)}

    return map_groups(met, ["traj_id"], ["idx"], fn, "traj_id long, new_idx long, idx long, image_idx long")


def renumbered(odom: DataFrame, min_rows: int = 10) -> DataFrame:
    """What is left of records (traj_id, idx, ...), renumbered densely as new_idx. Records of fewer than min_rows rows left are rejected."""
    w = Window.partitionBy("traj_id")
    keep = odom.withColumn("new_idx", (F.row_number().over(by_record()) - 1).cast("long")).withColumn("_n", F.count(F.lit(1)).over(w))
    return keep.where(F.col("_n") >= min_rows).drop("_n")


def every(df: DataFrame, stride: int) -> DataFrame:
    """Each stride-th row of every record, from its first."""
    return df.withColumn("_k", F.row_number().over(by_record()) - 1).where(F.col("_k") % stride == 0).drop("_k")


def bounded_straight() -> Column:
    """The flag straight without a record's first and last row: the first is never straight, and a straight run that reaches the end leaves the last to the tail."""
    w = Window.partitionBy("traj_id")
    return F.col("straight") & (F.col("idx") > F.min("idx").over(w)) & (F.col("idx") < F.max("idx").over(w))


def straight_segments(df: DataFrame) -> DataFrame:
    """traj_id, start_idx, end_idx (exclusive), n of the maximal straight runs of records."""
    d = df.withColumn("_s", bounded_straight())
    change = F.when(F.lag("_s").over(by_record()) == F.col("_s"), 0).otherwise(1)
    g = d.withColumn("segment", F.sum(change).over(by_record())).where("_s").groupBy("traj_id", "segment")
    return g.agg(F.min("idx").alias("start_idx"), (F.max("idx") + 1).alias("end_idx"), F.count(F.lit(1)).alias("n")).drop("segment")


def by_segment(df: DataFrame, straight_stride: Column | int, turn_stride: int = 4) -> DataFrame:
    """Strided rows, the stride starting anew in every segment of equal `straight`; row 0 is never straight, and a straight run that reaches the end leaves the last row to the tail."""
    d = df.withColumn("_s", bounded_straight())
    change = F.when(F.lag("_s").over(by_record()) == F.col("_s"), 0).otherwise(1)
    d = d.withColumn("segment", F.sum(change).over(by_record()))
    k = F.row_number().over(Window.partitionBy("traj_id", "segment").orderBy("idx")) - 1
    stride = F.when(F.col("_s"), straight_stride if isinstance(straight_stride, Column) else F.lit(straight_stride)).otherwise(F.lit(turn_stride))
    return d.withColumn("_k", k).where(F.pmod(F.col("_k"), stride) == 0).drop("_s", "_k")
