"""Motion between frames: pairs of successive frames, mean flow of a pair, flow at control times.

How points moved from one frame to the next is measured outside (it needs images and OpenCV); here begins what follows from it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rovermill.operators import asof
from rovermill.operators.sequences import previous


def frame_pairs(frames: DataFrame) -> DataFrame:
    """ride_id, frame_id, prev_frame_id, us, step_us of every frame with the one before it; a ride's first frame has none. frames: ride_id, chunk, us, frame_id."""
    p = previous(frames.select("ride_id", "chunk", "us", "frame_id"), ["frame_id"], order=("us", "frame_id")).where("prev is not null")
    return p.select("ride_id", "frame_id", F.col("prev.frame_id").alias("prev_frame_id"), "us", (F.col("us") - F.col("prev.us")).alias("step_us"))


def mean_flow(points: DataFrame) -> DataFrame:
    """ride_id, frame_id, us, dx, dy: the mean way of the points tracked into each frame, (0, 0) where none was.

    points: ride_id, frame_id, us, dx, dy, a row for each point; dx and dy are null where it was lost, in a row of its own where a frame has no point.
    """
    zero = F.lit(0.0)
    return points.groupBy("ride_id", "frame_id", "us").agg(*[F.coalesce(F.avg(F.when(F.col("dx").isNotNull() & F.col("dy").isNotNull(), F.col(c))), zero).alias(c) for c in ("dx", "dy")])


def flow_at_controls(flow: DataFrame, control: DataFrame) -> DataFrame:
    """ride_id, control_id, us, dx, dy: the flow of the first frame at or after each control row; rows after the last frame fall away."""
    hit = asof.forward(control, flow, "ride_id", "control_id", "frame_id", clamp=False).select("ride_id", "control_id", "us", "frame_id")
    return hit.join(flow.select("ride_id", "frame_id", "dx", "dy"), ["ride_id", "frame_id"]).select("ride_id", "control_id", "us", "dx", "dy")
