"""Extended Kalman filter over wheel speeds and positions, one ordered pass per ride.

The state (x, y, heading) depends on every step before, so this is the one estimator that cannot be a window. A ride is folded:
its rows come in order, one Arrow batch at a time, and only the filter's state and the positions not used yet are kept, so memory
is bounded however long the ride. What the pass must know beforehand (anchor rows, counts) comes from aggregates. The time of the
longest ride stays one task's; `legs` gives the form that starts anew after every long pause, where that is too long.
"""

from __future__ import annotations

import math
from collections import deque
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rovermill.operators.chunks import fold_groups
from rovermill.operators.sequences import previous, running
from rovermill.runtime import cut


@dataclass(frozen=True)
class FilterRules:
    """process and measure: variances; near_s: how far a control row may lie behind its fix; far_first: whether a fix that is too old is dropped before the anchor rule."""

    process: float = 0.1
    measure: float = 5.0
    near_s: float = 0.5
    far_first: bool = False


class State:
    """x, y, heading and the upper half of their covariance, as plain numbers: a step is a few dozen multiplications."""

    def __init__(self, rules: FilterRules) -> None:
        self.s = (0.0, 0.0, 0.0)
        self.p = (1.0, 0.0, 0.0, 1.0, 0.0, 1.0)
        self.rules = rules

    def step(self, v: float, w: float, dt: float, x: float, y: float) -> None:
        """Predicts over dt and corrects by a position."""
        q, r = self.rules.process, self.rules.measure
        sx, sy, th = self.s
        c, s = math.cos(th) * v * dt, math.sin(th) * v * dt
        sx, sy, th = sx + c, sy + s, th + w * dt
        # covariance after the motion, whose only coupling is position by heading: (-s, c)
        a, b, d, e, f, g = self.p
        a, b, d, e, f, g = a - 2 * s * d + s * s * g + q, b - s * f + c * d - s * c * g, d - s * g, e + 2 * c * f + c * c * g + q, f + c * g, g + q
        # gain = covariance with the position x inverse of the position's own plus noise
        m, n = a + r, e + r
        det = m * n - b * b
        k = [((i * n - j * b) / det, (j * m - i * b) / det) for i, j in ((a, b), (b, e), (d, f))]
        dx, dy = x - sx, y - sy
        self.s = (sx + k[0][0] * dx + k[0][1] * dy, sy + k[1][0] * dx + k[1][1] * dy, th + k[2][0] * dx + k[2][1] * dy)
        self.p = (a - k[0][0] * a - k[0][1] * b, b - k[0][0] * b - k[0][1] * e, d - k[0][0] * d - k[0][1] * f, e - k[1][0] * b - k[1][1] * e, f - k[1][0] * d - k[1][1] * f, g - k[2][0] * d - k[2][1] * f)


class Track:
    """The filter over one ride, fed piece by piece with control rows (kind 1: v, w) and positions (kind 0: x, y) in order of time.

    n, m: how many of each there are; anchor: place of the control row nearest to the first position; first: place of the
    position nearest to that; x0, y0: where it lies; ticks: units of time a second. As in the reference, as many rows are left out at the end as lie before the
    anchor, a position is used by the first control row less than near_s behind it, the first one by the first row of all.
    """

    def __init__(self, rules: FilterRules, n: int, m: int, anchor: int, first: int, x0: float, y0: float, ticks: float = 1.0) -> None:
        self.rules, self.state, self.ticks = rules, State(rules), ticks
        self.m, self.anchor, self.end = m, anchor, n - anchor
        self.first = self.next = first
        self.x0, self.y0 = x0, y0
        self.control = self.position = self.made = 0
        self.waiting: deque[tuple[float, float, float]] = deque()
        self.before = 0.0

    def feed(self, t: list, kind: list, v: list, w: list, x: list, y: list) -> list[tuple]:
        """Rows (idx, x, y, heading, time) that are done with this piece."""
        out: list[tuple] = []
        for at, k, vi, wi, xi, yi in zip(t, kind, v, w, x, y, strict=True):
            if k == 0:
                if self.position >= self.next:
                    self.waiting.append((at, xi - self.x0, yi - self.y0))
                self.position += 1
                continue
            i, self.control = self.control, self.control + 1
            if i == self.anchor:
                out.append((self.made, 0.0, 0.0, 0.0, at))
                self.made += 1
            elif self.anchor < i < self.end and self.next < self.m:
                self.row(at, vi, wi, out)
            self.before = at
        return out

    def row(self, at: float, v: float, w: float, out: list[tuple]) -> None:
        near = self.rules.near_s
        d = (at - self.waiting[0][0]) / self.ticks if self.waiting else -1.0
        if d >= near and self.rules.far_first:
            self.keep(at, out)
            return
        if 0 < d < near or self.next == self.first:
            if v == 0 and w == 0:
                self.keep(at, out)
                return
            # the track begins at the first position, whether its row has come yet or not
            x, y = self.waiting[0][1:] if self.waiting else (0.0, 0.0)
            self.state.step(v, w, (at - self.before) / self.ticks, x, y)
            self.keep(at, out)
        if d >= near:
            self.keep(at, out)

    def keep(self, at: float, out: list[tuple]) -> None:
        out.append((self.made, *self.state.s, at))
        self.made += 1
        self.next += 1
        if self.waiting:
            self.waiting.popleft()


def run_filter(ct: np.ndarray, v: np.ndarray, w: np.ndarray, gt: np.ndarray, gx: np.ndarray, gy: np.ndarray, rules: FilterRules) -> np.ndarray:
    """Rows (x, y, heading, time) of one ride in arrays: control times and speeds, position times and coordinates (metres)."""
    if len(ct) == 0 or len(gt) == 0:
        return np.zeros((0, 4))
    anchor = int(np.argmin(np.abs(ct - gt[0])))
    first = int(np.argmin(np.abs(gt - ct[anchor])))
    track = Track(rules, len(ct), len(gt), anchor, first, float(gx[first]), float(gy[first]))
    none_c, none_g = np.zeros(len(ct)), np.zeros(len(gt))
    t, kind = np.r_[gt, ct], np.r_[none_g, none_c + 1]
    order = np.lexsort((kind, t))
    cols = (t, kind, np.r_[none_g, v], np.r_[none_g, w], np.r_[gx, none_c], np.r_[gy, none_c])
    return np.array([r[1:] for r in track.feed(*(c[order].tolist() for c in cols))]).reshape(-1, 4)


POSITION, CONTROL, FACTS = 0, 1, -1
EVENT = ["us", "kind", "id", "v", "w", "x", "y", "place"]


def facts(events: DataFrame, entity: list[str]) -> DataFrame:
    """One row of kind FACTS for every entity with control rows and positions: v, w: how many of each; id, place: anchor and first; x, y: where the track begins."""
    us, control, position = F.col("us"), events.where(F.col("kind") == CONTROL), events.where(F.col("kind") == POSITION)
    start = position.groupBy(*entity).agg(F.min("us").alias("g0"), F.count(F.lit(1)).alias("m"))
    anchor = control.join(start, entity).groupBy(*entity, "g0", "m").agg(F.min_by("us", F.struct(F.abs(us - F.col("g0")).alias("d"), "us")).alias("a"), F.count(F.lit(1)).alias("n"))
    first = position.join(anchor, entity).groupBy(*entity, "a", "n", "m").agg(F.min_by(F.struct("us", "x", "y"), F.struct(F.abs(us - F.col("a")).alias("d"), "us", "id")).alias("f"))
    both = events.join(first, entity).groupBy(*entity, "n", "m", "f").agg(F.count_if((F.col("kind") == CONTROL) & (us < F.col("a"))).alias("anchor"), F.count_if((F.col("kind") == POSITION) & (us < F.col("f.us"))).alias("place"))
    return both.select(*entity, F.lit(-(2**62)).cast("long").alias("us"), F.lit(FACTS).alias("kind"), F.col("anchor").alias("id"), F.col("n").cast("double").alias("v"), F.col("m").cast("double").alias("w"), F.col("f.x").alias("x"), F.col("f.y").alias("y"), "place")


def filtered_track(events: DataFrame, rules: FilterRules | None = None, entity: tuple[str, ...] = ("ride_id",)) -> DataFrame:
    """entity, idx, x, y, heading, us of every ride, or of every leg if entity is (ride_id, leg).

    events: entity, us, kind (0 position with x, y; 1 control with v, w), id, by which rows of one time are ordered. Rides without
    control or positions give no rows.
    """
    r = rules or FilterRules()
    keys = list(entity)
    rows = cut(events.select(*keys, *EVENT[:-1]).withColumn("place", F.lit(0).cast("long")), "events")

    def begin(key: dict):  # noqa: ANN202
        track, base = None, None

        def fold(a: dict) -> dict | None:
            nonlocal track, base
            if track is None:
                if a["kind"][0] != FACTS:
                    return None
                track = Track(r, int(a["v"][0]), int(a["w"][0]), int(a["id"][0]), int(a["place"][0]), float(a["x"][0]), float(a["y"][0]), 1e6)
                a = {c: q[1:] for c, q in a.items()}
            if len(a["us"]) == 0:
                return None
            base = int(a["us"][0]) if base is None else base
            out = np.array(track.feed((a["us"] - base).tolist(), *(a[c].tolist() for c in ("kind", "v", "w", "x", "y")))).reshape(-1, 5)
            named = {"idx": out[:, 0].astype(np.int64), "x": out[:, 1], "y": out[:, 2], "heading": out[:, 3], "us": out[:, 4].astype(np.int64) + base}
            return {k: np.full(len(out), v) for k, v in key.items()} | named

        return fold

    schema = ", ".join(f"{k} long" for k in keys) + ", idx long, x double, y double, heading double, us long"
    return fold_groups(rows.unionByName(facts(rows, keys)), keys, ["us", "kind", "id"], begin, schema)


def legs(df: DataFrame, gap_us: int = 600_000_000, order: tuple[str, ...] = ("us", "kind", "id")) -> DataFrame:
    """Adds leg, the number of pauses longer than gap_us before a row of its ride. df has a chunk column."""
    p = previous(df, ["us"], ("ride_id",), order, settle=True)
    new = F.when(F.col("us") - F.col("prev.us") > gap_us, 1).otherwise(0).cast("long")
    return running(p, {"leg": new}, ("ride_id",), order).drop("prev")
