"""Runs of repeated consecutive events: each becomes one row with count and duration.

Runs come from the difference of row numbers: the row number within the entity minus that within entity and value is constant
along a run of equal events. `equal_runs` does so with the rounded commands. `anchored_runs` is for near-equal events, where
each row is held against the first of its run; there an event is first canonicalised to the command of that first row, then
the same difference gives the runs, their counts and durations.

Canonicalising needs the rows before, but no whole entity in one task. Equal consecutive events are collapsed first, as they
join or break a run together. A row that no open run can reach (a long pause, or a step of more than twice the tolerance)
begins a run whatever came before, so a time chunk is sure of everything from there. What its first rows do depends on the
command of the run that comes in; as commands are whole steps, a table of at most 4 x tolerance + 2 boxes says for every such
command where it leaves the chunk. One row a chunk with that table is put in order per entity, each chunk then gets the command
that comes in, and its first rows are canonicalised in the chunk.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rovermill.functions.timeline import finite, micros
from rovermill.operators.chunks import map_groups
from rovermill.runtime import cut


@dataclass(frozen=True)
class RunRules:
    tolerance: int = 20
    scale: float = 1000.0
    max_gap_us: int = 10_000_000
    min_rows: int = 3
    chunk_s: int = 3_600


EVENT = ["us", "last_us", "first_id", "last_id", "linear", "angular", "pauses", "n"]
EVENTS = "ride_id long, chunk long, kind int, " + ", ".join(f"{c} long" for c in EVENT) + ", boxes array<long>"
DONE, HEAD, CHUNK, STATE = 0, 1, 2, 3
PART = ["ride_id", "chunk"]


def readings(control: DataFrame, r: RunRules) -> DataFrame:
    """ride_id, chunk, us, control_id, commands in whole steps of 1 / scale (halves rounded away from zero), each control_id once and unusable rows left out; hashed by ride and chunk."""
    step = lambda c: (F.signum(c) * F.floor(F.abs(F.col(c)) * F.lit(r.scale) + F.lit(0.5))).cast("long").alias(c)
    usable = finite(F.col("linear")) & finite(F.col("angular")) & finite(F.col("timestamp"))
    rows = control.where(usable & F.col("ride_id").isNotNull() & F.col("control_id").isNotNull())
    rows = rows.select("control_id", "ride_id", micros(F.col("timestamp")).alias("us"), step("linear"), step("angular"))
    rows = rows.withColumn("chunk", F.floor(F.col("us") / F.lit(r.chunk_s * 1_000_000))).repartition(*PART)
    w = Window.partitionBy(*PART).orderBy("us", "control_id")
    return rows.withColumn("again", F.coalesce(F.lag("control_id").over(w) == F.col("control_id"), F.lit(False))).where("not again").drop("again")


def events_of(rows: DataFrame, r: RunRules) -> DataFrame:
    """Readings as events; pauses counts the pauses of a chunk up to a row, so that equal readings on both sides of one differ."""
    w = Window.partitionBy(*PART).orderBy("us", "control_id")
    pause = F.coalesce(F.col("us") - F.lag("us").over(w) > r.max_gap_us, F.lit(False)).cast("long")
    rows = rows.withColumn("pause", pause).withColumn("pauses", F.sum("pause").over(w))
    same = {"last_us": F.col("us"), "first_id": F.col("control_id"), "last_id": F.col("control_id"), "n": F.lit(1).cast("long")}
    return rows.withColumns(same).select(*PART, *EVENT)


def equal_parts(events: DataFrame, values: Sequence[str]) -> DataFrame:
    """Runs of events that are equal in values, within each (ride, chunk), by the difference of row numbers.

    a and b: (time, id) of the first and the last reading; opens and closes: whether a run is the first or the last of its chunk.
    """
    w = Window.partitionBy(*PART).orderBy("us", "first_id")
    by_value = Window.partitionBy(*PART, *values).orderBy("us", "first_id")
    placed = events.withColumn("place", F.row_number().over(w)).withColumn("size", F.count(F.lit(1)).over(Window.partitionBy(*PART)))
    islands = placed.withColumn("island", F.col("place") - F.row_number().over(by_value))
    a, b = F.min(F.struct(F.col("us").alias("us"), F.col("first_id").alias("id"))), F.max(F.struct(F.col("last_us").alias("us"), F.col("last_id").alias("id")))
    ends = [(F.min("place") == 1).alias("opens"), (F.max("place") == F.max("size")).alias("closes")]
    return islands.groupBy(*PART, *values, "island").agg(a.alias("a"), b.alias("b"), F.sum("n").alias("n"), *ends)


def across_chunks(parts: DataFrame, max_gap_us: int | None) -> DataFrame:
    """ride_id, linear, angular, a, b, n: runs whose parts meet at a border put together.

    Only a run at its chunk's border can go on: at most two rows a chunk are put in order per ride, all others are whole.
    """
    v = Window.partitionBy("ride_id").orderBy("a")
    joins: Column = F.col("opens") & F.lag("closes").over(v) & (F.lag("linear").over(v) == F.col("linear")) & (F.lag("angular").over(v) == F.col("angular"))
    if max_gap_us is not None:
        joins = joins & (F.col("a.us") - F.lag("b.us").over(v) <= max_gap_us)
    edge = parts.where("opens or closes").withColumn("run", F.sum(F.when(F.coalesce(joins, F.lit(False)), 0).otherwise(1)).over(v))
    edge = edge.groupBy("ride_id", "run", "linear", "angular").agg(F.min("a").alias("a"), F.max("b").alias("b"), F.sum("n").alias("n"))
    cols = ["ride_id", "linear", "angular", "a", "b", "n"]
    return parts.where("not opens and not closes").select(*cols).unionByName(edge.select(*cols))


def anchors(lin: list, ang: list, pauses: list, state: tuple | None, tol: int) -> list[tuple]:
    """The command of each event's first one of its run. state: (linear, angular, pauses) of the run that comes in."""
    a, b, p = state or (0, 0, None)
    out = []
    for x, y, q in zip(lin, ang, pauses, strict=True):
        if q != p or x - a > tol or a - x > tol or y - b > tol or b - y > tol:
            a, b, p = x, y, q
        out.append((a, b))
    return out


def leaving(lin: np.ndarray, ang: np.ndarray, tol: int) -> list[int]:
    """Boxes of a chunk without sure starts, six numbers each: a run that comes in with a command outside of the box (linear from, to,
    angular from, to), and inside of all before, ends there, and the chunk is left with the command of the last two numbers.
    """
    top = lambda v: np.maximum.accumulate(v) - tol
    sides = np.stack([top(lin), -top(-lin), top(ang), -top(-ang)])
    new = np.r_[True, (sides[:, 1:] != sides[:, :-1]).any(axis=0)]
    wide = (sides[0] <= sides[1]) & (sides[2] <= sides[3])
    # behind the first empty box nothing is left to decide
    empty = np.flatnonzero(~wide)
    at = np.flatnonzero(new[: empty[0] + 1] if len(empty) else new)
    x, y = lin.tolist(), ang.tolist()
    known: dict[int, tuple[int, int]] = {}
    out: list[int] = []
    for k in at[::-1].tolist():
        # from a start on all is sure; chains that meet go on as one
        path, i, a, b = [k], k, x[k], y[k]
        end = known.get(k)
        while end is None:
            i += 1
            if i == len(x):
                end = (a, b)
            elif not (-tol <= x[i] - a <= tol and -tol <= y[i] - b <= tol):
                end = known.get(i)
                a, b = x[i], y[i]
                path.append(i)
        known.update(dict.fromkeys(path, end))
        out[:0] = [*sides[:, k].tolist(), *end]
    return out


def canonical_events(events: DataFrame, rules: RunRules) -> DataFrame:
    """Events with linear and angular of the first event of their run. events as equal_parts gives them for equal values, hashed by ride and chunk."""
    tol, gap = rules.tolerance, rules.max_gap_us

    def table(key: dict, kind: list, cols: dict, boxes: list | None = None) -> dict:
        n = len(kind)
        lists = np.empty(n, object)
        if boxes is not None:
            lists[-1] = boxes
        return {k: np.full(n, v) for k, v in key.items()} | {"kind": np.array(kind, np.int32)} | cols | {"boxes": lists}

    def in_chunk(key: dict, a: dict) -> dict:
        lin, ang, pauses = a["linear"], a["angular"], a["pauses"]
        hard = (np.diff(pauses) > 0) | (np.abs(np.diff(lin)) > 2 * tol) | (np.abs(np.diff(ang)) > 2 * tol)
        sure = np.flatnonzero(hard)
        start = int(sure[0]) + 1 if len(sure) else len(lin)
        done = np.array(anchors(lin[start:].tolist(), ang[start:].tolist(), pauses[start:].tolist(), None, tol), np.int64).reshape(-1, 2)
        a["linear"], a["angular"] = np.r_[lin[:start], done[:, 0]], np.r_[ang[:start], done[:, 1]]
        # one row more, of the chunk itself
        last = {"us": a["us"][0], "last_us": a["last_us"][-1], "linear": a["linear"][-1], "angular": a["angular"][-1]}
        cols = {c: np.r_[a[c], last.get(c, 0)] for c in EVENT}
        return table(key, [HEAD] * start + [DONE] * (len(lin) - start) + [CHUNK], cols, None if len(sure) else leaving(lin, ang, tol))

    def in_order(key: dict, a: dict) -> dict:
        n = len(a["us"])
        come = np.zeros((3, n), np.int64)
        state = None
        for i, (us, last, x, y, boxes) in enumerate(zip(*(a[c].tolist() for c in ("us", "last_us", "linear", "angular", "boxes")), strict=True)):
            fresh = state is None or us - state[2] > gap
            come[:, i] = (0, 0, 0) if fresh else (*state[:2], 1)
            if boxes is not None:
                q = np.asarray(boxes).reshape(-1, 6)
                out = np.zeros(1, int) if fresh else np.flatnonzero((q[:, 0] > state[0]) | (q[:, 1] < state[0]) | (q[:, 2] > state[1]) | (q[:, 3] < state[1]))
                x, y = q[out[0], 4:].tolist() if len(out) else state[:2]
            state = (x, y, last)
        cols = {c: np.zeros(n, np.int64) for c in EVENT} | {"us": np.full(n, -(2**62)), "linear": come[0], "angular": come[1], "n": come[2]}
        return table({**key, "chunk": 0}, [STATE] * n, cols) | {"chunk": a["chunk"]}

    def heads(key: dict, a: dict) -> dict:
        s = (int(a["linear"][0]), int(a["angular"][0]), 0) if a["n"][0] else None
        cols = {c: a[c][1:] for c in EVENT}
        done = np.array(anchors(cols["linear"].tolist(), cols["angular"].tolist(), cols["pauses"].tolist(), s, tol), np.int64).reshape(-1, 2)
        return table(key, [DONE] * len(done), cols | {"linear": done[:, 0], "angular": done[:, 1]})

    first = cut(map_groups(events, PART, ["us", "first_id"], in_chunk, EVENTS, clustered=True), "events")
    state = map_groups(first.where(F.col("kind") == CHUNK), ["ride_id"], ["chunk"], in_order, EVENTS)
    open_ = map_groups(first.where(F.col("kind") == HEAD).unionByName(state), PART, ["us", "first_id"], heads, EVENTS)
    return first.where(F.col("kind") == DONE).unionByName(open_).select(*PART, *EVENT)


def collapsed(control: DataFrame, r: RunRules) -> DataFrame:
    """Equal consecutive readings without a pause between them as one event each."""
    p = equal_parts(events_of(readings(control, r), r), ["linear", "angular", "pauses"])
    return p.select(*PART, F.col("a.us").alias("us"), F.col("b.us").alias("last_us"), F.col("a.id").alias("first_id"), F.col("b.id").alias("last_id"), "linear", "angular", "pauses", "n")


def anchored_runs(control: DataFrame, rules: RunRules | None = None) -> DataFrame:
    """Runs of near-equal commands of every ride: ride_id, first_id, last_id, start_us, duration_s, n, linear, angular.

    control: control_id, ride_id, linear, angular, timestamp; other columns are ignored. Rows go by time in whole microseconds, then control_id; a repeated
    control_id counts once. Rows with a null, NaN or infinite command, without time, ride or id are left out. A row joins the
    run if both commands differ by at most `tolerance` steps from the run's first row and it comes at most max_gap_us after the
    row before it. Runs of fewer than min_rows rows are not returned; empty tables give no rows.
    """
    r = rules or RunRules()
    canonical = canonical_events(collapsed(control, r), r).repartition(*PART)
    runs = across_chunks(equal_parts(canonical, ["linear", "angular", "pauses"]), r.max_gap_us).where(F.col("n") >= r.min_rows)
    a, b = F.col("a"), F.col("b")
    return runs.select("ride_id", a["id"].alias("first_id"), b["id"].alias("last_id"), a["us"].alias("start_us"), ((b["us"] - a["us"]) / 1e6).alias("duration_s"), "n", (F.col("linear") / r.scale).alias("linear"), (F.col("angular") / r.scale).alias("angular"))


def equal_runs(control: DataFrame, rules: RunRules | None = None) -> DataFrame:
    """Runs of equal commands after rounding: ride_id, first_id, last_id, n, duration_s. Pauses don't end a run here. Rows are chosen and ordered as in anchored_runs."""
    r = rules or RunRules()
    events = events_of(readings(control, r), r)
    runs = across_chunks(equal_parts(events, ["linear", "angular"]), None)
    a, b = F.col("a"), F.col("b")
    return runs.select("ride_id", a["id"].alias("first_id"), b["id"].alias("last_id"), "n", F.round((b["us"] - a["us"]) / 1e6, 6).alias("duration_s"))
