"""Implausible readings: robust exponentially weighted control charts per source, run counters and physical limits.

A chart keeps a mean and a scale of what is normal for its source. A reading outside is flagged, and clipped before it
updates either, so a spike cannot widen the limits. Run-length counters find stuck readings, limits impossible ones.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rovermill.functions.cells import samples_of
from rovermill.functions.timeline import micros
from rovermill.operators.chunks import first_of_key, map_groups, runs, with_halo
from rovermill.operators.trips import frozen_runs, local_median, to_metres


@dataclass(frozen=True)
class ChartRules:
    """Parameters of the charts. limit: scales beyond which a reading is flagged; weight: of a new reading; clip: scales to which an update is clipped."""

    weight: float = 0.05
    limit: float = 7.0
    clip: float = 2.0
    warm: int = 40
    leg_s: float = 600.0
    rpm_floor: float = 1.5
    rpm_share: float = 0.03
    rpm_least: float = 12.0
    rpm_max: float = 1_000.0
    rpm_stuck: int = 10
    gps_jump_m: float = 20.0
    gps_speed: float = 2.5
    gps_floor_m: float = 2.0
    gps_stuck: int = 8
    compass_dev: float = 150.0
    compass_share: float = 0.12
    compass_max: float = 20_000.0
    compass_stuck: int = 3
    chunk_s: int = 7_200
    halo_s: int = 300
    chunk_ids: int = 2_048
    halo_ids: int = 48


def ew_chart(r: np.ndarray, floor: np.ndarray, use: np.ndarray, rules: ChartRules, least: float = 0.0) -> np.ndarray:
    """Flags of one source's readings r in order. floor: least scale at each reading; use: readings that update the chart; NaN readings are never flagged."""
    n = len(r)
    flags = np.zeros(n, bool)
    seen = r[use & np.isfinite(r)][: rules.warm]
    if len(seen):
        mean = float(np.median(seen))
        scale = float(np.median(np.abs(seen - mean))) * 1.4826
    else:
        mean = scale = 0.0
    a, k, c = rules.weight, rules.limit, rules.clip
    for i, (v, f, u) in enumerate(zip(r.tolist(), floor.tolist(), use.tolist(), strict=True)):
        if v != v:
            continue
        s = scale if scale > f else f
        d = v - mean
        ad = -d if d < 0 else d
        if ad > k * s and ad > least:
            flags[i] = True
        if u:
            top = c * s
            if ad > top:
                d = top if d > 0 else -top
                ad = top
            mean += a * d
            # 1.2533 x the mean absolute deviation is the standard deviation of a normal reading
            scale += a * (1.2533 * ad - scale)
    return flags


def rpm_flags(t: np.ndarray, w: np.ndarray, rules: ChartRules) -> np.ndarray:
    """w: the four wheels as rows. Wheel 1 is judged against wheel 3 of its side, or else the mean of the other side."""
    w = np.where(np.isfinite(w), w, np.nan)
    one = w[0]
    with np.errstate(all="ignore"):
        other = np.where(np.isnan(w[1]), w[3], np.where(np.isnan(w[3]), w[1], (w[1] + w[3]) / 2))
        ref = np.where(np.isnan(w[2]), other, w[2])
        spread = np.where(np.isnan(w[2]), 3.0, 1.0)
    out = np.abs(one) > rules.rpm_max
    for lo, hi in zip(*runs(np.r_[True, np.diff(t) > rules.leg_s]), strict=True):
        s = slice(lo, hi)
        # stuck: equal finite readings, missing ones between them don't end the run
        stuck = np.zeros(hi - lo, bool)
        i = np.flatnonzero(np.isfinite(one[s]))
        if len(i) >= rules.rpm_stuck:
            rest = w[1:, s][:, i]
            v, moving = one[s][i], (np.nan_to_num(rest) != 0).any(axis=0)
            # a wheel at 0 while all are at 0 is normal: such rows end a run at 0
            quiet = (v == 0) & ~moving
            for a, b in zip(*runs(np.r_[True, (v[1:] != v[:-1]) | (quiet[1:] != quiet[:-1])]), strict=True):
                if b - a >= rules.rpm_stuck and not quiet[a] and any(len(np.unique(q[np.isfinite(q)])) > 1 for q in rest[:, a:b]):
                    stuck[i[a:b]] = True
        e = one[s] - ref[s]
        level = np.abs(np.nan_to_num(ref[s]))
        floor = (rules.rpm_floor + rules.rpm_share * level) * spread[s]
        out[s] |= ew_chart(e, floor, np.isfinite(e) & (level > 2) & ~stuck, rules, rules.rpm_least) | stuck
    return out


def wheel_spikes(control: DataFrame, rules: ChartRules | None = None) -> DataFrame:
    """control_id of the implausible rpm_1 readings. Rows without ride_id, control_id or time are left out; null, NaN and infinite rpm are missing, never flagged."""
    r = rules or ChartRules()
    wheels = ["rpm_1", "rpm_2", "rpm_3", "rpm_4"]
    rows = control.select("control_id", "ride_id", *wheels, micros(F.col("timestamp")).alias("us")).where("us is not null and ride_id is not null and control_id is not null")
    rows = with_halo(rows, F.col("us"), r.chunk_s * 1_000_000, r.halo_s * 1_000_000, r.halo_s * 1_000_000)

    def fn(_: dict, a: dict) -> dict:
        keep = first_of_key(a["control_id"])
        t = a["us"][keep] / 1e6
        flags = rpm_flags(t, np.vstack([a[c][keep].astype(float) for c in wheels]), r) & a["own"][keep].astype(bool)
        return {"row_id": a["control_id"][keep][flags]}

    return map_groups(rows, ["ride_id", "chunk"], ["us", "control_id"], fn, "row_id long").distinct()


def beyond_reach(t: np.ndarray, x: np.ndarray, y: np.ndarray, speed: float) -> np.ndarray:
    """Metres by which each fix is farther from the median of the fixes around it than a robot drives in the time between; 0 within reach."""
    (mx, _), (my, _), (mt, _) = local_median(x), local_median(y), local_median(t)
    return np.maximum(np.hypot(x - mx, y - my) - speed * np.abs(t - mt), 0.0)


def position_flags(t: np.ndarray, lat: np.ndarray, lon: np.ndarray, rules: ChartRules) -> np.ndarray:
    have = np.isfinite(lat) & np.isfinite(lon)
    # a value off the globe is judged even where its partner is missing
    out = (np.abs(np.nan_to_num(lat, posinf=0, neginf=0)) > 90) | (np.abs(np.nan_to_num(lon, posinf=0, neginf=0)) > 180) | ((lat == 0) & (lon == 0))
    for lo, hi in zip(*runs(np.r_[True, np.diff(t) > rules.leg_s]), strict=True):
        i = lo + np.flatnonzero((have & ~out)[lo:hi])
        stuck = frozen_runs(lat[i], lon[i], rules.gps_stuck)
        out[i[stuck]] = True
        i = i[~stuck]
        if len(i) < 3:
            continue
        x, y = to_metres(lat[i], lon[i])
        bad = np.zeros(len(i), bool)
        # chart of how much farther a fix lies from the fixes around it than the robot can drive in the time between. The wildest
        # go first, so that they don't pull the medians their neighbours are judged by
        for jump in (3 * rules.gps_jump_m, rules.gps_jump_m, rules.gps_jump_m):
            j = np.flatnonzero(~bad)
            if len(j) < 3:
                break
            over = beyond_reach(t[i[j]], x[j], y[j], rules.gps_speed)
            bad[j] = ew_chart(over, np.full(len(j), rules.gps_floor_m), np.ones(len(j), bool), rules, jump)
        # chart of the distance to the line between the neighbours
        j = np.flatnonzero(~bad)
        if len(j) >= 3:
            f = np.clip((t[i[j[1:-1]]] - t[i[j[:-2]]]) / np.maximum(t[i[j[2:]]] - t[i[j[:-2]]], 1e-6), 0, 1)
            res = np.hypot(x[j[1:-1]] - (x[j[:-2]] + f * (x[j[2:]] - x[j[:-2]])), y[j[1:-1]] - (y[j[:-2]] + f * (y[j[2:]] - y[j[:-2]])))
            span = np.minimum(t[i[j[1:-1]]] - t[i[j[:-2]]], t[i[j[2:]]] - t[i[j[1:-1]]])
            flag = ew_chart(res, 1.0 + rules.gps_speed * span / 4, np.ones(len(res), bool), rules, rules.gps_jump_m)
            # the neighbours of a spike are off the line too: only the farthest of three is flagged
            top = np.r_[True, res[1:] >= res[:-1]] & np.r_[res[:-1] > res[1:], True]
            bad[j[1:-1][flag & top]] = True
        out[i[bad]] = True
    return out


def position_spikes(fixes: DataFrame, rules: ChartRules | None = None) -> DataFrame:
    """gps_id of the implausible positions. Rows without ride_id, gps_id or time are left out; a missing latitude or longitude is no case."""
    r = rules or ChartRules()
    rows = fixes.select("gps_id", "ride_id", "latitude", "longitude", micros(F.col("timestamp")).alias("us")).where("us is not null and ride_id is not null and gps_id is not null")
    rows = with_halo(rows, F.col("us"), r.chunk_s * 1_000_000, r.halo_s * 1_000_000, r.halo_s * 1_000_000)

    def fn(_: dict, a: dict) -> dict:
        keep = first_of_key(a["gps_id"])
        flags = position_flags(a["us"][keep] / 1e6, a["latitude"][keep].astype(float), a["longitude"][keep].astype(float), r) & a["own"][keep].astype(bool)
        return {"row_id": a["gps_id"][keep][flags]}

    return map_groups(rows, ["ride_id", "chunk"], ["us", "gps_id"], fn, "row_id long").distinct()


def compass_flags(cells: list[np.ndarray], rules: ChartRules) -> np.ndarray:
    """cells: the usable samples (n x 4) of each cell of a ride, in order."""
    n = len(cells)
    out = np.zeros(n, bool)
    filled = [k for k in range(n) if len(cells[k])]
    if not filled:
        return out
    v = np.concatenate([cells[k][:, :3] for k in filled])
    at = np.concatenate([np.full(len(cells[k]), k) for k in filled])
    size = np.sqrt((v**2).sum(axis=1))
    wrong = (np.abs(v) > rules.compass_max).any(axis=1) | (size == 0)
    # strength chart: an offset makes the length of the vector depend on the heading, but far less than a spike does
    ok = ~wrong
    floor = max(rules.compass_dev / 2.5, rules.compass_share * float(np.median(size[ok]))) if ok.any() else 1.0
    wrong |= ew_chart(np.where(ok, size, np.nan), np.full(len(v), floor), ok, rules)
    # chart of how far a sample's axes are from those around it. Within a cell the heading stays: from the median of its cell, if
    # it has three good samples. In cells with fewer x is upright and doesn't depend on the heading, so it is held against the cells
    # before and after. y and z are not, as a turn and back again looks the same as a spike there; for them the strength chart
    # alone decides
    edge = np.r_[0, np.cumsum([len(cells[k]) for k in filled])]
    parts = [slice(edge[q], edge[q + 1]) for q in range(len(filled))]
    count = [int((~wrong[own]).sum()) for own in parts]
    off = np.full(len(v), np.nan)
    for own, n in zip(parts, count, strict=True):
        if n >= 3:
            off[own] = np.abs(v[own] - np.median(v[own][~wrong[own]], axis=0)).max(axis=1)
    off[wrong] = np.nan
    limit = np.full(len(v), rules.compass_dev / rules.limit)
    # a cell's middle is that of its samples in line; the spikes of larger cells are known by then
    wrong |= ew_chart(off, limit, np.isfinite(off), rules, rules.compass_dev)
    mid = [float(np.median(v[own, 0][~wrong[own]])) if (~wrong[own]).any() else None for own in parts]
    apart = np.full(len(v), np.nan)
    for q, own in enumerate(parts):
        if 0 < count[q] < 3 and 0 < q < len(parts) - 1 and mid[q - 1] is not None and mid[q + 1] is not None:
            lo, hi = min(mid[q - 1], mid[q + 1]), max(mid[q - 1], mid[q + 1])
            apart[own] = np.maximum(np.maximum(lo - v[own, 0], v[own, 0] - hi), 0.0)
    wrong |= ew_chart(apart, limit, np.isfinite(apart), rules, rules.compass_dev)
    out[np.unique(at[wrong])] = True
    # stuck: all samples of successive cells equal; cells without a usable sample don't end the run
    first = np.array([cells[k][0, :3] for k in filled])
    flat = np.array([(cells[k][:, :3] == cells[k][0, :3]).all() for k in filled])
    same = flat[1:] & flat[:-1] & (first[1:] == first[:-1]).all(axis=1)
    for a, b in zip(*runs(np.r_[True, ~same]), strict=True):
        if b - a >= rules.compass_stuck:
            out[np.array(filled)[a:b]] = True
    return out


def compass_spikes(imu: DataFrame, rules: ChartRules | None = None) -> DataFrame:
    """imu_id of the cells with an implausible compass sample. Unreadable cells and samples are missing, never flagged; rows without ride_id or imu_id are left out."""
    r = rules or ChartRules()
    rows = imu.select("imu_id", "ride_id", "compass").where("ride_id is not null and imu_id is not null")
    rows = with_halo(rows, F.col("imu_id"), r.chunk_ids, r.halo_ids, r.halo_ids)

    def fn(_: dict, a: dict) -> dict:
        keep = first_of_key(a["imu_id"])
        cells = [np.array(samples_of(c), float).reshape(-1, 4) for c in a["compass"][keep]]
        flags = compass_flags(cells, r) & a["own"][keep].astype(bool)
        return {"row_id": a["imu_id"][keep][flags]}

    return map_groups(rows, ["ride_id", "chunk"], ["imu_id"], fn, "row_id long").distinct()


def implausible_rows(control: DataFrame, fixes: DataFrame, imu: DataFrame, rules: ChartRules | None = None) -> DataFrame:
    """source, row_id of every implausible reading of the three tables; empty tables give no rows."""
    parts = [("control_data", wheel_spikes(control, rules)), ("gps_data", position_spikes(fixes, rules)), ("imu_data", compass_spikes(imu, rules))]
    out = [df.select(F.lit(name).alias("source"), "row_id") for name, df in parts]
    return out[0].unionByName(out[1]).unionByName(out[2])
