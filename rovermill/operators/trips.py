"""Stops and trips from location pings: density clustering of each device's fixes in place and time.

A fix is core if, of the time covered by its neighbours in time (`window_s`), a share of at least `share` and at least
`cover_s` seconds lie within `eps_m` of it. Core fixes that follow each other in place and within the silence form a
cluster; a cluster that stays `min_stop_s` within `radius_m` is a stop, the ordered rest between stops are trips. The first
and last fix at rest come from a least-squares change point: a straight approach into a fixed place.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rovermill.functions.timeline import micros
from rovermill.operators.chunks import first_of_key, map_groups, runs, with_halo

M_PER_DEG_LAT, M_PER_DEG_LON = 110_540.0, 111_320.0


@dataclass(frozen=True)
class StopRules:
    """Parameters; metres and seconds. chunk_s and halo_s divide the work: each chunk judges its fixes with halo_s more on both sides, and what crosses a border is put together from its pieces."""

    eps_m: float = 8.0
    window_s: float = 90.0
    share: float = 0.8
    cover_s: float = 25.0
    gap_cap_s: float = 15.0
    silence_s: float = 600.0
    radius_m: float = 12.0
    merge_m: float = 6.0
    min_stop_s: float = 120.0
    frozen_rows: int = 5
    jump_m: float = 20.0
    top_speed: float = 2.5
    least_speed: float = 0.4
    chunk_s: int = 10_800
    halo_s: int = 1_500


def local_median(v: np.ndarray, width: int = 7) -> tuple[np.ndarray, np.ndarray]:
    """Medians of the `width` values around each, the window pushed inward at the ends, and the window's first index."""
    n = len(v)
    w = min(width, n)
    first = np.clip(np.arange(n) - w // 2, 0, n - w)
    return np.median(v[first[:, None] + np.arange(w)[None, :]], axis=1), first


def off_path(t: np.ndarray, x: np.ndarray, y: np.ndarray, jump_m: float, top_speed: float) -> np.ndarray:
    """Fixes farther from the median of the fixes around them than a robot can drive in the time between."""
    if len(t) < 3:
        return np.zeros(len(t), bool)
    mx, _ = local_median(x)
    my, _ = local_median(y)
    mt, _ = local_median(t)
    return np.hypot(x - mx, y - my) > jump_m + top_speed * np.abs(t - mt)


def frozen_runs(a: np.ndarray, b: np.ndarray, least: int) -> np.ndarray:
    """Mask of the runs of at least `least` exactly equal pairs."""
    ch = np.ones(len(a), bool)
    ch[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
    s, e = runs(ch)
    return np.repeat(e - s >= least, e - s)


def to_metres(lat: np.ndarray, lon: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    la, lo = np.median(lat), np.median(lon)
    return (lon - lo) * M_PER_DEG_LON * np.cos(np.radians(la)), (lat - la) * M_PER_DEG_LAT


def plausible(t: np.ndarray, lat: np.ndarray, lon: np.ndarray, r: StopRules) -> np.ndarray:
    ok = np.isfinite(lat) & np.isfinite(lon)
    ok &= (np.abs(np.where(ok, lat, 0)) <= 90) & (np.abs(np.where(ok, lon, 0)) <= 180) & ~((lat == 0) & (lon == 0))
    i = np.flatnonzero(ok)
    ok[i[frozen_runs(lat[i], lon[i], r.frozen_rows)]] = False
    for _ in range(2):
        i = np.flatnonzero(ok)
        if len(i) < 3:
            break
        x, y = to_metres(lat[i], lon[i])
        ok[i[off_path(t[i], x, y, r.jump_m, r.top_speed)]] = False
    return ok


def core_fixes(t: np.ndarray, x: np.ndarray, y: np.ndarray, r: StopRules) -> np.ndarray:
    n = len(t)
    step = np.minimum(np.diff(t), r.gap_cap_s)
    w = (np.r_[step, 0.0] + np.r_[0.0, step]) / 2
    near, every = w.copy(), w.copy()
    k = 1
    while k < n:
        in_time = t[k:] - t[:-k] <= r.window_s
        if not in_time.any():
            break
        close = in_time & (np.hypot(x[k:] - x[:-k], y[k:] - y[:-k]) <= r.eps_m)
        every[:-k] += np.where(in_time, w[k:], 0)
        every[k:] += np.where(in_time, w[:-k], 0)
        near[:-k] += np.where(close, w[k:], 0)
        near[k:] += np.where(close, w[:-k], 0)
        k += 1
    # at the edge of a stop half of the window lies under way: each side is judged by itself as well
    return (near >= r.cover_s) & ((near >= r.share * every) | (near >= r.share * r.window_s))


def change_point(t: np.ndarray, x: np.ndarray, y: np.ndarray, rest: np.ndarray, edge: int, sign: int, least_speed: float) -> int:
    """Index of the first (sign 1) or last (sign -1) fix at rest: the split with least squared error of approach and rest."""
    n, inner = len(t), rest[0] if sign > 0 else rest[-1]
    out = edge
    while 0 <= out - sign < n and abs(t[edge] - t[out - sign]) <= 25 and abs(t[out] - t[out - sign]) <= 60:
        out -= sign
    into = inner
    while into != (rest[-1] if sign > 0 else rest[0]) and abs(t[into] - t[inner]) < 40:
        into += sign
    j = np.arange(out, into + sign, sign)
    tt, px, py = (t[j] - t[j[0]]) * sign, x[j], y[j]
    best, at = np.inf, 0
    for s in range(len(j)):
        if sign * (t[j[s]] - t[inner]) > 20:
            break
        cx, cy = px[s:].mean(), py[s:].mean()
        sse = ((px[s:] - cx) ** 2 + (py[s:] - cy) ** 2).sum()
        if s:
            lead = np.minimum(tt[:s] - tt[s] + (tt[s] - tt[s - 1]) * 0.5, 0)
            q = (lead**2).sum()
            vx, vy = (((px[:s] - cx) * lead).sum() / q, ((py[:s] - cy) * lead).sum() / q) if q > 0 else (0.0, 0.0)
            if np.hypot(vx, vy) < least_speed:
                continue  # not an approach, only the wandering of fixes at rest
            sse += ((px[:s] - cx - vx * lead) ** 2 + (py[:s] - cy - vy * lead) ** 2).sum()
        if sse < best - 1e-9:
            best, at = sse, s
    return int(j[at])


def stops_of(t: np.ndarray, x: np.ndarray, y: np.ndarray, r: StopRules) -> list[tuple[int, int]]:
    """First and last index of each stop of one silence-free stretch of plausible fixes."""
    i = np.flatnonzero(core_fixes(t, x, y, r)) if len(t) > 2 else np.zeros(0, int)
    if len(i) == 0:
        return []
    far = (np.diff(t[i]) > r.silence_s) | (np.hypot(np.diff(x[i]), np.diff(y[i])) > r.radius_m)
    clusters: list[np.ndarray] = []
    for g in np.split(i, np.flatnonzero(far) + 1):
        cx, cy = np.median(x[g]), np.median(y[g])
        if clusters:
            p = clusters[-1]
            mid = slice(p[-1] + 1, g[0])
            if t[g[0]] - t[p[-1]] <= r.silence_s and np.hypot(cx - np.median(x[p]), cy - np.median(y[p])) <= r.merge_m and (np.hypot(x[mid] - cx, y[mid] - cy) <= r.radius_m).all():
                clusters[-1] = np.r_[p, g]
                continue
        clusters.append(g)
    out = []
    for g in clusters:
        a, b, cx, cy = g[0], g[-1], np.median(x[g]), np.median(y[g])
        while a > 0 and np.hypot(x[a - 1] - cx, y[a - 1] - cy) <= r.radius_m:
            a -= 1
        while b < len(t) - 1 and np.hypot(x[b + 1] - cx, y[b + 1] - cy) <= r.radius_m:
            b += 1
        s, e = change_point(t, x, y, g, a, 1, r.least_speed), change_point(t, x, y, g, b, -1, r.least_speed)
        if out and s <= out[-1][1]:
            s = out[-1][1] + 1
        if e > s and t[e] - t[s] >= r.min_stop_s:
            out.append((s, e))
    return out


PIECES = "ride_id long, chunk long, kind string, start_us long, end_us long, fixes long, distance_m double, lat_sum double, lon_sum double, joined boolean"


def stops_and_trips(fixes: DataFrame, rules: StopRules | None = None) -> DataFrame:
    """Stops and trips of every ride.

    fixes: gps_id, ride_id, latitude, longitude, timestamp (epoch ms or s); other columns are ignored. Rows that repeat a gps_id
    count once. Rows without ride_id or time are left out; null, NaN, impossible, frozen or far-off positions neither end a stop
    nor add distance. A ride without a plausible fix, and an empty table, give no rows.

    Returns ride_id, kind ('stop' or 'trip'), start_us, end_us, duration_s, distance_m (path length over the plausible
    fixes), fixes, latitude, longitude (mean place).
    """
    r = rules or StopRules()
    rows = fixes.select("gps_id", "ride_id", "latitude", "longitude", micros(F.col("timestamp")).alias("us")).where("us is not null and ride_id is not null and gps_id is not null")
    rows = with_halo(rows, F.col("us"), r.chunk_s * 1_000_000, r.halo_s * 1_000_000, r.halo_s * 1_000_000)

    def pieces(key: dict, a: dict) -> dict | None:
        keep = first_of_key(a["gps_id"])
        us, lat, lon, own = a["us"][keep], a["latitude"][keep].astype(float), a["longitude"][keep].astype(float), a["own"][keep].astype(bool)
        t = (us - us[0]) / 1e6
        res: dict[str, list] = {c.split()[0]: [] for c in PIECES.split(", ")}
        for lo, hi in zip(*runs(np.r_[True, np.diff(t) > r.silence_s]), strict=True):
            i = lo + np.flatnonzero(plausible(t[lo:hi], lat[lo:hi], lon[lo:hi], r))
            if len(i) == 0 or not own[i].any():
                continue
            x, y = to_metres(lat[i], lon[i])
            label = np.zeros(len(i), int)
            for n, (s, e) in enumerate(stops_of(t[i], x, y, r), 1):
                label[s : e + 1] = n
            step = np.r_[0.0, np.hypot(np.diff(x), np.diff(y))]
            mine = np.flatnonzero(own[i])
            for s, e in zip(*runs(np.r_[True, label[mine[1:]] != label[mine[:-1]]]), strict=True):
                m = mine[s:e]
                joined = bool(m[0] > 0 and label[m[0] - 1] == label[m[0]] and s == 0)
                for c, v in zip(res, (key["ride_id"], key["chunk"], "stop" if label[m[0]] else "trip", us[i[m[0]]], us[i[m[-1]]], len(m), float(step[m].sum()), float(lat[i[m]].sum()), float(lon[i[m]].sum()), joined), strict=True):
                    res[c].append(v)
        return res

    found = map_groups(rows, ["ride_id", "chunk"], ["us", "gps_id"], pieces, PIECES)
    # what a border cut is put together again: one row per piece, far fewer than fixes
    w = Window.partitionBy("ride_id").orderBy("start_us", "end_us")
    same = F.col("joined") & (F.lag("kind").over(w) == F.col("kind"))
    return (
        found.withColumn("seg", F.sum(F.when(same, 0).otherwise(1)).over(w))
        .groupBy("ride_id", "seg", "kind")
        .agg(F.min("start_us").alias("start_us"), F.max("end_us").alias("end_us"), F.sum("distance_m").alias("distance_m"), F.sum("fixes").alias("fixes"), (F.sum("lat_sum") / F.sum("fixes")).alias("latitude"), (F.sum("lon_sum") / F.sum("fixes")).alias("longitude"))
        .select("ride_id", "kind", "start_us", "end_us", ((F.col("end_us") - F.col("start_us")) / 1e6).alias("duration_s"), "distance_m", "fixes", "latitude", "longitude")
    )


def found_stops(fixes: DataFrame, rules: StopRules | None = None) -> DataFrame:
    """ride_id, start_minute of every stop."""
    return stops_and_trips(fixes, rules).where("kind = 'stop'").select("ride_id", F.floor(F.col("start_us") / F.lit(60_000_000)).cast("long").alias("start_minute"))
