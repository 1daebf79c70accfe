"""Irregular readings onto a regular grid, short gaps filled by iterative singular-spectrum imputation.

Readings are averaged per bucket around each slot. A series between two long gaps is embedded as a Hankel matrix; its
leading singular vectors give a smooth reconstruction that replaces the missing entries, again and again until they settle.
For given vectors the entries that such replacing would end at solve a linear system, so each round goes there at once, then
takes the vectors anew. Slots of long gaps stay empty and are marked; so are filled slots of a stretch that had not settled at
the safety limit of rounds. A stretch is one series, whatever its length: a round costs in proportion to it.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

GRID = "traj_id long, ride_id long, slot long, status string, x double, y double, yaw double"


@dataclass(frozen=True)
class GridRules:
    """rounds: a safety limit far above what stretches need to settle within tolerance x their size. dense: missing entries up to which the system is solved directly, beyond by conjugate gradients."""

    step_us: int = 250_000
    max_gap_us: int = 1_000_000
    window: int = 16
    rank: int = 3
    rounds: int = 10_000
    tolerance: float = 1e-4
    dense: int = 600


def hankel(v: np.ndarray, window: int) -> np.ndarray:
    """The Hankel matrix of a series as a view: row i holds the window from entry i on."""
    v = np.ascontiguousarray(v, float)
    return np.ndarray((len(v) - window + 1, window), float, v, 0, (8, 8))


def leading(v: np.ndarray, window: int, rank: int) -> np.ndarray:
    """The leading right singular vectors of the series' Hankel matrix."""
    h = hankel(v, window)
    return np.linalg.eigh(h.T @ h)[1][:, -rank:]


def summed(v: np.ndarray, lead: np.ndarray) -> np.ndarray:
    """The sums of the diagonals of the series' Hankel matrix projected on lead."""
    window, n = len(lead), len(v)
    k = n - window + 1
    low = lead @ (hankel(v, window) @ lead).T
    total = np.zeros(n)
    for j in range(window):
        total[j : j + k] += low[j]
    return total


def smoothed(v: np.ndarray, lead: np.ndarray) -> np.ndarray:
    """The series after projecting its Hankel matrix on lead: diagonal averages."""
    return summed(v, lead) / copies(len(v), len(lead))


def hankel_smooth(v: np.ndarray, window: int, rank: int) -> np.ndarray:
    """Rank-limited reconstruction of a series: Hankel embedding, leading singular vectors, diagonal averages."""
    return smoothed(v, leading(v, window, rank))


def copies(n: int, window: int) -> np.ndarray:
    """How often each entry of a series stands in its Hankel matrix."""
    i = np.arange(n)
    return np.minimum(np.minimum(i, n - 1 - i) + 1, min(window, n - window + 1))


class Settled:
    """The missing entries at which replacing them, with the same singular vectors, changes nothing any more.

    Replacing gives smoothed(v); it changes nothing where copies x (v - smoothed(v)) is 0 at every missing entry, a symmetric system.
    """

    def __init__(self, gap: np.ndarray, window: int, dense: int) -> None:
        n = len(gap)
        self.gap, self.window, self.weight = gap, window, copies(n, window)
        at = np.flatnonzero(gap)
        self.direct = len(at) <= dense
        if not self.direct:
            return
        # entry (i, i + d) of the projection summed over its copies: a stretch of diagonal d, by sums from its start on
        row, col = np.nonzero(np.abs(at[:, None] - at[None, :]) < window)
        i, d = np.minimum(at[row], at[col]), np.abs(at[row] - at[col])
        self.place, self.size = (row, col), len(at)
        self.to = d, np.minimum(i, window - 1 - d) + 1
        self.since = d, np.maximum(0, i - (n - window))
        self.own = np.where(d == 0, self.weight[i] * (1 + 1e-12), 0.0)
        j = np.arange(window)
        self.skew = np.minimum(j[None, :] + j[:, None], window), j[None, :]

    def __call__(self, v: np.ndarray, lead: np.ndarray) -> np.ndarray:
        gap, weight = self.gap, self.weight
        right = summed(np.where(gap, 0.0, v), lead)[gap]
        if self.direct:
            p = np.zeros((self.window + 1, self.window))
            p[:-1] = lead @ lead.T
            sums = np.zeros((self.window, self.window + 1))
            np.cumsum(p[self.skew], axis=1, out=sums[:, 1:])
            m = np.zeros((self.size, self.size))
            m[self.place] = self.own - (sums[self.to] - sums[self.since])
            return np.linalg.solve(m, right)
        full = np.zeros(len(v))

        def product(x: np.ndarray) -> np.ndarray:
            full[gap] = x
            return (weight * full - summed(full, lead))[gap]

        x = v[gap]
        r = right - product(x)
        p, rr = r.copy(), float(r @ r)
        least = 1e-20 * max(float(right @ right), 1e-300)
        for _ in range(2 * len(x)):
            if rr <= least:
                break
            q = product(p)
            step = rr / float(p @ q)
            x, r = x + step * p, r - step * q
            rr, old = float(r @ r), rr
            p = r + rr / old * p
        return x


def width(n: int, r: GridRules) -> int:
    """Columns of the Hankel matrix of n entries."""
    return min(r.window, n // 2)


def filled(v: np.ndarray, r: GridRules, settle: Settled | None = None) -> tuple[np.ndarray, bool]:
    """The series of impute, and whether it settled within the rounds. settle: that of another series with the same gaps."""
    gap = np.isnan(v)
    if not gap.any() or gap.all():
        return v, True
    at = np.arange(len(v))
    out = v.copy()
    out[gap] = np.interp(at[gap], at[~gap], v[~gap])
    window = width(len(v), r)
    rank = min(r.rank, window - 1)
    if rank < 1:
        return out, True
    mid = out.mean()
    out -= mid
    size = max(float(np.abs(out).max()), 1e-9)
    settled, settle = False, settle or Settled(gap, window, r.dense)
    for _ in range(r.rounds):
        lead = leading(out, window, rank)
        if np.abs((summed(out, lead) / settle.weight - out)[gap]).max() <= r.tolerance * size:
            settled = True
            break
        out[gap] = settle(out, lead)
    out += mid
    out[~gap] = v[~gap]
    return out, settled


def impute(v: np.ndarray, r: GridRules) -> np.ndarray:
    """NaN entries replaced; a series of three or fewer, which has no Hankel matrix to truncate, is filled by lines between the readings (ends held)."""
    return filled(v, r)[0]


def regularise(us: np.ndarray, values: np.ndarray, r: GridRules) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """slots, status (0 observed, 1 filled, 2 missing, 3 filled but not settled) and values (series x slots) of one record's readings.

    A slot strictly between two successive readings more than max_gap_us apart is missing. Equal times are averaged.
    """
    if len(us) == 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int8), np.zeros((len(values), 0))
    order = np.argsort(us, kind="stable")
    us, values = us[order], values[:, order]
    slots = np.arange(-(-us[0] // r.step_us), us[-1] // r.step_us + 1, dtype=np.int64)
    if len(slots) == 0:
        return slots, np.zeros(0, np.int8), np.zeros((len(values), 0))
    time = slots * r.step_us
    before = np.searchsorted(us, time, "right") - 1
    exact = us[before] == time
    after = np.minimum(before + 1, len(us) - 1)
    missing = ~exact & (us[after] - us[before] > r.max_gap_us)
    bucket = (us + r.step_us // 2) // r.step_us - slots[0]
    inside = (bucket >= 0) & (bucket < len(slots))
    count = np.bincount(bucket[inside], minlength=len(slots))
    grid = np.full((len(values), len(slots)), np.nan)
    has = count > 0
    for k, v in enumerate(values):
        grid[k, has] = np.bincount(bucket[inside], weights=v[inside], minlength=len(slots))[has] / count[has]
    grid[:, missing] = np.nan
    status = np.where(missing, 2, np.where(has, 0, 1)).astype(np.int8)
    # the stretches between long gaps are filled each by itself
    edges = np.flatnonzero(np.diff(missing.astype(np.int8))) + 1
    for lo, hi in zip(np.r_[0, edges], np.r_[edges, len(slots)], strict=True):
        if missing[lo]:
            continue
        gap = np.isnan(grid[0, lo:hi]) if len(values) else np.zeros(0, bool)
        shared = Settled(gap, width(hi - lo, r), r.dense) if gap.any() and not gap.all() and width(hi - lo, r) > 1 else None
        for k in range(len(values)):
            grid[k, lo:hi], settled = filled(grid[k, lo:hi], r, shared)
            if not settled:
                status[lo:hi][status[lo:hi] == 1] = 3
    return slots, status, grid


def regular_series(traj: DataFrame, rules: GridRules | None = None) -> DataFrame:
    """A slot row for every step_us of every record, from its first reading to its last.

    traj: traj_id, ride_id, timestamps, position, yaw (arrays of one length; longer ones are cut to the shortest). A reading
    has time, x, y and yaw all present and finite; times in ms are brought to seconds. Repeated traj_id count once. Records
    with null arrays or without readings give no rows; null traj_id is left out.

    Returns traj_id, ride_id, slot (time = slot x step_us since the epoch), status ('observed', 'filled', 'missing', 'unsettled': filled, but the
    limit of rounds was reached first), x, y, yaw (null where
    missing; yaw unwrapped).
    """
    r = rules or GridRules()
    rows = (
        traj.where("traj_id is not null and timestamps is not null and position is not null and yaw is not null")
        .select("traj_id", "ride_id", "timestamps", F.transform("position", lambda p: p["x"]).alias("x"), F.transform("position", lambda p: p["y"]).alias("y"), "yaw")
        .dropDuplicates(["traj_id"])
    )
    arrow = pa.schema([("traj_id", pa.int64()), ("ride_id", pa.int64()), ("slot", pa.int64()), ("status", pa.string()), ("x", pa.float64()), ("y", pa.float64()), ("yaw", pa.float64())])
    names = np.array(["observed", "filled", "missing", "unsettled"], object)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            col = lambda n: b.column(b.schema.get_field_index(n))  # noqa: B023, E731
            flat = {}
            for n in ("timestamps", "x", "y", "yaw"):
                a = col(n)
                flat[n] = (a.offsets.to_numpy(), a.values.to_numpy(zero_copy_only=False).astype(float))
            for i, (traj_id, ride_id) in enumerate(zip(col("traj_id").to_pylist(), col("ride_id").to_pylist(), strict=True)):
                parts = [v[o[i] : o[i + 1]] for o, v in flat.values()]
                n = min(map(len, parts))
                m = np.vstack([p[:n] for p in parts])
                m = m[:, np.isfinite(m).all(axis=0)]
                sec = np.where(np.abs(m[0]) >= 1e11, m[0] / 1000.0, m[0])
                us = np.floor(sec * 1e6 + 0.5).astype(np.int64)
                order = np.argsort(us, kind="stable")
                values = m[1:, order]
                values[2] = np.unwrap(values[2])
                slots, status, grid = regularise(us[order], values, r)
                for s in range(0, len(slots), 50_000):
                    e = slice(s, s + 50_000)
                    k = len(slots[e])
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(k, traj_id)), pa.array([ride_id] * k, pa.int64()), pa.array(slots[e]), pa.array(names[status[e]], pa.string()), *(pa.array(g[e], from_pandas=True) for g in grid)], schema=arrow)

    return rows.mapInArrow(run, GRID)


def missing_slots(traj: DataFrame, rules: GridRules | None = None) -> DataFrame:
    """traj_id, slot of the slots marked missing."""
    return regular_series(traj, rules).where("status = 'missing'").select("traj_id", "slot")
