from __future__ import annotations

import numpy as np
import pytest

from rovermill.llm.event_runs import RunRules, anchored_runs, anchors, collapsed, equal_runs, leaving

COLS = "control_id long, ride_id long, linear double, angular double, timestamp double, chunk int, n string"
T0 = 1_325_376_000.0


def brute(rows, least=3):
    """Row by row, in whole thousandths and microseconds."""
    seen, use = set(), []
    for i, ride, a, b, t, *_ in rows:
        if i in seen or None in (i, ride, a, b, t) or not np.isfinite([a, b, t]).all():
            continue
        seen.add(i)
        whole = lambda v: int(np.sign(v) * np.floor(abs(v) * 1000 + 0.5))
        use.append((ride, int(np.floor(t * 1e6 + 0.5)), i, whole(a), whole(b)))
    out, cur = [], None
    for ride, us, i, a, b in sorted(use):
        if cur and cur[0] == ride and us - cur[1] <= 10_000_000 and abs(a - cur[3]) <= 20 and abs(b - cur[4]) <= 20:
            cur = (ride, us, i, cur[3], cur[4], cur[5], cur[6] + 1)
        else:
            if cur and cur[6] >= least:
                out.append((cur[5], cur[2]))
            cur = (ride, us, i, a, b, i, 1)
    if cur and cur[6] >= least:
        out.append((cur[5], cur[2]))
    return sorted(out)


def random_rows(n=3000, seed=0):
    """Slow drifts without hard steps, so runs and open heads cross the borders of many chunks; one ride holds most rows."""
    rng = np.random.default_rng(seed)
    rows, t, a = [], T0, 0.0
    for i in range(n):
        t += float(rng.choice([0.0, 0.5, 1.0, 9.9, 10.0, 10.1], p=[0.05, 0.45, 0.44, 0.02, 0.02, 0.02]))
        a += float(rng.normal(0, 0.004)) if rng.random() > 0.02 else 0.05
        rows.append((i, 1 if i % 17 else 2, round(a, 3), 0.0, t, 0, "x"))
    return rows


def test_against_brute_force_over_many_chunks(spark):
    rows = random_rows()
    for chunk_s in (30, 3600):
        got = anchored_runs(spark.createDataFrame(rows, COLS), RunRules(chunk_s=chunk_s)).collect()
        assert sorted((r.first_id, r.last_id) for r in got) == brute(rows)


def test_edges(spark):
    bad = [(900, 1, None, 0.0, T0, 0, ""), (901, 1, float("nan"), 0.0, T0, 0, ""), (902, 1, float("inf"), 0.0, T0, 0, ""), (903, 1, 0.0, 0.0, None, 0, ""), (904, None, 0.0, 0.0, T0, 0, ""), (None, 1, 0.0, 0.0, T0, 0, "")]
    good = [(1, 1, 0.5, 0.0, T0, 0, ""), (2, 1, 0.52, 0.0, T0 + 10, 0, ""), (3, 1, 0.48, -0.02, T0 + 20, 0, ""), (4, 1, 0.5, 0.021, T0 + 21, 0, ""), (5, 1, 0.5, 0.0, T0 + 21, 0, "")]
    df = spark.createDataFrame(bad + good + good[:2], COLS)
    r = anchored_runs(df).collect()
    assert [(x.first_id, x.last_id, x.n, x.duration_s) for x in r] == [(1, 3, 3, 20.0)]
    assert anchored_runs(df.limit(0)).count() == 0 and equal_runs(df.limit(0)).count() == 0


def test_equal_runs_cross_chunks(spark):
    rows = [(i, 1, 0.5, 0.0, T0 + i * 60.0, 0, "") for i in range(50)] + [(50, 1, 0.6, 0.0, T0 + 3000.0, 0, "")]
    got = sorted((r.first_id, r.last_id, r.n) for r in equal_runs(spark.createDataFrame(rows, COLS), RunRules(chunk_s=300)).collect())
    assert got == [(0, 49, 50), (50, 50, 1)]


def drift(n, seed, step):
    """Both commands wander by less than twice the tolerance a row, every second: no row begins a run whatever came before."""
    rng = np.random.default_rng(seed)
    a, b = (np.cumsum(rng.integers(-step, step + 1, n)) / 1000 for _ in range(2))
    return [(i, 1, float(a[i]), float(b[i]), T0 + i, 0, "x") for i in range(n)]


@pytest.mark.parametrize("step", [1, 6, 20])
def test_drift_without_a_sure_start(spark, step):
    rows = drift(1500, step, step)
    for chunk_s in (7, 100):
        got = anchored_runs(spark.createDataFrame(rows, COLS), RunRules(chunk_s=chunk_s)).collect()
        assert sorted((r.first_id, r.last_id) for r in got) == brute(rows)


def test_leaving_tables_are_bounded_and_exact():
    for step in (1, 3, 10):
        rows = drift(2000, step, step)
        lin, ang = (np.array([round(r[k] * 1000) for r in rows]) for k in (2, 3))
        boxes = np.array(leaving(lin, ang, 20)).reshape(-1, 6)
        assert len(boxes) <= 82
        rng = np.random.default_rng(0)
        for a, b in rng.integers(-25, 26, (60, 2)).tolist():
            out = np.flatnonzero((boxes[:, 0] > a) | (boxes[:, 1] < a) | (boxes[:, 2] > b) | (boxes[:, 3] < b))
            want = anchors(lin.tolist(), ang.tolist(), [0] * len(lin), (a, b, 0), 20)[-1]
            assert (tuple(boxes[out[0], 4:]) if len(out) else (a, b)) == want


def test_three_days_at_rest_are_one_event_a_chunk(spark):
    n = 3 * 86_400
    df = spark.range(n).selectExpr("id as control_id", "1L as ride_id", "0D as linear", "0.1D as angular", f"{T0} + id as timestamp")
    events = collapsed(df, RunRules())
    assert events.count() == 72 and events.groupBy("ride_id", "chunk").count().agg({"count": "max"}).first()[0] == 1
    assert [(r.first_id, r.last_id, r.n, r.duration_s) for r in anchored_runs(df).collect()] == [(0, n - 1, n, n - 1.0)]
