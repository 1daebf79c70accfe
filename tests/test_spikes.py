from __future__ import annotations

import json

import numpy as np

from rovermill.operators import spikes
from rovermill.operators.spikes import ChartRules, compass_flags, compass_spikes, position_spikes, wheel_spikes

T0 = 1_325_376_000.0
CTL = "control_id long, ride_id long, rpm_1 double, rpm_2 double, rpm_3 double, rpm_4 double, timestamp double, own string, us string"


def wheels(n=300, ride=1):
    rng = np.random.default_rng(5)
    return [[i, ride, *(60 + rng.normal(0, 2, 4)).round(1).tolist(), T0 + i * 1.0, "a", "b"] for i in range(n)]


def test_wheels(spark):
    rows = wheels()
    rows[50][2] = 260.0
    rows[60][2], rows[61][2] = float("inf"), None
    rows[70][2] = 4294967295.0
    rows[80][4], rows[80][2] = None, -150.0
    for i in range(100, 112):
        rows[i][2] = 59.95
    for i in range(200, 209):  # nine equal ones are no case
        rows[i][2] = 59.15
    for i in range(230, 260):  # all wheels at rest
        rows[i][2:6] = [0.0] * 4
    rows += [rows[50][:]]
    got = {r.row_id for r in wheel_spikes(spark.createDataFrame(rows, CTL)).collect()}
    assert got == {50, 70, 80, *range(100, 112)}


def test_wheels_empty_and_null_keys(spark):
    assert wheel_spikes(spark.createDataFrame([], CTL)).count() == 0
    rows = [[None, 1, 9e9, 1.0, 1.0, 1.0, T0, "", ""], [1, None, 9e9, 1.0, 1.0, 1.0, T0, "", ""], [2, 1, 9e9, 1.0, 1.0, 1.0, None, "", ""]]
    assert wheel_spikes(spark.createDataFrame(rows, CTL)).count() == 0


def test_positions(spark):
    schema = "gps_id long, ride_id long, latitude double, longitude double, timestamp double, chunk int"
    rng = np.random.default_rng(2)
    rows = [[i, 1, 45 + i * 2e-5 + rng.normal(0, 5e-6), 7 + rng.normal(0, 5e-6), (T0 + 2 * i) * 1000, 0] for i in range(200)]
    rows[30][2] += 0.01
    rows[40][3] = 190.0
    rows[45][2], rows[45][3] = None, 500.0
    rows[46][2] = None
    rows[50][2], rows[50][3] = 0.0, 0.0
    for i in range(100, 108):
        rows[i][2:4] = rows[100][2:4]
    for i in range(150, 157):
        rows[i][2:4] = rows[150][2:4]
    got = {r.row_id for r in position_spikes(spark.createDataFrame(rows, schema)).collect()}
    assert got == {30, 40, 45, 50, *range(100, 108)}
    assert position_spikes(spark.createDataFrame([], schema)).count() == 0


def test_compass(spark):
    rng = np.random.default_rng(4)
    cell = lambda: [[900 + int(rng.integers(-20, 20)), 1200 + int(rng.integers(-20, 20)), -300 + int(rng.integers(-20, 20)), 1.0 + k] for k in range(5)]
    cells = [cell() for _ in range(40)]
    cells[10][2][0] = 32767
    cells[12] = [[0, 0, 0, 1.0]]
    for i in (20, 21, 22):
        cells[i] = [[905, 1203, -301, float(k)] for k in range(3)]
    for i in (30, 31):
        cells[i] = [[907, 1203, -301, float(k)] for k in range(3)]
    rows = [(i, 1, json.dumps(c)) for i, c in enumerate(cells)] + [(50, 1, None), (51, 1, "[[1,2"), (52, 1, "[]"), (53, None, "[[0,0,0,1]]")]
    got = {r.row_id for r in compass_spikes(spark.createDataFrame(rows, "imu_id long, ride_id long, compass string")).collect()}
    assert got == {10, 12, 20, 21, 22}


def test_compass_cells_of_few_samples():
    """The upright axis of a cell of one or two samples is held against the cells around; a turn and back is no spike."""
    cell = lambda x, h, n: np.array([[x, 1000 * np.cos(h), 1000 * np.sin(h), k] for k in range(n)]) + np.arange(n)[:, None]
    cells = [cell(300, 0.3 + 0.01 * i, 1 + i % 2) for i in range(60)]
    cells[20], cells[41], cells[50] = cell(600, 0.5, 1), cell(20, 0.7, 2), cell(300, 1.5, 1)
    assert np.flatnonzero(compass_flags(cells, ChartRules())).tolist() == [20, 41]


def test_the_charts_decide(monkeypatch):
    """Without the charts no spike is flagged that is neither impossible nor stuck: not in positions, not in the compass, not in wheels."""
    rng = np.random.default_rng(2)
    t = T0 + 2.0 * np.arange(200)
    lat, lon = 45 + np.arange(200) * 2e-5 + rng.normal(0, 5e-6, 200), 7 + rng.normal(0, 5e-6, 200)
    lat[30] += 0.001
    cells = [np.c_[900 + rng.integers(-20, 20, 5), 1200 + rng.integers(-20, 20, 5), -300 + rng.integers(-20, 20, 5), np.arange(5)].astype(float) for _ in range(40)]
    cells[10][2, 2] += 400
    w = 60 + rng.normal(0, 2, (4, 200))
    w[0, 70] = 140
    flagged = lambda: (spikes.position_flags(t, lat, lon, ChartRules()), compass_flags(cells, ChartRules()), spikes.rpm_flags(t, w, ChartRules()))
    assert [np.flatnonzero(f).tolist() for f in flagged()] == [[30], [10], [70]]
    monkeypatch.setattr(spikes, "ew_chart", lambda r, *_: np.zeros(len(r), bool))
    assert not any(f.any() for f in flagged())


def test_limits_follow_what_is_normal_for_the_source():
    """Fixes that wander wide widen their own chart; a clipped spike does not."""
    rng = np.random.default_rng(7)
    calm, wild = np.abs(rng.normal(0, 1, 500)), np.abs(rng.normal(0, 12, 500))
    r, floor, use = ChartRules(), np.full(500, 2.0), np.ones(500, bool)
    for v in (calm, wild):
        v[250] = 70.0
    assert np.flatnonzero(spikes.ew_chart(calm, floor, use, r, 20.0)).tolist() == [250]
    assert spikes.ew_chart(wild, floor, use, r, 20.0).sum() <= 1
    calm[251:255] = 70.0
    assert np.flatnonzero(spikes.ew_chart(calm, floor, use, r, 20.0)).tolist() == [250, 251, 252, 253, 254]
