from __future__ import annotations

import numpy as np

from rovermill.operators.trips import StopRules, found_stops, stops_and_trips

COLS = "gps_id long, ride_id long, latitude double, longitude double, timestamp double, chunk string, kind string"
T0 = 1_325_376_000.0


def track(phases, ride=1, first=1, seed=0, step=3.0):
    """phases: (seconds, speed in m/s); noise of 1 m; clashing extra columns."""
    rng = np.random.default_rng(seed)
    rows, t, x, i = [], 0.0, 0.0, first
    for length, speed in phases:
        end = t + length
        while t < end:
            rows.append((i, ride, 45.0 + (x + rng.normal(0, 1)) / 110_540, 7.0 + rng.normal(0, 1) / 78_700, (T0 + t) * 1000, "x", "y"))
            i += 1
            t += step
            x += speed * step
    return rows


def test_stop_between_trips(spark):
    rows = track([(120, 1.2), (200, 0), (120, 1.2), (60, 0), (90, 1.2)])
    # nulls, NaN, impossible, far-off fixes and repeats change nothing
    bad = [(900, 1, None, 7.0, (T0 + 200.5) * 1000), (901, 1, float("nan"), 7.0, (T0 + 210.5) * 1000), (902, 1, 45.0, 720.0, (T0 + 220.5) * 1000), (903, 1, 45.3, 7.0, (T0 + 230.5) * 1000), (904, 1, 45.0, 7.0, None), (905, None, 45.0, 7.0, T0 * 1000)]
    rows += [(*b, "x", "y") for b in bad] + rows[10:20]
    out = stops_and_trips(spark.createDataFrame(rows, COLS)).orderBy("start_us").collect()
    assert [r.kind for r in out] == ["trip", "stop", "trip"]
    stop = out[1]
    assert abs(stop.start_us / 1e6 - T0 - 120) <= 9 and abs(stop.duration_s - 200) <= 15
    assert abs(out[0].distance_m - 144) < 60


def test_stop_longer_than_chunks_is_one(spark):
    r = StopRules(chunk_s=600, halo_s=300)
    rows = track([(300, 1.2), (4000, 0), (300, 1.2)])
    out = stops_and_trips(spark.createDataFrame(rows, COLS), r).where("kind = 'stop'").collect()
    assert len(out) == 1 and abs(out[0].duration_s - 4000) < 20
    assert len(stops_and_trips(spark.createDataFrame(rows, COLS)).where("kind = 'stop'").collect()) == 1


def test_silence_ends_a_stop(spark):
    a = track([(200, 0)])
    b = [(g + 1000, r, la, lo, t + 900_000, c, k) for g, r, la, lo, t, c, k in a]
    assert found_stops(spark.createDataFrame(a + b, COLS)).count() == 2
    c = [(g + 1000, r, la, lo, t + 500_000, c, k) for g, r, la, lo, t, c, k in a]
    assert found_stops(spark.createDataFrame(a + c, COLS)).count() == 1


def test_slow_driving_is_no_stop_and_empty(spark):
    assert found_stops(spark.createDataFrame(track([(400, 0.4)]), COLS)).count() == 0
    assert found_stops(spark.createDataFrame([], COLS)).count() == 0
