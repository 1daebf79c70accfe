"""Hand-worked vectors of kinematics, smoothing, resampling and the filter."""

from __future__ import annotations

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from rovermill.functions import geo
from rovermill.functions.kinematics import RPM, crop_box, wheel_speed
from rovermill.operators import ekf, flow, resample, signal
from rovermill.operators.sequences import chunked, previous
from rovermill.plans.reference import QUERIES, integrate
from rovermill.sources import files
from rovermill.sources.video import crop_and_scale


def test_wheels(spark):
    v, w = wheel_speed(*(F.lit(float(x)) for x in (60, 90, 60, 90)), RPM)
    r = spark.range(1).select(v.alias("v"), w.alias("w")).first()
    assert r.v == pytest.approx(0.510509, abs=1e-6) and r.w == pytest.approx(0.667332, abs=1e-6)


def test_integration(spark):
    rows = [(1, i * 1_000_000, i, 1.0, math.pi / 2 if i == 1 else 0.0) for i in range(4)]
    p = previous(chunked(spark.createDataFrame(rows, "ride_id long, us long, control_id long, v double, w double"), 1_500_000), ["us", "v", "w"])
    p = p.select("ride_id", "chunk", "us", "control_id", ((F.col("us") - F.col("prev.us")) / 1e6).alias("dt"), F.col("prev.v").alias("v"), F.col("prev.w").alias("w"))
    out = [(r.x, r.y, r.theta) for r in integrate(p).orderBy("us").collect()][1:]
    assert np.allclose(out, [(1, 0, 0), (1, 1, math.pi / 2), (1, 2, math.pi / 2)])


def test_gaussian(spark):
    k = signal.gaussian_kernel(1.5)
    assert len(k) == 13 and np.allclose(k[6:], [0.265964257, 0.212967529, 0.109341175, 0.035994348, 0.007597402, 0.001028197, 0.000089221], atol=1e-9)
    df = spark.createDataFrame([(1, i, v) for i, v in enumerate([0.0, 0.0, 9.0, 0.0, 0.0])], "ride_id long, seq long, a double")
    out = [r.a_smooth for r in signal.smooth(df, ["a"], 1.5).orderBy("seq").collect()]
    assert np.allclose(out, [1.30802, 1.985887, 2.412186, 1.985887, 1.30802], atol=1e-6)


def test_smoothing_across_blocks(spark):
    rng = np.random.default_rng(0)
    v = rng.normal(size=90)
    df = spark.createDataFrame([(1, i, float(x)) for i, x in enumerate(v)], "ride_id long, seq long, a double")
    a, b = ([r.a_smooth for r in signal.smooth(df, ["a"], 1.5, span=s).orderBy("seq").collect()] for s in (16, 1000))
    want = np.convolve(np.pad(v, 6, mode="symmetric"), signal.gaussian_kernel(1.5), "valid")
    assert np.allclose(a, want) and np.allclose(b, want)


def records(spark, n, flag, name):
    return spark.createDataFrame([(1, i, i * 1_000_000, i in flag) for i in range(n)], f"traj_id long, idx long, us long, {name} boolean")


def test_segment_strides(spark):
    idx = lambda df: [r.idx for r in df.orderBy("idx").collect()]
    assert idx(resample.by_segment(records(spark, 10, {3, 4, 5, 6}, "straight"), 3)) == [0, 3, 6, 7]
    assert idx(resample.by_segment(records(spark, 10, {7, 8, 9}, "straight"), 3)) == [0, 4, 7, 9]
    assert idx(resample.every(records(spark, 5, set(), "straight"), 2)) == [0, 2, 4]
    assert idx(resample.by_segment(records(spark, 1, {0}, "straight"), 3)) == [0]


def test_pauses(spark):
    df = records(spark, 14, {4, 5, 6}, "paused")
    r = resample.runs_of(df, "paused").first()
    assert (r.start_idx, r.end_idx, (r.end_us - r.start_us) / 1e6) == (4, 7, 3.0)
    assert resample.runs_of(df.limit(0), "paused").count() == 0


def controls(spark, n, still):
    """Four control rows a second, odometry rows at every fourth of them."""
    c = spark.createDataFrame([(1, i, i * 250_000, i in still) for i in range(n)], "traj_id long, cidx long, us long, still boolean")
    near = spark.createDataFrame([(1, i, 4 * i) for i in range(-(-n // 4))], "traj_id long, idx long, cidx long")
    return near, c


def test_pauses_of_control_rows(spark):
    # still from 15 to 26: odometry row 4 (control row 16) is the first in it, control row 27 moves, nearest to odometry row 7
    near, c = controls(spark, 80, set(range(15, 27)) | {41, 42})
    r = resample.pauses(near, c).collect()
    assert [(q.start_idx, q.end_idx, q.start_cidx, q.end_cidx, (q.end_us - q.start_us) / 1e6) for q in r] == [(4, 7, 16, 27, 2.75)]
    gone = resample.removed(resample.pauses(near, c))
    assert sorted(q.idx for q in gone.collect()) == [4, 5, 6]
    kept = resample.renumbered(near.join(gone, ["traj_id", "idx"], "left_anti")).orderBy("new_idx").collect()
    assert [(q.new_idx, q.idx) for q in kept] == list(enumerate([0, 1, 2, 3, *range(7, 20)]))
    # a pause up to the end ends at the last control row
    near, c = controls(spark, 48, set(range(30, 48)))
    assert [(q.start_idx, q.end_idx, q.end_cidx) for q in resample.pauses(near, c).collect()] == [(8, 11, 47)]
    assert resample.renumbered(near.where("idx < 9")).count() == 0
    assert resample.pauses(near.limit(0), c.limit(0)).count() == 0


def test_scanned_pauses_keep_their_quirks(spark):
    # two pauses with one row between: that row's data is the row its pause began at
    near, c = controls(spark, 80, set(range(15, 27)) | set(range(30, 43)))
    rows = resample.scanned(near, c).orderBy("new_idx").collect()
    data, images = [r.idx for r in rows if r.idx is not None], [r.image_idx for r in rows if r.image_idx is not None]
    assert data == [0, 1, 2, 3, 8, *range(11, 20)] and images == [0, 1, 2, 3, 7, *range(11, 20)]
    # the row a pause ends at is not tested again
    near, c = controls(spark, 80, set(range(16, 26)) | {28, 29, 30, 31, 32, 33})
    assert [r.idx for r in resample.scanned(near, c).orderBy("new_idx").collect()] == [0, 1, 2, 3, *range(7, 20)]


def test_scanned_pauses_that_go_round_end(spark):
    # row 15 has a time out of order: its pause is the one of row 3 and leads back there, from where the scan would come to row 15 again
    near, c = controls(spark, 80, set(range(9, 13)) | set(range(28, 34)))
    near = near.withColumn("cidx", F.when(F.col("idx") == 15, 10).otherwise(F.col("cidx")))
    rows = resample.scanned(near, c).orderBy("new_idx").collect()
    assert [r.idx for r in rows] == [r.image_idx for r in rows] == [*range(7), *range(8, 20)]
    # back to row 3, where no pause ended before, the scan goes once and keeps those rows twice; it ends as row 7 leads to row 8 again
    near = near.withColumn("cidx", F.when(F.col("idx") == 3, 16).otherwise(F.col("cidx")))
    rows = resample.scanned(near, c).orderBy("new_idx").collect()
    data, images = [r.idx for r in rows if r.idx is not None], [r.image_idx for r in rows if r.image_idx is not None]
    assert data == [*range(7), *range(8, 15), *range(3, 20)] and images == [*range(7), *range(8, 20)]


def krueger(lat, lon, zone):
    """UTM by the sixth-order series in the third flattening (conformal latitude, then complex sines): another derivation than the operator's."""
    a, f = 6378137.0, 1 / 298.257223563
    n, e = f / (2 - f), math.sqrt(f * (2 - f))
    radius = a / (1 + n) * (1 + n**2 / 4 + n**4 / 64 + n**6 / 256)
    alpha = [
        n / 2 - 2 * n**2 / 3 + 5 * n**3 / 16 + 41 * n**4 / 180 - 127 * n**5 / 288 + 7891 * n**6 / 37800,
        13 * n**2 / 48 - 3 * n**3 / 5 + 557 * n**4 / 1440 + 281 * n**5 / 630 - 1983433 * n**6 / 1935360,
        61 * n**3 / 240 - 103 * n**4 / 140 + 15061 * n**5 / 26880 + 167603 * n**6 / 181440,
        49561 * n**4 / 161280 - 179 * n**5 / 168 + 6601661 * n**6 / 7257600,
        34729 * n**5 / 80640 - 3418889 * n**6 / 1995840,
        212378941 * n**6 / 319334400,
    ]
    p, l = math.radians(lat), math.radians(lon - (6 * zone - 183))
    t = math.sinh(math.atanh(math.sin(p)) - e * math.atanh(e * math.sin(p)))
    xi, eta = math.atan2(t, math.cos(l)), math.asinh(math.sin(l) / math.hypot(t, math.cos(l)))
    north = xi + sum(c * math.sin(2 * j * xi) * math.cosh(2 * j * eta) for j, c in enumerate(alpha, 1))
    east = eta + sum(c * math.cos(2 * j * xi) * math.sinh(2 * j * eta) for j, c in enumerate(alpha, 1))
    return 500_000 + 0.9996 * radius * east, 0.9996 * radius * north + (10_000_000 if lat < 0 else 0)


def test_utm(spark):
    # a published example of a public geodesy library: 33.3 N 44.4 E lies at 444140.54 E 3684706.36 N in zone 38
    assert np.allclose(krueger(33.3, 44.4, 38), (444140.54, 3684706.36), atol=0.006)
    rng = np.random.default_rng(4)
    rows = [(33.3, 44.4), (0.0, 0.0), (-33.9, 151.2), (51.5, -0.0001), (45.0, 5.9999), (45.0, 6.0), (-79.9, 12.3), (83.9, -170.0), *[(float(a), float(b)) for a, b in zip(rng.uniform(-79, 83, 200), rng.uniform(-179, 179, 200), strict=True)]]
    z = spark.createDataFrame(rows, "latitude double, longitude double").withColumn("zone", F.expr(geo.zone("latitude", "longitude")))
    e, n = geo.utm("latitude", "longitude", "zone")
    for r in z.select("*", F.expr(e).alias("e"), F.expr(n).alias("n")).collect():
        want = krueger(r.latitude, r.longitude, r.zone)
        assert abs(r.e - want[0]) < 0.001 and abs(r.n - want[1]) < 0.001, (r, want)


def test_crop():
    assert crop_box(1024, 576) == (128, 0, 896, 576, 384, 288)
    left, top, right, bottom, w, h = crop_box(100, 90)
    assert left >= 0 and top >= 0 and right <= 100 and bottom <= 90 and w > 0 and h > 0
    assert crop_and_scale(np.zeros((576, 1024, 3), np.uint8)).shape == (288, 384, 3)


def test_files(spark, tmp_path):
    d = tmp_path / "out" / "ride_12_20240102030405"
    d.mkdir(parents=True)
    (d / "front_camera_timestamps_12.csv").write_text("frame_id,timestamp\n1,5.5\nx,6\n")
    rows = files.read_stream(spark, str(tmp_path), "front_camera_timestamps").collect()
    assert [(r.ride_id, r.frame_id, r.timestamp) for r in rows] == [(12, 1, 5.5), (12, None, 6.0)]
    (d / "a.jpg").write_bytes(b"abc")
    b = files.read_binary(spark, str(tmp_path), "*.jpg").withColumn("u", files.data_url(F.col("content"))).first()
    assert b.ride_id == 12 and b.u == "data:image/jpeg;base64,YWJj"
    lists = spark.createDataFrame([("p", "#EXTM3U\r\n#EXTINF:1,\na.ts\n\nb.ts\n"), ("q", None), ("r", "#x")], "path string, content string")
    assert [(r.path, r.segment_idx, r.uri) for r in files.playlist_segments(lists).collect()] == [("p", 0, "a.ts"), ("p", 1, "b.ts")]
    (tmp_path / "m.csv").write_text("url\nhttp://h/x/y.zip\n")
    assert files.read_manifest(spark, str(tmp_path / "m.csv")).first().file == "y.zip"


def test_filter_step_against_matrices():
    rng = np.random.default_rng(1)
    r = ekf.FilterRules()
    st, s, p = ekf.State(r), np.zeros(3), np.eye(3)
    for v, w, dt, x, y in rng.normal(size=(40, 5)):
        st.step(v, w, dt, x, y)
        th = s[2]
        s = s + [v * np.cos(th) * dt, v * np.sin(th) * dt, w * dt]
        f = np.array([[1, 0, -v * np.sin(th) * dt], [0, 1, v * np.cos(th) * dt], [0, 0, 1]])
        p = f @ p @ f.T + r.process * np.eye(3)
        k = p[:, :2] @ np.linalg.inv(p[:2, :2] + r.measure * np.eye(2))
        s, p = s + k @ (np.array([x, y]) - s[:2]), p - k @ p[:2]
        assert np.allclose(st.s, s) and np.allclose(st.p, p[np.triu_indices(3)])


@pytest.mark.parametrize("name", ["ref_w05_integrate", "ref_w05b_wheels"])
def test_integration_keeps_rows_of_impossible_rpm(spark, tmp_path, name):
    """Every finite row counts, whatever its rpm_1: against plain loops over three rows a ride."""
    rows = [(3 * k + i, k, 100.0 + i, 0.5, 0.2, 4e9 if (k, i) == (1, 1) else 30.0, 30.0, 30.0, 30.0) for k in range(2) for i in range(4)]
    rows = [(n, *r[1:]) for n, r in enumerate(rows)]
    df = spark.createDataFrame(rows, "control_id long, ride_id long, timestamp double, linear double, angular double, rpm_1 double, rpm_2 double, rpm_3 double, rpm_4 double")
    df.write.parquet(str(tmp_path / "control_data.parquet"))
    want, wheel = {}, math.pi * RPM.wheel_m / 60.0
    for ride in range(2):
        mine, x, y, th = [r for r in rows if r[1] == ride], 0.0, 0.0, 0.0
        for a, b in zip(mine, mine[1:], strict=False):
            left, right = (b[5] + b[7]) * wheel, (b[6] + b[8]) * wheel
            v, w = ((right + left) / 2, (right - left) / RPM.track_m) if name == "ref_w05b_wheels" else (a[3] * RPM.linear_gain, a[4] * RPM.angular_gain)
            th += w * (b[2] - a[2])
            x, y = x + v * math.cos(th) * (b[2] - a[2]), y + v * math.sin(th) * (b[2] - a[2])
            want[b[0]] = (x, y, th)
    got = {r.control_id: (r.x, r.y, r.theta) for r in QUERIES[name](spark, str(tmp_path)).collect()}
    assert got.keys() == want.keys()
    for k, v in want.items():
        assert got[k] == pytest.approx(v, rel=1e-6, abs=0.01)


def test_all_lags_and_alignment(spark, tmp_path):
    """200 lags against numpy; a ride whose wheels run 30 rows late is shifted by that, one without relation is kept."""
    rng = np.random.default_rng(5)
    b = np.convolve(rng.normal(size=304), np.ones(5) / 5, "valid")
    late, other = np.r_[rng.normal(size=30) / 9, b[:-30]] * 40, rng.normal(size=300)
    rows = [(1000 * ride + i, ride, 100.0 + i, float(b[i]), 0.0, *[float(a[i])] * 4) for ride, a in ((1, late), (2, other)) for i in range(300)]
    df = spark.createDataFrame(rows, "control_id long, ride_id long, timestamp double, linear double, angular double, rpm_1 double, rpm_2 double, rpm_3 double, rpm_4 double")
    df.write.parquet(str(tmp_path / "control_data.parquet"))
    got = {(r.ride_id, r.lag): r.r for r in QUERIES["ref_a13_all_lags"](spark, str(tmp_path)).collect()}
    assert got.keys() == {(k, s) for k in (1, 2) for s in range(-100, 100)}
    for (k, s), r in got.items():
        a = late if k == 1 else other
        x, y = (a[s:], b[: 300 - s]) if s >= 0 else (a[:s], b[-s:])
        assert r == pytest.approx(np.corrcoef(x, y)[0, 1], abs=1e-5)
    out = QUERIES["ref_w15_aligned"](spark, str(tmp_path)).collect()
    one, two = ([r for r in out if r.ride_id == k] for k in (1, 2))
    assert len(one) == 270 and all(r.seq == r.control_id - 1000 + 30 and r.rpm_1 == pytest.approx(40 * r.linear) for r in one)
    assert len(two) == 300 and all(r.seq == r.control_id - 2000 for r in two)


def events_of(rng, n=400, m=150, ride=1):
    """Control rows and positions at irregular times, some of equal time, with pauses in both."""
    ct = np.round(np.cumsum(rng.choice([0.1, 0.2, 1.0, 9.0], n, p=[0.5, 0.4, 0.09, 0.01])), 1)
    gt = np.round(np.cumsum(rng.choice([0.3, 0.6, 5.0], m, p=[0.6, 0.35, 0.05])) + rng.choice([-5.0, 0.0, 5.0]), 1) + 0.03
    v = np.where(rng.random(n) < 0.2, 0.0, rng.normal(1, 0.2, n))
    w = np.where(v == 0, 0.0, rng.normal(0, 0.1, n))
    rows = [(ride, int(round(t * 1e6)), 1, i, float(a), float(b), 0.0, 0.0) for i, (t, a, b) in enumerate(zip(ct, v, w, strict=True))]
    rows += [(ride, int(round(t * 1e6)), 0, i, 0.0, 0.0, float(i), float(i % 7)) for i, t in enumerate(gt)]
    return rows, (ct, v, w, gt, np.arange(m) * 1.0, np.arange(m) % 7 * 1.0)


def by_rows(ct, v, w, gt, gx, gy, r):
    """The pass as the inventory states it, over whole arrays, with the filter step of the operator."""
    a = int(np.argmin(np.abs(ct - gt[0])))
    first = g = int(np.argmin(np.abs(gt - ct[a])))
    st, out = ekf.State(r), [(0.0, 0.0, 0.0, ct[a])]
    for i in range(a + 1, len(ct) - a):
        if g >= len(gt):
            break
        d, used = ct[i] - gt[g], False
        if not (r.far_first and d >= r.near_s):
            if 0 < d < r.near_s or g == first:
                used = True
                if v[i] or w[i]:
                    st.step(v[i], w[i], ct[i] - ct[i - 1], gx[g] - gx[first], gy[g] - gy[first])
                out.append((*st.s, ct[i]))
                g += 1
                if not (v[i] or w[i]):
                    continue
        if d >= r.near_s:
            out.append((*st.s, ct[i]))
            g += 1
        assert used or d >= r.near_s or d <= 0
    return np.array(out)


@pytest.mark.parametrize("far_first", [False, True])
def test_folded_filter_over_whole_rides(spark, far_first):
    r = ekf.FilterRules(far_first=far_first)
    rows, want = [], {}
    for ride in range(1, 9):
        mine, arrays = events_of(np.random.default_rng(ride), ride=ride)
        rows += mine
        want[ride] = by_rows(*arrays, r)
        assert np.allclose(ekf.run_filter(*arrays, r), want[ride], atol=1e-7)
    rows += [(99, 5, 1, 1, 1.0, 0.0, 0.0, 0.0), (98, 5, 0, 1, 0.0, 0.0, 1.0, 1.0)]
    df = spark.createDataFrame(rows, "ride_id long, us long, kind int, id long, v double, w double, x double, y double")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "37")
    try:
        got = ekf.filtered_track(df, r).orderBy("ride_id", "idx").toPandas()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert set(got.ride_id) == set(want)
    for ride, g in got.groupby("ride_id"):
        assert np.allclose(np.c_[g.x, g.y, g.heading, g.us / 1e6], want[ride], atol=1e-5)


def test_flow(spark):
    pts = [(1, 1, 100, 2.0, 0.0), (1, 1, 100, 4.0, 1.0), (1, 1, 100, None, 9.0), (1, 2, 200, None, None), (2, 1, 100, 1.0, 1.0)]
    f = flow.mean_flow(spark.createDataFrame(pts, "ride_id long, frame_id long, us long, dx double, dy double"))
    assert {(r.ride_id, r.frame_id): (r.dx, r.dy) for r in f.collect()} == {(1, 1): (3.0, 0.5), (1, 2): (0.0, 0.0), (2, 1): (1.0, 1.0)}
    c = spark.createDataFrame([(1, 10, 90), (1, 11, 100), (1, 12, 101), (1, 13, 201), (3, 14, 1)], "ride_id long, control_id long, us long")
    assert {(r.control_id, r.dx) for r in flow.flow_at_controls(f, c).collect()} == {(10, 3.0), (11, 3.0), (12, 0.0)}
    assert flow.flow_at_controls(f.limit(0), c).count() == 0
