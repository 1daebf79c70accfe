"""Compaction, regular grids and nested cells."""

from __future__ import annotations

import json
import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from rovermill.functions.cells import number, read_cell
from rovermill.operators import compaction as c
from rovermill.operators import nested
from rovermill.operators.regular_grid import GridRules, filled, hankel_smooth, impute, missing_slots, regular_series
from rovermill.runtime import file_system, shared_dir

REC = "rec_id long, ride_id long, stream string, payload string, timestamp string"


def test_compact_round_trip_and_replace(spark):
    df = spark.range(0, 5000).select((F.col("id") % 7).alias("k"), F.when(F.col("id") % 3 > 0, F.col("id")).alias("v"), F.lit("s").alias("s"))
    df = df.unionByName(df.limit(100))  # repeated rows stay repeated
    path = shared_dir(spark, "t") + "/x"
    done = c.compact(df, ["k", "v"], path, target_bytes=20_000)
    assert done.rows == 5100 and done.files > 1
    back = spark.read.parquet(path)
    assert back.exceptAll(df).count() == 0 and df.exceptAll(back).count() == 0
    local = path.replace("file:", "").replace("//", "/")
    files = [f for f in os.listdir(local) if f.startswith("part")]
    assert len(files) <= done.files
    # ranges of files don't overlap
    ends = sorted((r.a, r.b) for r in back.groupBy(F.input_file_name()).agg(F.min("k").alias("a"), F.max("k").alias("b")).collect())
    assert all(x[1] <= y[0] for x, y in zip(ends, ends[1:], strict=False))
    assert c.compact(df.limit(10), ["k"], path).rows == 10 and spark.read.parquet(path).count() == 10
    assert c.compact(df.limit(0), ["k"], path).rows == 0


def test_failed_reconciliation_keeps_the_old_folder(spark, monkeypatch):
    path = shared_dir(spark, "t") + "/x"
    c.compact(spark.range(5).toDF("a"), ["a"], path)
    calls = []
    real = c.checksum
    monkeypatch.setattr(c, "checksum", lambda df: calls.append(1) or ((F.lit(len(calls)).alias("n"), real(df)[1])))
    with pytest.raises(c.ReconcileError):
        c.compact(spark.range(9).toDF("a"), ["a"], path)
    assert spark.read.parquet(path).count() == 5


def test_a_crash_between_the_renames_is_mended(spark):
    path = shared_dir(spark, "t") + "/x"
    c.compact(spark.range(5).toDF("a"), ["a"], path)
    fs, at = file_system(spark, path)
    old = file_system(spark, path + ".old")[1]
    assert fs.rename(at, old)
    c.recover(spark, path)
    assert spark.read.parquet(path).count() == 5 and not fs.exists(old)
    # the next swap mends it as well, and drops what a finished swap left
    assert fs.rename(at, old)
    c.compact(spark.range(7).toDF("a"), ["a"], path)
    assert spark.read.parquet(path).count() == 7 and not fs.exists(old)
    spark.range(3).write.parquet(path + ".old")
    c.recover(spark, path)
    assert spark.read.parquet(path).count() == 7 and not fs.exists(old)


def test_small_tables_are_written_in_several_ranges(spark):
    path = shared_dir(spark, "t") + "/x"
    done = c.compact_recordings(spark.read.parquet("/root/testdata/sf0.01/recordings.parquet"), path)
    assert done.files > 1
    ends = sorted((r.a, r.b) for r in spark.read.parquet(path).groupBy(F.input_file_name()).agg(F.min("ride_id").alias("a"), F.max("ride_id").alias("b")).collect())
    assert len(ends) > 1 and all(x[1] <= y[0] for x, y in zip(ends, ends[1:], strict=False))


def test_records_compare_as_numbers(spark):
    rows = [(1, 1, "front", "frame_id,timestamp\r\n1, 5.50\r\n2,6\r\n", "t"), (2, 1, "front", "2,6.0", "t"), (3, 1, "rear", "2,6.0", "t"), (4, 2, "front", "2,6.0", "t"), (5, 1, "front", "", "t"), (6, 1, "front", None, "t"), (7, 1, "front", "x,y\n3,\n,4\n9", "t"), (8, 1, "front", "1,5.5\n1,5.5", "t"), (2, 1, "front", "2,6.0", "t")]
    df = spark.createDataFrame(rows, REC)
    d = c.distinct_records(df)
    assert d.count() == 4
    assert {tuple(r) for r in c.shared_files(d).collect()} == {(1, 2), (1, 8)}
    assert {tuple(r) for r in c.shared_members(d).collect()} == {(1, 1), (1, 2), (1, 8)}
    assert c.distinct_records(df.limit(0)).count() == 0


TRAJ = "traj_id long, ride_id long, timestamps array<double>, position array<struct<x:double,y:double>>, yaw array<double>, slot int"


def test_grid(spark):
    base = 1_325_376_000
    t = [v if v is None else base + v for v in (100.0, 100.3, None, 101.3, 101.3, 103.0, float("nan"), 102.9, 101.55)]
    row = lambda i, k=1.0: (i, 1, [v * k if v else v for v in t], [(float(n), 1.0) for n in range(9)], [0.1] * 9, 5)
    rows = [row(1), row(1), row(2, 1000.0), (3, 1, None, None, None, 5), (4, 1, [], [], [], 5), (None, 1, [1.0], [(1.0, 1.0)], [1.0], 5), (5, 1, [7.0], [(1.0, None)], [1.0], 5)]
    df = spark.createDataFrame(rows, TRAJ)
    got = sorted((r.traj_id, r.slot) for r in missing_slots(df).collect())
    # readings 100, 100.3, 101.3, 101.55, 102.9, 103: only the step of 1.35 s is too long; 1.0 s exactly is filled
    assert got == [(i, s) for i in (1, 2) for s in range(4 * base + 407, 4 * base + 412)]
    s = regular_series(df).where("traj_id = 1").orderBy("slot").collect()
    assert [r.slot for r in s] == list(range(4 * base + 400, 4 * base + 413)) and all((r.x is None) == (r.status == "missing") for r in s)
    assert regular_series(df.limit(0)).count() == 0


def test_imputation_beats_lines():
    at = np.arange(200)
    v = np.sin(at / 6) + 0.3 * np.sin(at / 2.3)
    gaps = v.copy()
    gaps[[20, 21, 22, 77, 78, 79, 80, 130, 131]] = np.nan
    out = impute(gaps.copy(), GridRules(rank=4))
    hole = np.isnan(gaps)
    line = np.interp(at[hole], at[~hole], v[~hole])
    assert np.abs(out[hole] - v[hole]).mean() < 0.5 * np.abs(line - v[hole]).mean()
    assert (out[~hole] == v[~hole]).all()
    assert np.isnan(impute(np.full(5, np.nan), GridRules())).all() and impute(np.array([1.0, np.nan, 3.0]), GridRules())[1] == 2.0


def test_imputation_settles(spark):
    """Slow stretches are filled until one more round changes nothing beyond the tolerance; what stops at the limit is marked."""
    rng = np.random.default_rng(3)
    series = []
    for _ in range(200):
        v = np.cumsum(rng.normal(size=60))
        v[rng.random(60) < 0.5] = np.nan
        series.append(v)
    r = GridRules()
    for v in series:
        gap, out = np.isnan(v), impute(v.copy(), r)
        mid = np.where(gap, np.interp(np.arange(60), np.flatnonzero(~gap), v[~gap]), v).mean()
        again = hankel_smooth(out - mid, r.window, r.rank)[gap] + mid
        assert np.abs(again - out[gap]).max() <= 2 * r.tolerance * max(np.abs(out - mid).max(), 1e-9)
    v = next(v for v in series if not filled(v.copy(), GridRules(rounds=3))[1])
    t = np.flatnonzero(~np.isnan(v))
    rows = [(1, 1, [1e9 + 0.25 * int(k) for k in t], [(float(v[k]), 0.0) for k in t], [0.0] * len(t))]
    df = spark.createDataFrame(rows, "traj_id long, ride_id long, timestamps array<double>, position array<struct<x: double, y: double>>, yaw array<double>")
    status = lambda n: {x.status for x in regular_series(df, GridRules(rounds=n, max_gap_us=60_000_000)).collect()}
    assert "unsettled" in status(2) and status(r.rounds) == {"observed", "filled"}


def test_a_long_series_is_one_piece_and_both_solvers_agree():
    rng = np.random.default_rng(8)
    v = np.cumsum(rng.normal(size=9_000))
    v[rng.random(9_000) < 0.2] = np.nan
    gap, r = np.isnan(v), GridRules()
    out, settled = filled(v.copy(), r)
    # by plain replacing, as the definition has it
    slow, mid = np.interp(np.arange(9_000), np.flatnonzero(~gap), v[~gap]), None
    mid = slow.mean()
    for _ in range(300):
        slow[gap] = hankel_smooth(slow - mid, r.window, r.rank)[gap] + mid
    assert settled and np.abs(out - slow).max() < 0.02
    assert np.abs(filled(v.copy(), GridRules(dense=10_000))[0] - out).max() < 1e-6


def test_imputation_of_held_out_readings(spark):
    """Readings of the trajectory records that are hidden come back better than by lines; short series are imputed as well."""
    series = regular_series(spark.read.parquet("/root/testdata/sf0.01/traj_data.parquet")).orderBy("traj_id", "slot").toPandas()
    rng = np.random.default_rng(2)
    ours, lines = [], []
    for _, g in series.groupby("traj_id"):
        whole = np.where(g.status == "observed", g.x, np.nan)
        ends = np.flatnonzero(np.diff((g.status == "missing").to_numpy().astype(int))) + 1
        for v in np.split(whole, ends):
            seen = np.flatnonzero(~np.isnan(v))[2:-2]
            hide = seen[rng.random(len(seen)) < 0.15]
            if len(v) < 40 or len(hide) == 0:
                continue
            x = v.copy()
            x[hide] = np.nan
            ours += np.abs(impute(x.copy(), GridRules())[hide] - v[hide]).tolist()
            left = np.flatnonzero(~np.isnan(x))
            lines += np.abs(np.interp(hide, left, x[left]) - v[hide]).tolist()
    assert len(ours) > 300 and np.mean(ours) < np.mean(lines)
    short = impute(np.array([0.0, 1.0, np.nan, 1.0, 0.0, -1.0, 0.0]), GridRules())
    assert short[2] != 1.0


CELLS = [
    ("[[1,2,3,4],[5,6,7,8]]", [0, 1]),
    ('[["1","2","3","4"],["1","x","3","4"],[1,2,3],[1,2,null,4],[true,2,3,4],["NaN",2,3,4]]', [0]),
    ('[{"x":1,"y":2,"z":3,"timestamp":4,"temp":20},{"x":1,"y":2,"timestamp":4},{"timestamp":4,"z":3,"y":2,"x":"1"}]', [0, 2]),
    ("[[[1,2,3,4]],[],[[5,6,7,8],[1,2,3,null]]]", [0, 1]),
    ('{"batches":[{"unit":"raw","samples":[[1,2,3,4]]},{"samples":null},{"samples":[]},{"samples":[[5,6,7,8]]}],"fw":"2"}', [0, 1]),
    ('[{"samples":[[1,2,3,4]]},{"unit":"raw","samples":[[1,2,"",4],[9,9,9,9]]}]', [0, 2]),
    ('{"readings":[[1,2,3,4],[5,6,7,8]],"offset":[1,2,3],"meta":{"fw":"2"}}', [0, 1]),
    ('{"imu":{"timestamp":5,"samples":[[1,2,3,4]],"cal":{"gain":[1,2]}}}', [0]),
    ('{"batches":[{"data":[[1,2,3,4]]},{"data":{"x":1,"y":2,"z":3,"timestamp":4}}]}', [0, 1]),
    ('{"a":{"b":{"c":[[[{"x":1,"y":2,"z":3,"timestamp":4,"more":{"p":[1]}}]]]}}}', [0]),
    ('{"samples":[1,[1,2,3,4]]}', [1]),
    ("[[]]", []),
    ("[]", []),
    ("null", []),
    ("[[1,2,3,4],[5,6", []),
    ("[[1,2,NaN,4]]", []),
    ("", []),
    (None, []),
    ("7", []),
]


def brute(cell):
    """Usable sample numbers by plain recursion, written apart from the operator."""

    def bad(_):
        raise ValueError

    try:
        v = json.loads(cell, parse_constant=bad)
    except (TypeError, ValueError):
        return []
    out = []

    def go(q):
        if isinstance(q, dict):
            inner = [k for k in ("batches", "samples") if k in q] or [k for k, e in q.items() if isinstance(e, list | dict) and "[" in json.dumps(e) and k not in ("offset", "meta", "cal", "more")]
            if inner and not ("x" in q and "samples" not in q) or "data" in q:
                for k in inner or ["data"]:
                    if isinstance(q[k], list) and any(isinstance(e, list | dict) for e in q[k]):
                        for e in q[k]:
                            go(e) if isinstance(e, list | dict) else out.append([None] * 4)
                    else:
                        go(q[k] or [])
            else:
                out.append([q.get(k) for k in ("x", "y", "z", "timestamp")])
        elif isinstance(q, list):
            if q and not isinstance(q[0], list | dict):
                out.append((q + [None] * 4)[:4])
            else:
                for e in q:
                    go(e)

    go(v)
    return [i for i, s in enumerate(out) if all(not np.isnan(number(e)) for e in s)]


def test_cells(spark):
    rows = [(i, 1, a, None, None, 0.5) for i, (a, _) in enumerate(CELLS)] + [(0, 1, CELLS[0][0], None, None, 0.5), (None, 1, CELLS[0][0], None, None, 0.5)]
    df = spark.createDataFrame(rows, "imu_id long, ride_id long, compass string, accelerometer string, gyroscope string, pre double")
    got: dict = {}
    for r in nested.sample_table(df).collect():
        got.setdefault(r.imu_id, []).append(r.sample_idx)
    for i, (cell, want) in enumerate(CELLS):
        assert sorted(got.get(i, [])) == want == brute(cell), cell
    t = nested.node_tables(df)
    link = {(r.imu_id, r.sample_idx): (r.object_idx, r.unit) for r in nested.innermost(t["sample"], t["object"], {"idx": "sample_idx"}, {"idx": "object_idx", "unit": "unit"}).collect()}
    assert link[(4, 0)] == (1, "raw") and link[(4, 1)] == (4, None) and link[(5, 2)] == (1, "raw") and link[(0, 1)] == (None, None)
    fields = {(r.imu_id, r.name, r.value, r.sample_idx) for r in nested.innermost(t["field"], t["sample"], {"idx": "field_idx", "name": "name", "value": "value"}, {"idx": "sample_idx"}).collect()}
    assert (2, "temp", "20", 0) in fields and (4, "fw", "2", None) in fields
    assert all(v.where("imu_id = 4").count() for v in t.values()) and t["cell"].count() == len([c for c, _ in CELLS if read_cell(c)])
    assert nested.sample_table(df.limit(0)).count() == 0


@pytest.mark.parametrize("cell", [c for c, _ in CELLS if read_cell(c)])
def test_intervals_say_what_contains_what(cell):
    """Parents by containment equal those of a walk of its own, in which a node's labels come from a list of opened and closed nodes."""
    t = read_cell(cell)
    nodes = sorted([(q[1], q[2]) for q in t.others] + [(q[0], q[1]) for q in t.samples])
    assert [a for a, _ in nodes] == list(range(len(nodes))) and sorted(b for _, b in nodes) == list(range(len(nodes)))
    # rebuild by opening in pre-order and closing in post-order: each node must close right after all that it contains
    open_, closed = [], 0
    for pre, post in nodes:
        while open_ and open_[-1][1] < post:
            assert open_.pop()[1] == closed
            closed += 1
        inside = [n for n in nodes if n[0] < pre and post < n[1]]
        assert inside == open_
        open_.append((pre, post))
    # an inner node's span holds exactly its own subtree
    for pre, post in nodes:
        below = [n for n in nodes if pre < n[0] and n[1] < post]
        assert [n[0] for n in below] == list(range(pre + 1, pre + 1 + len(below)))


def test_whole_cells_against_brute_force(spark):
    imu = spark.read.parquet("/root/testdata/sf0.001/imu_data.parquet")
    got = {(r.imu_id, r.sensor, r.sample_idx) for r in nested.sample_table(imu).collect()}
    want = {(r.imu_id, s, i) for r in imu.collect() for s in nested.SENSORS for i in brute(r[s])}
    assert got == want
