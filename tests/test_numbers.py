"""Numeric operators against known answers and brute force."""

import math
import random
import tracemalloc

import numpy as np
import pytest
from pyspark.sql import functions as F

from motionframes.functions import quat as Q
from motionframes.operators import gaps, rigid, stats, windows
from motionframes.operators.quantiles import exact_quantiles
from motionframes.operators.slopes import _near_median, crossed, inversions, median_slopes, paired_median

KEYS = {"keys": ["take"], "frame": "frame"}


def test_quantiles_of_large_groups_are_exact(spark):
    random.seed(3)
    groups = {
        0: [random.gauss(0, 1) for _ in range(5000)],
        1: [random.choice([1.0, 2.0, 2.0, 5.0]) for _ in range(3000)],
        2: [float(i) for i in range(7)],
        3: [0.25] * 900,
    }
    rows = [(k, v) for k, vs in groups.items() for v in vs] + [(0, None), (1, None)]
    df = spark.createDataFrame(rows, "k int, v double").repartition(6)
    probs = {"low": 0.0, "p05": 0.05, "half": 0.5, "p95": 0.95, "high": 1.0}
    out = exact_quantiles(df, keys=["k"], value="v", probs=probs, aggs=[F.count("v").alias("n")], hot_rows=100)
    found = {r.k: r for r in out.collect()}
    assert set(found) == set(groups)
    for k, values in groups.items():
        assert found[k].n == len(values)
        for name, p in probs.items():
            assert found[k][name] == pytest.approx(np.quantile(values, p), abs=1e-12)


def median_of_all_pairs(x, y):
    i, j = np.triu_indices(len(x), 1)
    keep = x[j] != x[i]
    return np.median((y[j] - y[i])[keep] / (x[j] - x[i])[keep]) if keep.any() else None


@pytest.mark.parametrize("rows", [4096, 7])
def test_median_slopes_of_all_keys_without_pairs(spark, rows):
    rng = np.random.default_rng(5)
    keys = {}
    for key, n in {"two": 2, "three": 3, "even": 300, "odd": 301}.items():
        x = np.round(rng.uniform(0, 50, n), 1)
        keys[key] = x, 0.3 * x + rng.standard_cauchy(n)
    x = np.repeat(np.round(rng.uniform(0, 9, 60), 1), 2)
    keys["repeated"] = x, np.repeat(np.round(rng.uniform(0, 9, 60), 1), 2)
    keys["flat"] = x, np.zeros(120)
    keys["whole numbers far away"] = x + 1e6, np.round(3.0 * x)
    for n in range(9, 25):
        x = np.sort(rng.uniform(1e5, 2e6, n))
        keys[f"small slopes {n}"] = x, rng.uniform(0, 100, n)
    keys["upright"] = np.ones(4), np.arange(4.0)
    lines = [(key, float(a), float(b)) for key, (x, y) in keys.items() for a, b in zip(x, y)]
    lines += [("two", None, 1.0), ("two", float("nan"), 1.0), ("two", 1.0, float("inf")), ("none", None, None)]
    df = spark.createDataFrame(lines, "k string, x double, y double")
    found = {r.k: r.slope for r in median_slopes(df, keys=["k"], x="x", y="y", rows=rows).collect()}
    assert set(found) == set(keys) - {"upright"}
    for key, slope in found.items():
        assert slope == pytest.approx(median_of_all_pairs(*keys[key]), rel=1e-14, abs=1e-300), key


def test_median_slopes_of_small_keys_need_no_rounds(spark, monkeypatch):
    rng = np.random.default_rng(8)
    keys = {k: (np.round(rng.uniform(0, 30, 3 + k), 1), rng.standard_cauchy(3 + k)) for k in range(40)}
    df = spark.createDataFrame([(k, float(a), float(b)) for k, (x, y) in keys.items() for a, b in zip(x, y)], "k int, x double, y double")

    def rounds(*_):
        raise AssertionError("a small key is counted in rounds")

    monkeypatch.setattr("motionframes.operators.slopes._next_slopes", rounds)
    monkeypatch.setattr("motionframes.operators.slopes.LISTED_POINTS", 100)
    out = median_slopes(df, keys=["k"], x="x", y="y")
    assert out._jdf.queryExecution().sparkPlan().toString().count("ArrowEvalPython") == 1
    found = {r.k: r.slope for r in out.collect()}
    assert found == {k: pytest.approx(median_of_all_pairs(x, y), rel=1e-14) for k, (x, y) in keys.items()}
    assert out.select(F.spark_partition_id().alias("p")).distinct().count() > 3


def test_drift_of_short_takes_is_removed_without_rounds(spark, monkeypatch):
    monkeypatch.setattr("motionframes.operators.slopes._narrowed", None)
    points = spark.range(60).selectExpr("id % 3 as take", "double(id div 3) as t", "(id % 3) * double(id div 3) + if(id < 9, 50, 0) as y")
    rows = points.selectExpr("take", "bigint(t) as frame", "t + 4 as t_s", "y as x")
    slopes = stats.robust_slopes(points, rows, keys=["take"], x="t", y="y", row_x="t_s", row_y="x")
    out = windows.remove_linear_drift(rows, keys=["take"], frame="frame", time="t_s", value="x", slopes=slopes, out="level")
    assert {(r.take, r.frame): r.level for r in out.collect()} == {(k, f): pytest.approx(50.0 * (f < 3)) for k in range(3) for f in range(20)}


def test_drift_of_takes_of_thousands_of_points_is_removed_without_rounds(spark, monkeypatch):
    monkeypatch.setattr("motionframes.operators.slopes._narrowed", None)
    points = spark.range(6600).selectExpr("id % 2 as take", "double(id div 2) as t", "(id % 2) * double(id div 2) + if(id < 900, 50, 0) as y")
    rows = points.selectExpr("take", "bigint(t) as frame", "t + 4 as t_s", "y as x")
    slopes = stats.robust_slopes(points, rows, keys=["take"], x="t", y="y", row_x="t_s", row_y="x")
    out = windows.remove_linear_drift(rows, keys=["take"], frame="frame", time="t_s", value="x", slopes=slopes, out="level")
    assert {(r.take, r.frame): r.level for r in out.collect()} == {(k, f): pytest.approx(50.0 * (f < 450)) for k in range(2) for f in range(3300)}


def test_median_of_many_pairs_keeps_few_slopes():
    rng = np.random.default_rng(10)
    n = 3000
    lines = [
        (rng.uniform(0, 30, n), rng.standard_cauchy(n)), (np.arange(n + 1.0), rng.normal(size=n + 1)), (rng.uniform(0, 30, n), np.zeros(n)),
        (rng.uniform(0, 30, n), 1.0 * rng.integers(0, 2, n)), (1.0 * rng.integers(0, 2, n), rng.normal(size=n)), (np.arange(n) * 1.0, np.arange(n) * 2.0),
    ]
    for x, y in lines:
        expected = median_of_all_pairs(x, y)
        tracemalloc.start()
        assert paired_median(x, y) == pytest.approx(expected, rel=1e-14, abs=1e-300)
        peak = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        assert peak < 8 * (n * (n - 1) // 2) / 2


def test_a_bracket_that_misses_is_widened():
    rng = np.random.default_rng(11)
    for y in (rng.standard_cauchy(400), 1.0 * rng.integers(0, 3, 400)):
        x = np.sort(np.round(rng.uniform(0, 30, 400), 1))
        i, j = np.triu_indices(400, 1)
        i, j = i[x[i] < x[j]], j[x[i] < x[j]]
        slopes = np.sort((y[j] - y[i]) / (x[j] - x[i]))
        beyond = np.searchsorted(x, x, side="right")
        for low in (0, 5, len(slopes) // 3, len(slopes) // 2, len(slopes) - 9, len(slopes) - 2):
            assert _near_median(x, y, beyond, (low, low + 1)) == (slopes[low], slopes[low + 1])


@pytest.mark.parametrize("rows", [4096, 7])
def test_median_slopes_of_counted_and_listed_keys(spark, rows):
    rng = np.random.default_rng(9)
    keys = {n: (np.round(rng.uniform(0, 30, n), 1), np.round(rng.standard_cauchy(n), 2)) for n in (2, 5, 24, 25, 26, 90, 131)}
    keys[60] = np.ones(60), np.arange(60.0)
    df = spark.createDataFrame([(k, float(a), float(b)) for k, (x, y) in keys.items() for a, b in zip(x, y)], "k int, x double, y double")
    found = {r.k: r.slope for r in median_slopes(df, keys=["k"], x="x", y="y", rows=rows, paired=25).collect()}
    assert found == {k: pytest.approx(median_of_all_pairs(x, y), rel=1e-14) for k, (x, y) in keys.items() if k != 60}


def test_crossed_pairs_by_rank():
    rng = np.random.default_rng(6)
    x = np.sort(np.round(rng.uniform(0, 9, 90), 1))
    y = np.round(rng.uniform(0, 9, 90), 1)
    order = np.lexsort((y, x))
    x, y = x[order], y[order]
    i, j = np.triu_indices(90, 1)
    keep = x[j] > x[i]
    slopes = (y[j] - y[i])[keep] / (x[j] - x[i])[keep]
    probes = np.array([-3.3, -0.01, 0.01, 0.77, 5.1])
    assert crossed(x, y, probes).tolist() == [int((slopes <= p).sum()) for p in probes]
    assert inversions(np.array([[3, 1, 2, 0], [0, 1, 2, 3], [3, 2, 1, 0]])).tolist() == [5, 0, 6]


def test_spherical_fill_follows_a_constant_rate(spark):
    rows = [(0, f, math.cos(0.05 * f), math.sin(0.05 * f)) for f in range(40) if f not in (10, 11, 12, 25)]
    df = spark.createDataFrame(rows, "take int, frame long, w double, z double")
    full = spark.range(40).select(F.lit(0).alias("take"), F.col("id").alias("frame")).join(df, ["take", "frame"], "left")
    q = F.when(F.col("w").isNotNull(), Q.quat(F.col("w"), F.lit(0.0), F.lit(0.0), F.col("z")))
    out = gaps.spherical_fill(full.select("take", "frame", q.alias("q")), **KEYS, q="q", max_gap=3)
    found = {r.frame: r.q for r in out.collect()}
    assert set(found) == {10, 11, 12, 25}
    for f, v in found.items():
        assert abs(v.w * math.cos(0.05 * f) + v.z * math.sin(0.05 * f)) == pytest.approx(1.0, abs=1e-9)


def test_hermite_fill_keeps_a_straight_line_and_leaves_edges(spark):
    rows = [(0, f, None if f in (0, 5, 6, 20, 21, 22, 23, 39) else 2.0 * f + 1) for f in range(40)]
    out = gaps.hermite_fill(spark.createDataFrame(rows, "take int, frame long, x double"), **KEYS, columns=["x"], max_gap=3)
    found = {r.frame: (r.x, r.status) for r in out.collect()}
    assert found[5] == (pytest.approx(11.0), "INTERPOLATED")
    assert found[0] == (None, "UNAVAILABLE") and found[39] == (None, "UNAVAILABLE")
    assert found[21] == (None, "UNAVAILABLE")
    assert found[7][1] == "OBSERVED"


def test_lowpass_matches_a_direct_recursion():
    """Forward and backward recursion with steady-state starts and odd extension, sample by sample."""
    b, a = gaps.lowpass_coefficients(4, 12.0, 100.0)
    h = gaps.impulse_response(b, a)
    rng = np.random.default_rng(1)
    x = np.cumsum(rng.standard_normal(400))
    pad = 3 * len(a)
    ext = np.concatenate([2 * x[0] - x[pad:0:-1], x, 2 * x[-1] - x[-2 : -pad - 2 : -1]])

    def recurse(s):
        past_x, past_y = [s[0]] * len(b), [s[0]] * (len(a) - 1)
        out = []
        for v in s:
            past_x = [v, *past_x[:-1]]
            y = sum(p * q for p, q in zip(b, past_x)) - sum(p * q for p, q in zip(a[1:], past_y))
            past_y = [y, *past_y[:-1]]
            out.append(y)
        return np.array(out)

    direct = recurse(recurse(ext)[::-1])[::-1][pad:-pad]
    assert np.allclose(gaps.filter_both_ways(x, h, pad, starts=True, ends=True), direct, atol=1e-10)
    assert b.sum() / a.sum() == pytest.approx(1.0)
    half = b @ np.exp(-1j * 2 * np.pi * 0.12 * np.arange(5)) / (a @ np.exp(-1j * 2 * np.pi * 0.12 * np.arange(5)))
    assert abs(half) == pytest.approx(math.sqrt(0.5))


def test_polynomial_weights_are_exact_on_a_polynomial():
    t = np.arange(11) * 0.01
    y = 3 + 2 * t - 5 * t**2 + 7 * t**3
    for p, row in enumerate(windows.polynomial_weights(11, 5, 2, 0.01)):
        assert np.dot(row, y) == pytest.approx(-10 + 42 * t[p], rel=1e-6)


def _turn(axis, angle):
    k = np.array([[0, -axis[2], axis[1]], [axis[2], 0, -axis[0]], [-axis[1], axis[0], 0]])
    return np.eye(3) + math.sin(angle) * k + (1 - math.cos(angle)) * k @ k


def test_poses_recover_a_known_motion_and_fill_hidden_markers(spark):
    shape = np.array([[0.0, 0, 0], [0.1, 0, 0], [0, 0.07, 0], [0.02, 0.03, 0.05]])
    markers = ["m0", "m1", "m2", "m3"]
    rows, truth = [], {}
    for f in range(12):
        r, t = _turn(np.array([0.6, 0.0, 0.8]), 0.2 * f), np.array([0.1 * f, 1.0, -0.2 * f])
        for m, p in zip(markers, shape):
            where = r @ p + t
            truth[f, m] = where
            hidden = (f, m) in ((3, "m2"), (5, "m0"), (5, "m1"))
            rows.append((0, f, m, *(None if hidden else float(v) for v in where)))
    df = spark.createDataFrame(rows, "take int, frame long, marker string, x double, y double, z double")
    wide = rigid.wide_markers(df, keys=["take", "frame"], marker="marker", markers=markers, position=["x", "y", "z"])
    local = rigid.mean_shape(wide, **KEYS, markers=markers)
    poses = rigid.solve_poses(wide, local, **KEYS, markers=markers).cache()
    by_frame = {r.frame: r for r in poses.collect()}
    assert by_frame[5].residual is None and by_frame[5].n_visible == 2
    assert all(r.residual < 1e-9 for f, r in by_frame.items() if f != 5)
    filled = rigid.reconstruct(wide, local, poses, **KEYS, markers=markers, max_residual=0.01)
    for r in filled.collect():
        if r.frame == 5 and r.marker in ("m0", "m1"):
            assert r.position is None
        else:
            assert np.allclose([r.position.x, r.position.y, r.position.z], truth[r.frame, r.marker], atol=1e-9)


def test_proper_rotation_never_reflects(spark):
    mirror = np.diag([1.0, 1.0, -1.0]).ravel().tolist()
    df = spark.createDataFrame([tuple(mirror), (None,) * 9], ", ".join(f"c{i} double" for i in range(9)))
    rows = df.select(rigid.rotation_of([F.col(f"c{i}") for i in range(9)]).alias("r")).collect()
    found = np.array([rows[0].r[f"m{i}{j}"] for i in range(3) for j in range(3)]).reshape(3, 3)
    assert np.linalg.det(found) == pytest.approx(1.0)
    assert rows[1].r.m00 is None


def test_unwrap_of_exact_half_turns(spark):
    values = [0.0, math.pi, 0.0, -math.pi, 3.0, -3.0, 3.0]
    df = spark.createDataFrame([(0, i, v) for i, v in enumerate(values)], "take int, frame long, a double")
    out = [r.unwrapped for r in windows.unwrap(df, **KEYS, angle="a").orderBy("frame").collect()]
    assert out == pytest.approx(np.unwrap(values).tolist())


def test_opposite_directions_turn_by_half_a_circle(spark):
    df = spark.createDataFrame([(0.0, 0.0, 1.0), (0.0, 0.0, -2.0), (0.0, 0.0, 0.0)], "x double, y double, z double")
    df = df.select(Q.vec(F.col("x"), F.col("y"), F.col("z")).alias("v"))
    rows = Q.with_shortest_to_axis(df, "q", "v", (0.0, 0.0, -1.0)).collect()
    assert tuple(rows[0].q) == pytest.approx((0.0, 1.0, 0.0, 0.0))
    assert tuple(rows[1].q) == pytest.approx((1.0, 0.0, 0.0, 0.0))
    assert rows[2].q is None


def test_matrix_round_trip_at_half_turns(spark):
    quats = [(0.0, 1.0, 0.0, 0.0), (0.0, 0.0, 1.0, 0.0), (0.0, 0.0, 0.0, 1.0), (0.5, 0.5, -0.5, 0.5)]
    df = spark.createDataFrame(quats, "w double, x double, y double, z double")
    df = df.select(Q.quat(*[F.col(c) for c in "wxyz"]).alias("q")).withColumn("m", Q.to_matrix(F.col("q")))
    for r in Q.with_quaternion(df, "b", "m").collect():
        assert abs(sum(a * b for a, b in zip(r.q, r.b))) == pytest.approx(1.0)
