"""Block-wise operators give the same result whatever the block size."""

import math
import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from motionframes.functions import quat as Q
from motionframes.operators import gaps, runs, windows
from motionframes.operators.blocks import attach, dense_frames, running

KEYS = {"keys": ["take"], "frame": "frame"}


@pytest.fixture(scope="module")
def frames(spark):
    random.seed(7)
    rows = []
    for take in range(4):
        for frame in range(60 + 13 * take):
            x = None if random.random() < 0.3 else random.uniform(-4, 4)
            rows.append((take, frame, x, random.random() < 0.6))
    df = spark.createDataFrame(rows, "take int, frame long, x double, ok boolean")
    return df.repartition(5).cache()


def table(df):
    names = sorted(df.columns)
    clean = lambda v: round(v, 9) if isinstance(v, float) else v
    return sorted(repr([clean(r[n]) for n in names]) for r in df.collect())


OPERATORS = {
    "running": lambda df, rows: running(
        df,
        **KEYS,
        rows=rows,
        scans={
            "total": ("sum", F.col("x")), "high": ("max", F.col("x")), "low": ("min", F.col("x")),
            "before": ("last", F.col("x")), "after": ("next", F.col("x")),
            "lagged": ("previous", F.col("x")), "led": ("following", F.col("x")),
        },
    ),
    "runs": lambda df, rows: runs.runs(df, **KEYS, state=F.col("ok"), totals={"n": F.lit(1)}, rows=rows),
    "bounds": lambda df, rows: runs.with_run_bounds(df, **KEYS, state=F.col("ok"), rows=rows),
    "longest": lambda df, rows: runs.longest_span(df, **KEYS, solved=F.col("ok"), rows=rows),
    "segments": lambda df, rows: runs.edge_segments(df, **KEYS, contact=F.col("ok"), rows=rows),
    "edges": lambda df, rows: runs.edge_status(df, **KEYS, solved=F.col("ok"), trim=2, rows=rows),
    "trim": lambda df, rows: runs.trim_outer(df, **KEYS, valid=F.col("ok"), rows=rows),
    "windows": lambda df, rows: runs.accept_windows(
        df.withColumn("s", F.when(F.col("ok"), "OBSERVED").otherwise("INTERPOLATED")),
        **KEYS, status="s", window=8, stride=4, max_fraction=0.5, rows=rows,
    ),
    "overlapped": lambda df, rows: runs.overlapped_windows(
        df, **KEYS, good=F.col("ok"), window=4, stride=2, keep_from=1, rows=rows
    ),
    "speed": lambda df, rows: windows.flag_speed_outliers(df, **KEYS, position=["x"], dt_s=1.0, max_speed=3.0, rows=rows),
    "unwrap": lambda df, rows: windows.unwrap(df.fillna(0.0), **KEYS, angle="x", rows=rows),
    "differences": lambda df, rows: windows.differences(df.fillna(0.0), **KEYS, value="x", dt_s=0.1, rows=rows),
    "smooth": lambda df, rows: windows.polynomial_smooth(
        df, **KEYS, value="x", window=3, degree=2, derivative=1, dt_s=0.1, rows=rows
    ),
    "resample": lambda df, rows: windows.resample(df.fillna(0.0), **KEYS, src_hz=120.0, dst_hz=100.0, vectors=["x"], rows=rows),
    "hermite": lambda df, rows: gaps.hermite_fill(df, **KEYS, columns=["x"], max_gap=3, rows=rows),
    "lowpass": lambda df, rows: gaps.zero_phase_lowpass(
        df.fillna(0.0), **KEYS, value="x", order=2, cutoff_hz=20.0, rate_hz=100.0, rows=rows
    ),
}


@pytest.mark.parametrize("name", sorted(OPERATORS))
def test_block_size_does_not_matter(frames, name):
    whole = table(OPERATORS[name](frames, 100_000))
    assert whole
    for rows in (7, 16):
        assert table(OPERATORS[name](frames, rows)) == whole


@pytest.mark.parametrize("name", sorted(set(OPERATORS) - {"lowpass"}))
def test_absent_frames_do_not_depend_on_blocks(frames, name):
    sparse = frames.where("frame % 4 <> 1 and frame % 23 not in (8, 9, 10, 11, 12, 13, 14, 15, 16)").cache()
    whole = table(OPERATORS[name](sparse, 100_000))
    for rows in (4,):
        assert table(OPERATORS[name](sparse, rows)) == whole


def test_neighbours_over_absent_frames(spark):
    """Frames 0, 1, 4, 5: turns and edges go from row to row, rates only between consecutive frames."""
    df = spark.createDataFrame([(0, f, x, ok) for f, x, ok in ((0, 3.0, True), (1, 3.1, False), (4, -3.0, True), (5, -2.9, True))], "take int, frame long, x double, ok boolean")
    for rows in (1, 2, 3, 100):
        by = lambda out: [r[0] for r in out.orderBy("frame").select(out.columns[-1]).collect()]
        turned = windows.unwrap(df, **KEYS, angle="x", rows=rows)
        assert by(turned.select("frame", "wrap_counter")) == [0, 0, -1, -1]
        assert by(turned.select("frame", "transition")) == [False, False, True, False]
        assert by(runs.edge_segments(df, **KEYS, contact=F.col("ok"), rows=rows).select("frame", "segment")) == [0, 0, 1, 1]
        slope = by(windows.differences(df, **KEYS, value="x", dt_s=0.1, rows=rows).select("frame", "backward"))
        assert slope[0] is None and slope[2] is None and slope[1] == pytest.approx(1.0) and slope[3] == pytest.approx(1.0)


def rotation_frames(spark, absent=()):
    rows = []
    for take in range(2):
        for f in (f for f in range(50) if f % 10 not in absent):
            a = 0.09 * f + 0.002 * f * f
            hidden = f % 11 in (4, 5, 6)
            rows.append((take, f, *(None if hidden else v for v in (math.cos(a / 2), 0.0, 0.0, math.sin(a / 2)))))
    df = spark.createDataFrame(rows, "take int, frame long, w double, x double, y double, z double")
    return df.select("take", "frame", F.when(F.col("w").isNotNull(), Q.quat(*[F.col(c) for c in "wxyz"])).alias("q"))


@pytest.mark.parametrize("absent", [(), (3,), (0, 1, 2, 6, 7)])
def test_rotation_operators_do_not_depend_on_blocks(spark, absent):
    q = rotation_frames(spark, absent)
    full = q.withColumn("q", F.coalesce("q", Q.quat(*[F.lit(v) for v in (1.0, 0.0, 0.0, 0.0)])))
    for op in (
        lambda rows: gaps.spherical_fill(q, **KEYS, q="q", max_gap=4, rows=rows),
        lambda rows: windows.sign_continuous(full, **KEYS, q="q", rows=rows),
        lambda rows: windows.angular_rate(full, **KEYS, q="q", dt_s=0.1, one_sided_ends=True, rows=rows),
        lambda rows: windows.step_angle(full, **KEYS, q="q", limit_deg=20.0, pad=2, rows=rows),
        lambda rows: windows.resample(full, **KEYS, src_hz=60.0, dst_hz=100.0, rotations=["q"], rows=rows),
    ):
        flat = lambda df: df.select(*[c for c in df.columns if c != "q"], *[F.round(F.col("q")[a], 9).alias(a) for a in "wxyz"])
        assert table(flat(op(100_000))) == table(flat(op(9)))


@pytest.mark.parametrize("hot_rows", [1000, 10, 3])
def test_dense_frames_rank_over_ranges(spark, hot_rows):
    df = spark.createDataFrame([(k % 3, i, (i * 7) % 50) for i, k in enumerate(range(50))], "take int, id int, t int")
    out = dense_frames(df, keys=["take"], order=["t", "id"], minima={"t0": F.col("t")}, hot_rows=hot_rows)
    by_take = {}
    for r in out.collect():
        by_take.setdefault(r.take, []).append((r.frame, r.t, r.id, r.t0))
    for rows in by_take.values():
        rows.sort()
        assert [r[0] for r in rows] == list(range(len(rows)))
        assert [(r[1], r[2]) for r in rows] == sorted((r[1], r[2]) for r in rows)
        assert {r[3] for r in rows} == {min(r[1] for r in rows)}


def test_attach_copies_a_key_row_to_every_block(frames):
    lasts = frames.groupBy("take").agg(F.max("frame").alias("last"), F.count(F.lit(1)).alias("n"))
    out = attach(frames, lasts, keys=["take"], frame="frame", last_frame="last", rows=10)
    assert out.count() == frames.count()
    assert out.where("n is null").count() == 0


def test_partitioning_of_the_input_does_not_matter(frames):
    one = runs.runs(frames.coalesce(1), **KEYS, state=F.col("ok"), rows=16)
    many = runs.runs(frames.repartition(13, "frame"), **KEYS, state=F.col("ok"), rows=16)
    assert table(one) == table(many)


def test_hot_buckets_are_cut_and_still_numbered_exactly(spark):
    # One bucket and, for take 1, one single time hold most rows; ids break the ties.
    rows = [(0, i, (i * 37) % 400) for i in range(400)] + [(1, i, 5) for i in range(300)] + [(2, 0, 9)]
    df = spark.createDataFrame(rows, "take int, id long, t long").repartition(7)
    out = dense_frames(df, keys=["take"], order=["t", "id"], hot_rows=50)
    by_take = {}
    for r in out.collect():
        by_take.setdefault(r.take, []).append((r.frame, r.t, r.id))
    assert {k: len(v) for k, v in by_take.items()} == {0: 400, 1: 300, 2: 1}
    for found in by_take.values():
        found.sort()
        assert [f for f, _, _ in found] == list(range(len(found)))
        assert [(t, i) for _, t, i in found] == sorted((t, i) for _, t, i in found)


def test_numbering_with_one_heavy_time(spark):
    """A heavy value between others, in both order columns: the frames of the single window, whatever the limit."""
    from pyspark.sql import Window
    from pyspark.sql import functions as F

    from motionframes.operators.blocks import dense_frames

    rows = [(1, t % 101, i) for i, t in enumerate(range(100))] + [(1, 50, 1000 + i) for i in range(4000)] + [(2, 7, i) for i in range(30)]
    frame = spark.createDataFrame(rows, "take int, t int, i int")
    want = frame.withColumn("frame", F.row_number().over(Window.partitionBy("take").orderBy("t", "i")).cast("bigint") - 1)
    for hot in (40, 1000):
        found = dense_frames(frame, keys=["take"], order=["t", "i"], hot_rows=hot)
        assert sorted(map(tuple, found.select("take", "t", "i", "frame").collect())) == sorted(map(tuple, want.collect()))


def test_large_group_without_values(spark):
    from motionframes.operators.quantiles import exact_quantiles

    frame = spark.createDataFrame([("a", None)] * 50 + [("b", float(i)) for i in range(50)], "k string, x double")
    for hot in (10, 1000):
        found = exact_quantiles(frame, keys=["k"], value="x", probs={"m": 0.5}, hot_rows=hot).collect()
        assert sorted(map(tuple, found)) == [("a", None), ("b", 24.5)]


@pytest.mark.parametrize("hot", [20, 500, 100_000])
def test_numbering_without_times(spark, hot):
    """A large key whose times are all NULL, a NULL key, tied times and text in the order: the single window's numbers."""
    rows = [(1, None, i, f"n{i % 7}") for i in range(3000)] + [(None, i % 5, i, "x") for i in range(400)] + [(2, 3, i, None) for i in range(30)]
    frame = spark.createDataFrame(rows, "take int, t int, i int, name string").repartition(6)
    order = ["t", "name", "i"]
    whole = Window.partitionBy("take")
    want = frame.withColumns({"frame": F.row_number().over(whole.orderBy(*order)).cast("bigint") - 1, "low": F.min("i").over(whole)})
    found = dense_frames(frame, keys=["take"], order=order, minima={"low": F.col("i")}, hot_rows=hot)
    assert found.columns == want.columns
    assert sorted(map(tuple, found.collect()), key=str) == sorted(map(tuple, want.collect()), key=str)


@pytest.mark.parametrize("hot", [10, 60, 1000])
def test_quantiles_of_several_columns(spark, hot):
    """The same answers with every group large, one large, and none."""
    from motionframes.operators.quantiles import exact_quantiles_of

    rows = [("a", float((i * 37) % 101), None if i % 3 else float(i)) for i in range(100)] + [("b", float(i), None) for i in range(50)] + [(None, 1.0, 2.0)]
    frame = spark.createDataFrame(rows, "k string, x double, y double")
    probs = {"x": {"x_mid": 0.5, "x_high": 0.95}, "y": {"y_mid": 0.5}}
    named = {n: (c, p) for c, held in probs.items() for n, p in held.items()}
    want = frame.where("k is not null").groupBy("k").agg(*[F.percentile(c, p).alias(n) for n, (c, p) in named.items()], F.count("*").alias("n"))
    found = exact_quantiles_of(frame.where("k is not null"), keys=["k"], probs=probs, aggs=[F.count("*").alias("n")], hot_rows=hot)
    near = lambda df: sorted([tuple(round(v, 9) if isinstance(v, float) else v for v in r) for r in df.collect()])
    assert near(found) == near(want)
