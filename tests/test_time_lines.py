"""Joins along a time line against brute force: one answer for every stretch, block and range size."""

import random

import pytest

from motionframes.operators import joins

SIZES = [(1024, 4_000_000), (3, 4_000_000), (7, 50)]


@pytest.mark.parametrize("rows, hot_rows", SIZES)
def test_intervals(spark, rows, hot_rows):
    """One key has most samples in one hour and an interval over all of them, many times meet edges, intervals overlap and repeat."""
    rng = random.Random(3)
    samples = [("a", rng.randrange(40) / 4, i) for i in range(300)] + [("b", float(i), 1000 + i) for i in range(20)]
    samples += [("c", 1.0, 2000), ("a", None, 2001), (None, 1.0, 2002), ("b", float("nan"), 2003)]
    spans = [("a", 0.0, 11.0, "all"), ("a", 2.0, 2.25, "one"), ("a", 2.25, 2.25, "none"), ("a", 5.0, 4.0, "back"), ("b", -3.0, 2.5, "b")]
    spans += [("a", lo / 4, lo / 4 + rng.randrange(4) / 4, f"s{lo}") for lo in range(30)] + [("b", 3.0, 6.0, "twice")] * 2
    spans += [("b", None, 6.0, "open"), (None, 0.0, 9.0, "keyless"), ("d", 0.0, 9.0, "alone"), ("b", 18.0, float("inf"), "endless")]
    expected = sorted((k, t, i, n) for k, t, i in samples for key, lo, hi, n in spans if None not in (k, t, lo, hi) and k == key and lo <= t < hi)
    left = spark.createDataFrame(samples, "take string, at double, id long").repartition(4)
    right = spark.createDataFrame(spans, "take string, start double, stop double, label string")
    found = joins.within_intervals(left, right, keys=["take"], time="at", start="start", stop="stop", rows=rows, hot_rows=hot_rows)
    assert found.columns == ["take", "at", "id", "start", "stop", "label"]
    assert sorted((r["take"], r["at"], r["id"], r["label"]) for r in found.collect()) == expected
    assert joins.within_intervals(left, right.limit(0), keys=["take"], time="at", start="start", stop="stop").count() == 0


@pytest.mark.parametrize("rows, hot_rows", SIZES)
def test_nearest(spark, rows, hot_rows):
    rng = random.Random(5)
    left = [("a", rng.randrange(500), i) for i in range(200)] + [("b", 5, 900), ("c", 5, 901), ("a", None, 902)]
    right = [("a", 7 * i + rng.randrange(3), 5000 + i, float(i)) for i in range(60)] + [("b", 30, 6000, 1.0), ("b", 10, 6001, 2.0), ("b", None, 6002, 3.0)]
    sides = [spark.createDataFrame(left, "take string, t long, id long"), spark.createDataFrame(right, "take string, t long, id long, value double")]
    size = {"rows": rows, "hot_rows": hot_rows}
    limit = joins.half_median_step(sides[1].where("t is not null"), keys=["take"], time="t", id_="id", **size)
    limits = {r["take"]: r["tolerance"] for r in limit.collect()}
    assert limits["b"] == 10.0
    found = joins.nearest_in_time(*sides, keys=["take"], time="t", id_="id", values=["value"], tolerance=limit, **size)
    answers = {r["id"]: (r["at"], r["value"]) for r in found.collect()}
    assert len(answers) == len(left)
    for take, t, id_ in left:
        near = min(((abs(t - at), at, value) for key, at, _, value in right if key == take and at is not None), default=None) if t is not None else None
        assert answers[id_] == (near[1:] if near and near[0] <= limits[take] else (None, None))
