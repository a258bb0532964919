import numpy as np
import pytest
from pyspark.sql import functions as F

from motionframes.llm import kdtree


def brute(rows, k):
    out = set()
    for q, x in rows:
        if q % 20 == 0:
            scored = sorted(((-int(np.dot(x, y)), i) for i, y in rows if i != q))[:k]
            out |= {(q, r + 1, i, -s) for r, (s, i) in enumerate(scored)}
    return out


@pytest.mark.parametrize("crowd", [0, 150])
def test_against_brute_force(spark, rng, crowd):
    rows = [(i, [int(v) for v in rng.integers(-9, 9, 6)]) for i in range(400)]
    rows += [(1000 + i, [5, 5, 5, 5, 5, 5]) for i in range(crowd)]
    frame = spark.createDataFrame([*rows, (7777, None), (None, [1] * 6)], "vec_id long, vector array<long>").withColumn("score", F.lit("clash"))
    found = {tuple(r) for r in kdtree.top_k(frame, F.col("vec_id") % 20 == 0, 20).collect()}
    assert found == brute(rows, 20)


def test_few_and_no_rows(spark):
    schema = "vec_id long, vector array<long>"
    assert kdtree.top_k(spark.createDataFrame([], schema), F.col("vec_id") % 20 == 0, 20).count() == 0
    few = spark.createDataFrame([(0, [1, 2]), (1, [3, 4])], schema)
    assert [tuple(r) for r in kdtree.top_k(few, F.col("vec_id") % 20 == 0, 20).collect()] == [(0, 1, 1, 11)]


def test_lengths_nulls_and_repeated_query_ids(spark):
    rows = [(0, [3, 1]), (0, [1, 2]), (1, [3, 4]), (2, [5]), (20, [2]), (40, []), (3, [1, None]), (60, [1, 1, 1])]
    found = {tuple(r) for r in kdtree.top_k(spark.createDataFrame(rows, "vec_id long, vector array<long>"), F.col("vec_id") % 20 == 0, 20).collect()}
    assert found == {(0, 1, 1, 11), (20, 1, 2, 10)}
