import hashlib

import numpy as np
import pytest

from motionframes.llm import pivots

SCHEMA = "vec_id long, embedding array<float>, label int, x string, far string, cluster string"


def brute(rows):
    held = []
    for i, v, *_ in rows:
        if v is not None and len(v) == 64 and all(c is not None and np.isfinite(c) for c in v):
            held.append((i, [int(np.floor(1024 * float(np.float32(c)))) for c in v]))
    name = lambda i: hashlib.sha256(f"3:{'' if i is None else i}".encode()).hexdigest()
    centres = [x for _, x in sorted(held, key=lambda r: (name(r[0]), r[1]))[:8]]
    far = lambda x, c: sum((a - b) ** 2 for a, b in zip(x, c))
    assign = lambda: [min((far(x, c), j) for j, c in enumerate(centres)) for _, x in held]
    for _ in range(10):
        at = assign()
        for j in range(len(centres)):
            mine = [x for (_, x), (_, k) in zip(held, at) if k == j]
            if mine:
                centres[j] = [sum(c) // len(mine) for c in zip(*mine)]
    at = assign()
    sums = [sum(d for d, k in at if k == j) for j in range(len(centres))]
    names = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centres]
    return sorted(((i, k, d, sums[k], sum(sums), names[k]) for (i, _), (d, k) in zip(held, at)), key=str)


def query(spark, rows, folder):
    spark.createDataFrame(rows, SCHEMA).repartition(5).write.parquet(f"{folder}/embeddings.parquet")
    found = pivots.op12_pivot_clusters(spark, str(folder))
    assert found.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]
    return sorted(map(tuple, found.collect()), key=str)


def test_against_plain_rounds(spark, tmp_path, rng):
    centres = rng.normal(size=(6, 64))
    rows = [(i, [float(c) for c in centres[i % 6] + 0.2 * rng.normal(size=64)], 0, "", "", "") for i in range(240)]
    same = [(400 + i, rows[0][1], 0, "", "", "") for i in range(40)] + [rows[3], rows[3]]
    odd = [None, [], [1.0] * 63, [1.0] * 65, [None] + [0.0] * 63, [float("nan")] + [0.0] * 63, [float("inf")] * 64]
    rows += same + [(900 + i, v, 0, "", "", "") for i, v in enumerate(odd)] + [(None, [0.5] * 64, 0, "", "", ""), (950, [0.0] * 64, 0, "", "", "")]
    assert query(spark, rows, tmp_path) == brute(rows)


@pytest.mark.parametrize("n", [0, 1, 2, 5])
def test_few_vectors(spark, tmp_path, rng, n):
    rows = [(i, [float(c) for c in rng.normal(size=64)], 0, "", "", "") for i in range(n)]
    assert query(spark, rows, tmp_path) == brute(rows)


def test_all_equal(spark, tmp_path):
    rows = [(i, [0.25] * 64, 0, "", "", "") for i in range(30)]
    assert query(spark, rows, tmp_path) == brute(rows)


@pytest.mark.parametrize("most", [3, 1024, pivots.MOST])
def test_bounds_never_exceed_distances(rng, most):
    """Ties, points on centroids and components at the limit: no bound above the distance, results as without bounds."""
    x = rng.integers(-most, most + 1, (400, 64))
    x[:50] = x[0]
    centroids = np.concatenate([x[:3], x[60:64], x[100:101] + 1]).clip(-most, most)
    held = pivots.Pivots(x[[5, 60, 7, 8, 200, 201, 202, 61]])
    far = held.distances(x)
    exact = np.stack([pivots.squared(x, c) for c in centroids], 1)
    low = held.bounds(far, held.distances(centroids))
    assert (np.square(low) <= exact).all()
    which, best, taken = pivots.nearest(x, far, centroids, held)
    assert (which == exact.argmin(1)).all() and (best == exact.min(1)).all() and taken.max() <= len(centroids)


def test_bounds_spare_distances(rng):
    centres = rng.integers(-2000, 2000, (8, 64))
    x = np.repeat(centres, 100, 0) + rng.integers(-40, 41, (800, 64))
    held = pivots.Pivots(x[::100])
    taken = pivots.nearest(x, held.distances(x), centres, held)[2]
    assert taken.mean() < 3


def test_components_beyond_the_limit(spark):
    rows = [(1, [3e38] * 64, 0, "", "", ""), (2, [-3e38] * 64, 0, "", "", "")]
    found = pivots.clustered(spark.createDataFrame(rows, SCHEMA)).collect()
    assert [r["distance"] for r in found] == [0, 0] and len({r["cluster"] for r in found}) == 2
