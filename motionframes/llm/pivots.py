"""Centroid clustering of integer vectors; Ptolemy's inequality over fixed pivot pairs spares most distances."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from motionframes.llm.common import saved, table

SIZE, SCALE, CENTROIDS, ROUNDS, SEED = 64, 1024, 8, 10, 3
#: Components are held within these limits, so that a squared distance fits a long.
MOST = 1 << 27
#: How far a bound is lowered for its own rounding, as a part of what it was subtracted from: some 50 times the largest error.
SLACK = 1e-14
_LONGEST = (1 << 63) - 1


def kept_vectors(embeddings: DataFrame) -> DataFrame:
    """(vec_id, x): x is floor(SCALE * component), within MOST. Vectors of another size, null, or with a null or non-finite component go."""
    x = F.col("embedding").cast("array<double>")
    usable = (F.size(x) == SIZE) & F.forall(x, lambda v: v.isNotNull() & (F.abs(v) < float("inf")) & ~F.isnan(v))
    whole = lambda v: F.floor(F.greatest(F.least(v * SCALE, F.lit(float(MOST))), F.lit(float(-MOST)))).cast("int")
    return embeddings.where(F.coalesce(usable, F.lit(False))).select(F.col("vec_id").cast("long"), F.transform(x, whole).alias("x"))


def starts(vectors: DataFrame, k: int) -> np.ndarray:
    """The k vectors with the smallest hashes of seed and id; rows that share an id by their components, a null id counts as empty text."""
    name = F.sha2(F.concat(F.lit(f"{SEED}:"), F.coalesce(F.col("vec_id").cast("string"), F.lit(""))), 256)
    rows = vectors.select(name.alias("name"), "x").orderBy("name", "x").limit(k).collect()
    return np.array([r["x"] for r in rows], np.int64).reshape(-1, SIZE)


def squared(x: np.ndarray, to: np.ndarray) -> np.ndarray:
    apart = x - to
    return np.einsum("ij,ij->i", apart, apart)


class Pivots:
    """Fixed pivots; neighbours in the list are the pairs, pivots at the same place make none."""

    def __init__(self, at: np.ndarray):
        self.at = at
        near = np.sqrt(np.array([squared(at, p) for p in at]).reshape(len(at), len(at)))
        pairs = [(p, (p + 1) % len(at)) for p in range(len(at) if len(at) > 2 else len(at) - 1)]
        self.pairs = [(p, s, near[p, s]) for p, s in pairs if near[p, s] > 0]

    def distances(self, x: np.ndarray) -> np.ndarray:
        return np.sqrt(np.stack([squared(x, p) for p in self.at], 1).astype(np.float64)) if len(self.at) else np.zeros((len(x), 0))

    def bounds(self, far: np.ndarray, to: np.ndarray) -> np.ndarray:
        """No more than the distance between each row and each centroid, from what both have to the pivots.

        d(x, c) d(p, s) >= |d(x, p) d(c, s) - d(x, s) d(c, p)|, lowered by more than its rounding.
        """
        low = np.zeros((len(far), len(to)))
        for p, s, apart in self.pairs:
            a, b = far[:, p, None] * to[None, :, s], far[:, s, None] * to[None, :, p]
            np.maximum(low, (np.abs(a - b) - SLACK * (a + b)) / apart, out=low)
        return low * (1 - SLACK)


def nearest(x: np.ndarray, far: np.ndarray, centroids: np.ndarray, pivots: Pivots) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(centroid, squared distance, exact distances taken) of each row; ties go to the smaller number.

    The centroid with the smallest bound is measured first; the others only where their bound doesn't exceed the best so far.
    """
    low = pivots.bounds(far, pivots.distances(centroids))
    which, every = low.argmin(1), np.arange(len(x))
    best, taken = squared(x, centroids[which]), np.ones(len(x), np.int64)
    below = np.square(low) * (1 - SLACK)
    guess = which.copy()
    for j in range(len(centroids)):
        open_ = every[(guess != j) & (below[:, j] <= best)]
        d = squared(x[open_], centroids[j])
        taken[open_] += 1
        won = (d < best[open_]) | ((d == best[open_]) & (j < which[open_]))
        best[open_[won]], which[open_[won]] = d[won], j
    return which, best, taken


def _matrix(column: pa.Array, kind: type, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(kind).reshape(len(column), width)


class Clustering:
    """The vectors with their distances to the pivots, written once and read by every round."""

    def __init__(self, vectors: DataFrame, k: int = CENTROIDS):
        self.spark = vectors.sparkSession
        self.centroids = starts(vectors, k)
        self.pivots = pivots = Pivots(self.centroids.copy())

        def cached(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                far = pivots.distances(_matrix(batch["x"], np.int64, SIZE))
                ends = pa.array(np.arange(len(far) + 1, dtype=np.int32) * far.shape[1])
                yield batch.append_column("far", pa.ListArray.from_arrays(ends, pa.array(far.ravel())))

        self.vectors = saved(vectors.mapInArrow(cached, "vec_id long, x array<int>, far array<double>"), "pivot-distances")

    def _sums(self) -> dict[int, list[int]]:
        """Per centroid with vectors: their sum by component, then their number. A task gives one row a centroid, whatever it has read."""
        centroids, pivots = self.centroids, self.pivots

        def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = np.zeros((len(centroids), SIZE + 1), np.int64)
            for batch in batches:
                x = _matrix(batch["x"], np.int64, SIZE)
                which, _, _ = nearest(x, _matrix(batch["far"], np.float64, len(pivots.at)), centroids, pivots)
                for j in range(len(centroids)):
                    total[j, :SIZE] += x[which == j].sum(0)
                total[:, SIZE] += np.bincount(which, minlength=len(centroids))
            yield pa.record_batch({"cluster": np.repeat(np.arange(len(total)), SIZE + 1), "pos": np.tile(np.arange(SIZE + 1), len(total)), "v": total.ravel()})

        parts = self.vectors.select("x", "far").mapInArrow(partial, "cluster long, pos long, v long")
        rows = parts.groupBy("cluster", "pos").agg(F.sum(F.col("v").cast("decimal(38,0)")).alias("v")).collect()
        found: dict[int, list[int]] = {}
        for r in rows:
            found.setdefault(r["cluster"], [0] * (SIZE + 1))[r["pos"]] = int(r["v"])
        return {j: v for j, v in found.items() if v[SIZE]}

    def round(self) -> None:
        """Every centroid becomes the floor of its vectors' mean, exactly; one without vectors stays."""
        for j, v in self._sums().items():
            self.centroids[j] = [c // v[SIZE] for c in v[:SIZE]]

    def assigned(self) -> DataFrame:
        """(vec_id, cluster, distance, taken) under the present centroids."""
        centroids, pivots = self.centroids.copy(), self.pivots

        def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                which, best, taken = nearest(_matrix(batch["x"], np.int64, SIZE), _matrix(batch["far"], np.float64, len(pivots.at)), centroids, pivots)
                yield pa.record_batch({"vec_id": batch["vec_id"], "cluster": which.astype(np.int32), "distance": best, "taken": taken})

        return saved(self.vectors.mapInArrow(assign, "vec_id long, cluster int, distance long, taken long"), "assigned")


def clustered(embeddings: DataFrame, k: int = CENTROIDS, rounds: int = ROUNDS) -> DataFrame:
    """(vec_id, cluster, distance, taken, cluster_inertia, inertia, centroid_sha256) for every usable row of embeddings (vec_id, embedding).

    Fewer than k usable vectors give as many centroids; none gives an empty result. Each row counts, repeated ids and equal vectors too; a
    null id is a row like others. Components beyond 131,072 count as that. Sums that a long can't hold are returned as the largest long.
    Other columns are not read. The driver sees the centroids and their sums, k times SIZE numbers a round.
    """
    run = Clustering(kept_vectors(embeddings), k)
    if len(run.centroids):
        for _ in range(rounds):
            run.round()
    found = run.assigned()
    inertia = [0] * k
    for r in found.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("v")).collect():
        inertia[r["cluster"]] = int(r["v"])
    names = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in run.centroids.tolist()] + [""] * (k - len(run.centroids))
    of = lambda values: F.element_at(F.lit(values), F.col("cluster") + 1)
    return found.select(
        "*",
        of([min(v, _LONGEST) for v in inertia]).cast("long").alias("cluster_inertia"),
        F.lit(min(sum(inertia), _LONGEST)).cast("long").alias("inertia"),
        of(names).alias("centroid_sha256"),
    )


def op12_pivot_clusters(spark: SparkSession, folder: str) -> DataFrame:
    return clustered(table(spark, folder, "embeddings").select("vec_id", "embedding")).drop("taken")


def _sql() -> str:
    """Every distance in every round."""
    apart = "list_sum(list_transform(list_zip(v.x, c.x), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::BIGINT"
    near = lambda r: f"""a{r} AS MATERIALIZED (SELECT i, vec_id, x, j, d FROM (
  SELECT v.i, v.vec_id, v.x, c.j, {apart} AS d, row_number() OVER (PARTITION BY v.i ORDER BY {apart}, c.j) AS n FROM v, c{r} c) WHERE n = 1)"""  # noqa: E731
    mean = lambda r: f"""c{r + 1} AS MATERIALIZED (SELECT c.j, coalesce(m.x, c.x) AS x FROM c{r} c LEFT JOIN (
  SELECT j, list((s - (s % n + n) % n) // n ORDER BY p) AS x FROM (
    SELECT j, p, sum(y)::BIGINT AS s, count(*) AS n FROM (SELECT j, unnest(x) AS y, generate_subscripts(x, 1) AS p FROM a{r}) GROUP BY j, p) GROUP BY j) m USING (j))"""  # noqa: E731
    steps = [near(0)]
    for r in range(ROUNDS):
        steps += [mean(r), near(r + 1)]
    return f"""
WITH v AS MATERIALIZED (SELECT row_number() OVER () AS i, vec_id, list_transform(embedding, lambda y: floor({SCALE} * y::DOUBLE)::BIGINT) AS x FROM embeddings
  WHERE len(embedding) = {SIZE} AND len(list_filter(embedding, lambda y: y IS NOT NULL AND isfinite(y))) = {SIZE}),
c0 AS MATERIALIZED (SELECT (n - 1)::INT AS j, x FROM (
  SELECT x, row_number() OVER (ORDER BY sha256('{SEED}:' || coalesce(vec_id::VARCHAR, '')), x) AS n FROM v) WHERE n <= {CENTROIDS}),
{", ".join(steps)}
SELECT a.vec_id, a.j AS cluster, a.d AS distance, (sum(a.d) OVER (PARTITION BY a.j))::BIGINT AS cluster_inertia, (sum(a.d) OVER ())::BIGINT AS inertia,
       sha256(array_to_string(c.x, ',')) AS centroid_sha256
FROM a{ROUNDS} a JOIN c{ROUNDS} c USING (j)"""


OP12_SQL = _sql()
