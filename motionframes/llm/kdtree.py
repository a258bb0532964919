"""Exact top-k search by integer inner product: a KD-tree per shard, best-first, with a passed-on k-th result."""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from motionframes.llm.common import saved, table

#: Vectors in a shard at most (a task holds one shard), shards at least, vectors in a leaf, queries to a task.
SHARD_ROWS, MIN_SHARDS, LEAF_ROWS, TASK_QUERIES = 32_768, 6, 128, 200_000


class Tree:
    """Median splits along the widest side; a node knows its tight box and its smallest id."""

    def __init__(self, ids: np.ndarray, points: np.ndarray):
        order, self.child, lo, hi, least, self.span = np.argsort(ids, kind="stable"), [], [], [], [], []
        todo = [(0, len(ids), None)]
        while todo:
            start, end, parent = todo.pop()
            rows = order[start:end]
            box = points[rows]
            lo.append(box.min(0)), hi.append(box.max(0)), least.append(ids[rows].min())
            self.span.append((start, end)), self.child.append([])
            if parent is not None:
                self.child[parent].append(len(self.child) - 1)
            if end - start > LEAF_ROWS:
                middle = (end - start) // 2
                order[start:end] = rows[np.argpartition(box[:, int((hi[-1] - lo[-1]).argmax())], middle)]
                todo += [(start, start + middle, len(self.child) - 1), (start + middle, end, len(self.child) - 1)]
        self.lo, self.hi, self.least = np.array(lo), np.array(hi), np.array(least)
        self.ids, self.points = ids[order], points[order]

    def search(self, queries: np.ndarray, own: np.ndarray, k: int, kth: np.ndarray, kth_id: np.ndarray) -> Iterator[tuple[int, list]]:
        """For each query the results that may be among its k best: (score, -id), best first.

        A box's bound is the best inner product any point in it could have. A node is left out only
        if all it may hold loses to the k-th result so far, ids included, so that ties are exact
        and a crowd of equal vectors is not opened for nothing.
        """
        bounds = np.maximum(queries, 0) @ self.hi.T + np.minimum(queries, 0) @ self.lo.T
        for i, bound in enumerate(bounds):
            floor, best = (kth[i], -kth_id[i]), []
            heap = [(-bound[0], int(self.least[0]), 0)]
            while heap:
                most, least, node = heapq.heappop(heap)
                if (-most, -least) < floor:
                    break
                if self.child[node]:
                    for c in self.child[node]:
                        if (bound[c], -self.least[c]) >= floor:
                            heapq.heappush(heap, (-bound[c], int(self.least[c]), c))
                    continue
                start, end = self.span[node]
                scores = self.points[start:end] @ queries[i]
                for j in np.flatnonzero(scores >= floor[0]):
                    item = (scores[j], -int(self.ids[start + j]))
                    if item < floor or -item[1] == own[i]:
                        continue
                    if len(best) < k:
                        heapq.heappush(best, item)
                    elif item > best[0]:
                        heapq.heapreplace(best, item)
                    if len(best) == k:
                        floor = max(floor, best[0])
            yield i, sorted(best, reverse=True)


def _searcher(k: int):
    """Rows of one or more shards, each shard's own vectors (kind 0) before its queries (kind 1)."""

    def numbers(frame: pd.DataFrame) -> np.ndarray:
        return np.stack(frame["vector"].to_numpy()).astype(np.float64)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, shard, tree = [], None, None
        for batch in batches:
            for (key, kind), rows in batch.groupby(["cell", "kind"], sort=True):
                if key != shard:
                    held, shard, tree = [], key, None
                if kind == 0:
                    held.append(rows)
                    continue
                if tree is None:
                    if not held:
                        continue
                    own = pd.concat(held)
                    tree, held = Tree(own["vec_id"].to_numpy(), numbers(own)), []
                for at in range(0, len(rows), 1024):
                    part, out = rows.iloc[at : at + 1024], []
                    ids = part["vec_id"].to_numpy()
                    for i, best in tree.search(numbers(part), ids, k, part["kth"].to_numpy(), part["kth_id"].to_numpy()):
                        out += [(ids[i], -minus, int(score)) for score, minus in best]
                    yield pd.DataFrame(out, columns=["query_id", "vec_id", "score"]).astype("int64")

    return run


def top_k(vectors: DataFrame, is_query: Column, k: int) -> DataFrame:
    """(query_id, rank, vec_id, score): the k best of all other rows for each query, ties to the smaller id.

    vectors: vec_id and vector (array<long>); rows whose id or vector is null and vectors that are empty or hold
    a null take no part. A query meets vectors of its own length only. An empty table gives no rows, fewer
    candidates than k give fewer rows. A repeated id is one candidate per row, but a query never finds its own id;
    of the rows that share a query's id the smallest vector (in array order) asks. Other columns don't matter,
    whatever their names. Scores are exact while sums stay below 2^53.

    Every shard (hash of the id, at most about SHARD_ROWS vectors) becomes a tree in its task. First each
    query asks its own shard only; the k-th result found there then bounds what it wants from all others.
    """
    usable = F.col("vec_id").isNotNull() & (F.size("vector") > 0) & F.forall("vector", lambda x: x.isNotNull())
    held = saved(vectors.where(usable).select("vec_id", "vector", is_query.alias("q")), "kd-vectors")
    rows, asked = held.agg(F.count("*"), F.count_if("q")).first()
    shards, splits = max(MIN_SHARDS, -(-rows // SHARD_ROWS)), max(1, -(-asked // TASK_QUERIES))
    shard, split = F.pmod(F.xxhash64("vec_id"), F.lit(shards)), F.pmod(F.xxhash64("vec_id", F.lit(1)), F.lit(splits))

    def search(queries: DataFrame, shard_of: Column) -> DataFrame:
        none = [F.lit(-float("inf")).alias("kth"), F.lit(float("inf")).alias("kth_id")]
        columns = [F.xxhash64(F.col("s").cast("int"), F.col("p").cast("int"), F.size("vector")).alias("cell"), "kind", "vec_id", "vector", "kth", "kth_id"]
        everywhere = F.explode(F.sequence(F.lit(0), F.lit(splits - 1))).alias("p")
        own = held.select(shard.alias("s"), everywhere, F.lit(0).alias("kind"), "vec_id", "vector", *none).select(columns)
        ask = queries.select("*", shard_of.alias("s")).withColumns({"p": split, "kind": F.lit(1)}).select(columns)
        dealt = own.unionByName(ask).repartition(shards * splits, "cell").sortWithinPartitions("cell", "kind")
        return dealt.mapInPandas(_searcher(k), "query_id long, vec_id long, score long")

    ranked = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    queries = held.where("q").groupBy("vec_id").agg(F.min("vector").alias("vector"))
    blank = queries.withColumns({"kth": F.lit(-float("inf")), "kth_id": F.lit(float("inf"))})
    home = saved(search(blank, shard), "kd-home")
    worst = home.withColumn("rank", F.row_number().over(ranked)).where(F.col("rank") == k)
    bound = worst.select(F.col("query_id").alias("vec_id"), F.col("score").cast("double").alias("kth"), F.col("vec_id").cast("double").alias("kth_id"))
    known = queries.join(bound, "vec_id", "left").withColumns({"kth": F.coalesce("kth", F.lit(-float("inf"))), "kth_id": F.coalesce("kth_id", F.lit(float("inf")))})
    others = F.explode(F.array_except(F.sequence(F.lit(0), F.lit(shards - 1)), F.array(shard.cast("int"))))
    away = search(known, others)
    return (
        home.unionByName(away)
        .withColumn("rank", F.row_number().over(ranked))
        .where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )


def op2_exact_top_k(spark: SparkSession, folder: str) -> DataFrame:
    whole = F.size("embedding").alias("n")
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    given = table(spark, folder, "embeddings").select("vec_id", "embedding").where(F.col("embedding").isNotNull() & finite & (whole > 0))
    vectors = given.select("vec_id", F.transform("embedding", lambda x: F.floor(x.cast("double") * 64)).alias("vector"))
    return top_k(vectors, F.col("vec_id") % 20 == 0, 20)


OP2_SQL = """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)::BIGINT) AS e FROM embeddings
           WHERE vec_id IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
p AS (SELECT a.vec_id AS query_id, b.vec_id, list_inner_product(a.e::DOUBLE[], b.e::DOUBLE[])::BIGINT AS score
      FROM v a JOIN v b ON a.vec_id % 20 = 0 AND a.vec_id <> b.vec_id),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM p)
SELECT query_id, rank::INT AS rank, vec_id, score FROM r WHERE rank <= 20"""
