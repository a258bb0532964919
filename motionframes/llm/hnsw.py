"""Near-duplicate vectors: all cosines of a shard by blocked matrix products, checked in double precision."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from motionframes.llm.common import components, local_roots, saved, table

#: Vectors of a shard at most (a task holds one), shards at least, queries that a task answers.
SHARD_ROWS, MIN_SHARDS, TASK_QUERIES = 32_768, 6, 500_000
#: Queries that are multiplied with a shard at once.
BLOCK = 256
#: Neighbours chosen at insertion (twice as many are held), chance of a vector to be in the next layer, first beam.
DEGREE, UPPER, BEAM = 16, 1 / 16, 32
#: Vectors of a shard whose links are also found by brute force, and the recall that ends the widening.
AUDIT, RECALL = 256, 0.995


class Graph:
    """Layers of neighbour lists over unit vectors; each layer holds a sixteenth of the one below.

    The query doesn't use it: its links are nearly complete only, and at SHARD_ROWS vectors the whole product is faster.
    """

    def __init__(self, unit: np.ndarray, seed: int = 5):
        self.unit, n = unit.astype(np.float32), len(unit)
        level = np.floor(np.log(np.random.default_rng(seed).random(n) + 1e-12) / np.log(UPPER)).astype(int)
        order = np.argsort(-level, kind="stable")
        self.layers, held = [], np.zeros(0, np.int64)
        for height in range(level.max(initial=0), -1, -1):
            new = order[(level[order] == height)]
            links = np.full((n, 2 * DEGREE), -1, np.int32)
            members = np.concatenate([held, new])
            if len(members):
                self._fill(links, members)
                self.layers.append((links, members))
            held = members

    def _fill(self, links: np.ndarray, members: np.ndarray) -> None:
        """Inserts the members in batches, each no larger than what the layer already holds."""
        start = min(len(members), 2 * DEGREE)
        self._connect(links, members[:start], np.broadcast_to(members[:start], (start, start)))
        while start < len(members):
            batch = members[start : start + min(start, 512)]
            near, _ = self._beam(links, self.unit[batch], self._entries(batch, members[:start]), 2 * BEAM)
            near = np.concatenate([near, np.broadcast_to(batch, (len(batch), len(batch)))], 1)
            self._connect(links, batch, near)
            start += len(batch)

    def _entries(self, batch: np.ndarray, held: np.ndarray) -> np.ndarray:
        if not self.layers:
            return np.broadcast_to(held[:1], (len(batch), 1))
        return self._descend(self.unit[batch])

    def _descend(self, queries: np.ndarray, width: int = 4) -> np.ndarray:
        """The nearest vectors that the finished layers lead to, from the top."""
        links, members = self.layers[0]
        at = np.broadcast_to(members[:1], (len(queries), 1))
        for links, _ in self.layers:
            at, _ = self._beam(links, queries, at, width)
        return at

    def _connect(self, links: np.ndarray, nodes: np.ndarray, near: np.ndarray) -> None:
        """Links each node with candidates that are nearer to it than to those already chosen, in both directions."""
        for at in range(0, len(nodes), 128):
            block, options = nodes[at : at + 128], near[at : at + 128]
            links[block, :DEGREE] = self._choose(block, options, DEGREE)
        source = np.repeat(nodes, DEGREE)
        target = links[nodes, :DEGREE].ravel()
        source, target = source[target >= 0], target[target >= 0].astype(np.int64)
        order = np.argsort(target, kind="stable")
        source, target = source[order], target[order]
        for at in range(0, len(target), 1 << 15):
            cut = target[at : at + (1 << 15)]
            owners, first, counts = np.unique(cut, return_index=True, return_counts=True)
            extra = np.full((len(owners), counts.max()), -1, np.int64)
            extra[np.repeat(np.arange(len(owners)), counts), np.arange(len(cut)) - np.repeat(first, counts)] = source[at : at + len(cut)]
            for b in range(0, len(owners), 128):
                own = owners[b : b + 128]
                merged = np.concatenate([links[own], extra[b : b + 128]], 1)
                links[own] = self._choose(own, merged, 2 * DEGREE)

    def _choose(self, nodes: np.ndarray, options: np.ndarray, most: int) -> np.ndarray:
        close = np.matmul(self.unit[options], self.unit[nodes][:, :, None])[:, :, 0]
        close[(options < 0) | (options == nodes[:, None])] = -9
        width = min(options.shape[1], 3 * most)
        top = np.argsort(-close, 1, kind="stable")[:, :width]
        options, close = np.take_along_axis(options, top, 1), np.take_along_axis(close, top, 1)
        repeated = np.zeros(options.shape, bool)
        by_id = np.argsort(options, 1, kind="stable")
        same = np.take_along_axis(options, by_id, 1)
        np.put_along_axis(repeated, by_id[:, 1:], same[:, 1:] == same[:, :-1], 1)
        close[repeated] = -9
        points = self.unit[options]
        among = np.matmul(points, points.transpose(0, 2, 1))
        kept, shadow = np.zeros(close.shape, bool), np.full(close.shape, -9, np.float32)
        for c in range(width):
            kept[:, c] = (close[:, c] > -9) & (shadow[:, c] < close[:, c])
            shadow = np.where(kept[:, c, None], np.maximum(shadow, among[:, c]), shadow)
        rank = np.where(kept, 0, 1) + np.where(close > -9, 0, 5)
        pick = np.argsort(rank, 1, kind="stable")[:, :most]
        out = np.where(np.take_along_axis(rank, pick, 1) < 5, np.take_along_axis(options, pick, 1), -1)
        return np.pad(out, ((0, 0), (0, most - out.shape[1])), constant_values=-1).astype(np.int32)

    def _beam(self, links: np.ndarray, queries: np.ndarray, entries: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
        """The `width` nearest vectors met when all queries walk at once: (ids, similarities), -1 where there are fewer."""
        b, step = len(queries), max(2, width // 16)
        seen = np.zeros((b, len(self.unit) + 1), bool)
        ids = np.full((b, width), -1, np.int64)
        close, open_ = np.full((b, width), -9, np.float32), np.zeros((b, width), bool)
        fresh, live = entries[:, :width].astype(np.int64), np.arange(b)
        while len(live):
            # Entries of a row may repeat; only the first counts.
            order = np.argsort(fresh, 1, kind="stable")
            fresh = np.take_along_axis(fresh, order, 1)
            new = (fresh >= 0) & ~seen[live[:, None], fresh]
            new[:, 1:] &= fresh[:, 1:] != fresh[:, :-1]
            seen[live[:, None], fresh] = True
            value = np.where(new, np.matmul(self.unit[fresh], queries[live][:, :, None])[:, :, 0], -9).astype(np.float32)
            all_ids = np.concatenate([ids[live], fresh], 1)
            all_close = np.concatenate([close[live], value], 1)
            all_open = np.concatenate([open_[live], new], 1)
            top = np.argpartition(-all_close, width - 1, 1)[:, :width]
            ids[live], close[live] = np.take_along_axis(all_ids, top, 1), np.take_along_axis(all_close, top, 1)
            open_[live] = np.take_along_axis(all_open, top, 1)
            worth = np.where(open_[live], close[live], -9)
            pick = np.argpartition(-worth, min(step, width - 1), 1)[:, :step]
            going = np.take_along_axis(worth, pick, 1) > -9
            chosen = np.where(going, np.take_along_axis(ids[live], pick, 1), -1)
            rows = np.repeat(live, pick.shape[1])[going.ravel()]
            open_[rows, pick.ravel()[going.ravel()]] = False
            more = going.any(1)
            live, chosen = live[more], chosen[more]
            fresh = np.where(chosen[:, :, None] >= 0, links[chosen], -1).reshape(len(live), chosen.shape[1] * links.shape[1]).astype(np.int64)
        ids[close <= -9] = -1
        return ids, close

    def within(self, queries: np.ndarray, least: float, width: int) -> tuple[np.ndarray, np.ndarray]:
        """Pairs (query, vector) with about `least` similarity; a beam full of them is widened until it isn't."""
        found, todo = [], np.arange(len(queries))
        while len(todo):
            rest, size = [], max(8, 8192 // width)
            for at in range(0, len(todo), size):
                block = todo[at : at + size]
                ids, close = self._beam(self.layers[-1][0], queries[block], self._descend(queries[block]), min(width, max(1, len(self.unit))))
                hit = close >= least
                full = hit.all(1) & (width < len(self.unit))
                rest.append(block[full])
                i, j = np.nonzero(hit & ~full[:, None])
                found.append((block[i], ids[i, j]))
            todo, width = np.concatenate(rest), 4 * width
        if not found:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        return np.concatenate([f[0] for f in found]), np.concatenate([f[1] for f in found])

    def audited_width(self, least: float) -> int:
        """The beam at which evenly spaced members find RECALL of their links: doubled until it does or holds the shard."""
        width, n = BEAM, len(self.unit)
        tried = np.unique(np.linspace(0, n - 1, min(AUDIT, n)).astype(int))
        true = (self.unit[tried] @ self.unit.T >= least).sum()
        while width < n and len(self.within(self.unit[tried], least, width)[0]) < RECALL * true:
            width *= 2
        return width


def _unit(vectors: pd.Series) -> np.ndarray:
    v = np.stack(vectors.to_numpy()).astype(np.float64)
    v /= np.abs(v).max(1, keepdims=True)
    return v / np.sqrt((v * v).sum(1, keepdims=True))


def _linker(least: float):
    """Rows sorted by cell and kind: a shard's own vectors (0), then the queries (1)."""

    def answer(unit: np.ndarray, own: np.ndarray, ids: np.ndarray, weight: np.ndarray, rows: pd.DataFrame) -> pd.DataFrame:
        queries, asked = _unit(rows["vector"]), rows["id"].to_numpy()
        count, names, roots = np.zeros(len(asked), np.int64), [], []
        for i, j in _links(unit, own, queries, least):
            i, j = i[asked[i] != ids[j]], j[asked[i] != ids[j]]
            count += np.bincount(i, weights=weight[j], minlength=len(asked)).astype(np.int64)
            met, at = np.unique(np.concatenate([asked[i], ids[j]]), return_inverse=True)
            names.append(met)
            roots.append(met[local_roots(len(met), at[: len(i)], at[len(i) :])])
        names, roots = np.concatenate(names), np.concatenate(roots)
        met, at = np.unique(np.concatenate([names, roots]), return_inverse=True)
        root = met[local_roots(len(met), at[: len(names)], at[len(names) :])]
        linked = pd.DataFrame({"id": asked, "other": pd.NA, "n": count})[count > 0]
        star = pd.DataFrame({"id": met, "other": root, "n": 0})[met != root]
        return pd.concat([linked, star]).astype({"other": "Int64"})

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        cell, held, own = None, [], None
        for batch in batches:
            for (key, kind), rows in batch.groupby(["cell", "kind"], sort=True):
                if key != cell:
                    cell, held, own = key, [], None
                if kind == 0:
                    held.append(rows)
                    continue
                if own is None and held:
                    mine = pd.concat(held)
                    own, ids, weight, held = _unit(mine["vector"]), mine["id"].to_numpy(), mine["copies"].to_numpy(), []
                    unit = own.astype(np.float32)
                if own is not None:
                    for at in range(0, len(rows), 4096):
                        yield answer(unit, own, ids, weight, rows.iloc[at : at + 4096])

    return run


def _links(unit: np.ndarray, own: np.ndarray, queries: np.ndarray, least: float) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """All pairs (query, vector) with at least this cosine, a block of queries at a time: single precision (unit) finds them,
    double (own) decides."""
    for at in range(0, len(queries), BLOCK):
        i, j = np.nonzero(queries[at : at + BLOCK].astype(np.float32) @ unit.T >= least - 1e-5)
        i += at
        good = [np.einsum("nd,nd->n", queries[i[a : a + 65536]], own[j[a : a + 65536]]) >= least for a in range(0, len(i), 65536)]
        good = np.concatenate(good or [np.zeros(0, bool)])
        yield i[good], j[good]


def near_vectors(vectors: DataFrame, least: float) -> DataFrame:
    """(vec_id, n_links, component_id, kept) for every row of vectors (vec_id, embedding).

    Null, zero and empty vectors and those with null or non-finite parts link with nothing. Vectors of different lengths aren't compared.
    Equal vectors are one node with a count, so n copies cost one search. A row with a null vec_id has no links, a null component
    and is kept; rows that share a vec_id are one node, and each counts.

    Every vector asks every shard (hash of the id, at most about SHARD_ROWS vectors), which a task multiplies with blocks of
    them, so no link is missed. What a task returns grows with its vectors,
    not its pairs: a count for each query, and for each linked vector its root within the task.
    """
    parts = F.col("embedding")
    finite = F.forall(parts, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists(parts, lambda x: x != 0)
    given = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.when(finite, F.transform(parts, lambda x: x.cast("double"))).alias("vector"))
    usable = given.where("vec_id is not null and vector is not null")
    nodes = saved(usable.groupBy("vector").agg(F.min("vec_id").alias("id"), F.count("*").alias("copies")), "graph-nodes")
    n = nodes.count()
    shards, splits = max(MIN_SHARDS, -(-n // SHARD_ROWS)), max(1, -(-n // TASK_QUERIES))
    kinds = nodes.withColumn("length", F.size("vector"))
    shard = F.pmod(F.xxhash64("id"), F.lit(shards)).cast("int").alias("s")
    split = F.pmod(F.xxhash64("id", F.lit(1)), F.lit(splits)).cast("int").alias("p")
    cell = F.xxhash64("s", "p", "length").alias("cell")
    own = kinds.select("*", shard, F.explode(F.sequence(F.lit(0), F.lit(splits - 1))).alias("p")).select(cell, F.lit(0).alias("kind"), "id", "copies", "vector")
    ask = kinds.select("*", split, F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("s")).select(cell, F.lit(1).alias("kind"), "id", "copies", "vector")
    dealt = own.unionByName(ask).repartition(shards * splits, "cell").sortWithinPartitions("cell", "kind")
    found = saved(dealt.mapInPandas(_linker(least), "id long, other long, n long"), "graph-links")
    counts = found.where("other is null").groupBy("id").agg(F.sum("n").alias("links"))
    same = usable.groupBy("vector").agg(F.min("vec_id").alias("id"), F.count("*").alias("copies")).where("copies > 1")
    members = usable.join(same, "vector").where("vec_id <> id").select(F.col("vec_id").alias("src"), F.col("id").alias("dst"))
    stars = found.where("other is not null").select(F.col("id").alias("src"), F.col("other").alias("dst"))
    roots = components(stars.unionByName(members)).select(F.col("id").alias("vec_id"), "component")
    copies = same.select("vector", F.col("id").alias("rep"), "copies")
    rows = given.join(copies, "vector", "left").withColumn("id", F.when(F.col("vector").isNotNull(), F.coalesce("rep", "vec_id")))
    rows = rows.join(counts, "id", "left").join(roots, "vec_id", "left")
    component = F.coalesce("component", "vec_id")
    links = F.when(F.col("vec_id").isNotNull() & F.col("vector").isNotNull(), F.coalesce("links", F.lit(0)) + F.coalesce("copies", F.lit(1)) - 1).otherwise(0)
    return rows.select("vec_id", links.cast("long").alias("n_links"), component.alias("component_id"), F.coalesce(F.col("vec_id") == component, F.lit(True)).alias("kept"))


def op7_near_vectors(spark: SparkSession, folder: str) -> DataFrame:
    return near_vectors(table(spark, folder, "embeddings"), 0.9)


OP7_SQL = """
WITH RECURSIVE v AS (SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings WHERE vec_id IS NOT NULL AND len(embedding) > 0
  AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND list_inner_product(embedding, embedding) > 0),
l AS (SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.vec_id <> b.vec_id AND list_cosine_similarity(a.e, b.e) >= 0.9),
n AS (SELECT a, count(*) AS n_links FROM l GROUP BY a),
r AS (SELECT a AS vec_id, a AS root FROM n UNION SELECT l.b, r.root FROM r JOIN l ON l.a = r.vec_id WHERE r.root < l.b),
c AS (SELECT vec_id, min(root) AS component_id FROM r GROUP BY vec_id)
SELECT e.vec_id, coalesce(n_links, 0)::BIGINT AS n_links, coalesce(component_id, e.vec_id) AS component_id,
  coalesce(component_id, e.vec_id) = e.vec_id AS kept
FROM embeddings e LEFT JOIN n ON n.a = e.vec_id LEFT JOIN c ON c.vec_id = e.vec_id"""
