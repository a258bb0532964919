"""Helpers that several operators share: hold-out rule, written intermediates, components, hashed lookups."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from motionframes.session import checkpoint_dir

#: Bytes that end a word: space, tab, line feed, vertical tab, form feed, carriage return.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def remainder(doc_id: Column, n: int) -> Column:
    """crc32 of the id as text, modulo n; a null id counts as empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % n


def shared_folder(spark: SparkSession, name: str) -> str:
    return f"{checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}"


def saved(frame: DataFrame, name: str) -> DataFrame:
    """The frame, written to the shared folder and read back: a lost executor recomputes nothing before it."""
    spark = frame.sparkSession
    path = shared_folder(spark, name)
    frame.write.parquet(path)
    return spark.read.schema(frame.schema).parquet(path)


def checkpointed(frame: DataFrame) -> DataFrame:
    checkpoint_dir(frame.sparkSession)
    return frame.checkpoint()


def components(edges: DataFrame) -> DataFrame:
    """(id, component) for every id in the edges (src, dst): component is the smallest id reachable.

    Each round points every vertex at its smallest neighbour (or itself) and contracts the graph along
    the pointers, which at least halves it; the pointers of all rounds, composed, give the component.
    A hub costs one partially aggregated minimum and plain joins that Spark may split.
    """
    both = edges.where("src <> dst").select("src", "dst")
    graph = checkpointed(both.unionByName(both.select(F.col("dst").alias("src"), F.col("src").alias("dst"))).distinct())
    found = None
    while True:
        to = checkpointed(graph.groupBy("src").agg(F.least("src", F.min("dst")).alias("to")))
        if found is None:
            found = to.select(F.col("src").alias("id"), F.col("to").alias("component"))
        else:
            nxt = to.select(F.col("src").alias("component"), "to")
            found = found.join(nxt, "component", "left").select("id", F.coalesce("to", "component").alias("component"))
        if graph.isEmpty():
            return found
        left, right = to.select("src", F.col("to").alias("a")), to.select(F.col("src").alias("dst"), F.col("to").alias("b"))
        graph = checkpointed(
            graph.join(left, "src").join(right, "dst").where("a <> b").select(F.col("a").alias("src"), F.col("b").alias("dst")).distinct()
        )


def local_roots(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Root of each of n items after joining the pairs (a, b); the smallest index is the root."""
    root = np.arange(n)
    while len(a):
        low = np.minimum(root[a], root[b])
        was = root.copy()
        np.minimum.at(root, root[a], low)
        np.minimum.at(root, root[b], low)
        while (root != root[root]).any():
            root = root[root]
        if (was == root).all():
            return root
        keep = root[a] != root[b]
        a, b = a[keep], b[keep]
    return root


class Lookup:
    """Open addressing over distinct uint64 keys: positions of many keys at once, -1 where absent."""

    def __init__(self, keys: np.ndarray):
        keys = np.ascontiguousarray(keys, dtype=np.uint64)
        self.bits = max(4, int(2 * len(keys) + 1).bit_length())
        size = 1 << self.bits
        self.key, self.at = np.zeros(size, np.uint64), np.full(size, -1, np.int32)
        todo, slot = np.arange(len(keys), dtype=np.int32), self._slot(keys)
        while len(todo):
            free = self.at[slot] < 0
            first, where = np.unique(slot[free], return_index=True)
            won = todo[free][where]
            self.key[first], self.at[first] = keys[won], won
            lost = self.at[slot] != todo
            todo, slot = todo[lost], (slot[lost] + 1) & (size - 1)

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            return ((keys * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def __call__(self, keys: np.ndarray) -> np.ndarray:
        slot = self._slot(keys)
        out = np.where(self.key[slot] == keys, self.at[slot], -1)
        open_ = np.flatnonzero((out < 0) & (self.at[slot] >= 0))
        slot = slot[open_]
        while len(open_):
            slot = (slot + 1) & (len(self.at) - 1)
            hit = (self.key[slot] == keys[open_]) & (self.at[slot] >= 0)
            out[open_[hit]] = self.at[slot[hit]]
            more = ~hit & (self.at[slot] >= 0)
            open_, slot = open_[more], slot[more]
        return out


def slices(texts: list[str | None], most: int = 1 << 22) -> Iterator[list[str | None]]:
    """The texts in order, in lists of about `most` characters."""
    out, size = [], 0
    for text in texts:
        out.append(text)
        size += len(text or "") + 1
        if size >= most:
            yield out
            out, size = [], 0
    if out:
        yield out
