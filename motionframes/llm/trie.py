"""Conversation prefix trie: balanced parentheses per shard, subtrees by findclose, open paths merged across shards.

Every ordered pass deals its rows by ranges of its sort key, so a conversation or a node with a third of all rows is
cut like any other stretch; what a partition must know of those before it is one row a partition.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from motionframes.llm.common import saved, table

#: Each conversation borrows less than BORROW turns, from the first of its GROUP.
BORROW, GROUP = 9, 5
#: Nodes of a shard; conversation ids of one string on their way to a hash; depths of a branch that meet its row in one task.
SHARD, IDS, SPAN = 1 << 18, 1 << 16, 1 << 16
#: Prefixes are told apart by two sums of 61 bits.
BITS = (1 << 61) - 1
_ROOT = bytes(32)


def _ranged(rows: DataFrame, *order) -> DataFrame:
    """rows dealt by ranges of a unique order and sorted, with the number of their partition."""
    return rows.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("part", F.spark_partition_id())


def ordered(conversations: DataFrame) -> DataFrame:
    """(conv_id, at, n, digest, bytes): a conversation's turns numbered from 0 and counted; digest stands for role and text.

    Turns go in the order of turn, null first; turns with an equal one by role, then by digest. A null role or text is empty; rows without
    conv_id belong to no conversation.
    """
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    digest = F.unhex(F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text), 256))
    turns = conversations.where("conv_id is not null").select(
        F.col("conv_id").cast("long"), "turn", role.alias("role"), digest.alias("digest"), F.octet_length(text).cast("long").alias("bytes")
    )
    rows = _ranged(turns, "conv_id", F.asc_nulls_first("turn"), "role", "digest").withColumn("place", F.monotonically_increasing_id())
    rows = saved(rows.drop("turn", "role"), "trie-turns")
    parts = rows.groupBy("conv_id", "part").agg(F.min("place").alias("first"), F.count("*").alias("here"))
    one = Window.partitionBy("conv_id")
    before = F.sum("here").over(one.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    parts = parts.select("conv_id", "part", (F.col("first") - F.coalesce(before, F.lit(0))).alias("zero"), F.sum("here").over(one).alias("n"))
    return rows.join(parts, ["conv_id", "part"]).select("conv_id", (F.col("place") - F.col("zero")).alias("at"), "n", "digest", "bytes")


def rebuilt(turns: DataFrame) -> DataFrame:
    """(conv_id, depth, digest, bytes, last) of every rebuilt conversation, with a row of depth 0 for its start; last marks its end."""
    convs = turns.where("at = 0").select("conv_id", "n").withColumn("h", F.crc32(F.col("conv_id").cast("string")) % BORROW)
    convs = convs.withColumn("base", F.col("conv_id") - F.col("conv_id") % GROUP)
    bases = convs.where("conv_id = base").select("base", F.col("n").alias("base_n"))
    convs = convs.join(bases, "base", "left").withColumn("taken", F.least("h", F.coalesce("base_n", F.lit(0))))
    convs = saved(convs.withColumn("length", F.col("taken") + F.greatest(F.col("n") - F.col("h"), F.lit(0))), "trie-conversations")
    root = convs.select("conv_id", F.lit(0).cast("long").alias("depth"), F.lit(_ROOT).alias("digest"), F.lit(0).cast("long").alias("bytes"), (F.col("length") == 0).alias("last"))
    first = turns.where((F.col("at") < BORROW - 1) & (F.col("conv_id") % GROUP == 0)).select(F.col("conv_id").alias("base"), "at", "digest", "bytes")
    depth = F.col("at") + 1
    borrowed = convs.join(first, "base").where("at < taken").select("conv_id", depth.alias("depth"), "digest", "bytes", (depth == F.col("length")).alias("last"))
    # How far own turns move is 0 unless the base is shorter than what is borrowed; a row of it a stretch of turns, so that no conversation is one key.
    moved = convs.where("taken < h").select("conv_id", (F.col("h") - F.col("taken")).alias("less"), F.explode(F.expr(f"sequence(0L, n div {SPAN})")).alias("span"))
    own = turns.where(F.col("at") >= F.crc32(F.col("conv_id").cast("string")) % BORROW).withColumn("span", F.expr(f"at div {SPAN}"))
    own = own.join(moved, ["conv_id", "span"], "left")
    own = own.select("conv_id", (depth - F.coalesce("less", F.lit(0))).alias("depth"), "digest", "bytes", (F.col("at") == F.col("n") - 1).alias("last"))
    return root.unionByName(borrowed).unionByName(own)


def _mixed(x: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _starts(*columns: np.ndarray) -> np.ndarray:
    """Where a row differs from the one before it; the first row does."""
    new = np.ones(len(columns[0]), bool)
    new[1:] = np.any([c[1:] != c[:-1] for c in columns], axis=0)
    return new


def _column(batch: pa.RecordBatch, name: str) -> np.ndarray:
    return batch[name].to_numpy(zero_copy_only=False)


def _sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums of the turns' hashes from a conversation's first row in the partition on."""
    conv, held = None, np.zeros(2, np.uint64)
    for batch in batches:
        if not batch.num_rows:
            continue
        ids, depth = _column(batch, "conv_id"), _column(batch, "depth").astype(np.uint64)
        words = np.frombuffer(b"".join(batch["digest"].to_pylist()), "<u8").reshape(-1, 4)
        with np.errstate(over="ignore"):
            each = np.stack([_mixed(words[:, k] + _mixed(depth * np.uint64(2 * k + 3))) for k in (0, 1)], 1)
            run = np.cumsum(each, 0)
            at = np.flatnonzero(_starts(ids))
            base = run[at] - each[at]
            if ids[0] == conv:
                base[0] -= held
            run -= np.repeat(base, np.diff(np.append(at, len(ids))), axis=0)
        conv, held = ids[-1], run[-1].copy()
        kept = (run & np.uint64(BITS)).astype(np.int64)
        yield pa.record_batch({**{c: batch[c] for c in ("conv_id", "depth", "bytes", "last", "part")}, "s1": kept[:, 0].copy(), "s2": kept[:, 1].copy()})


def prefixes(paths: DataFrame) -> DataFrame:
    """(conv_id, depth, s1, s2, bytes, last): s1 and s2 are equal for equal sequences of turns up to a depth, and for no others."""
    local = _ranged(paths, "conv_id", "depth").mapInArrow(_sums, "conv_id long, depth long, bytes long, last boolean, part int, s1 long, s2 long")
    local = saved(local, "trie-sums")
    parts = local.groupBy("conv_id", "part").agg(*[F.max_by(s, "depth").cast("decimal(38,0)").alias(s) for s in ("s1", "s2")])
    before = Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    carried = parts.select("conv_id", "part", *[(F.sum(s).over(before) % (BITS + 1)).cast("long").alias(f"c{s}") for s in ("s1", "s2")]).where("cs1 is not null")
    rows = local.join(carried, ["conv_id", "part"], "left")
    whole = [(F.col(s) + F.coalesce(f"c{s}", F.lit(0))).bitwiseAND(F.lit(BITS)).alias(s) for s in ("s1", "s2")]
    return rows.select("conv_id", "depth", *whole, "bytes", "last")


def _smallest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The smallest member of a row's node in this partition; head marks rows of the node that the partition begins with."""
    node, member, head = None, 0, True
    for batch in batches:
        if not batch.num_rows:
            continue
        ids, keys = _column(batch, "conv_id"), [_column(batch, c) for c in ("depth", "s1", "s2")]
        new = _starts(*keys)
        new[0] = node != tuple(k[0] for k in keys)
        first = np.concatenate([[member], ids[new]])[np.cumsum(new)]
        number = np.cumsum(new)
        heads = (number == 0) & head if node is not None else number == 1
        node, member, head = tuple(k[-1] for k in keys), first[-1], bool(heads[-1])
        yield pa.record_batch({**{c: batch[c] for c in ("conv_id", "depth", "s1", "s2", "bytes", "part")}, "member": first, "head": heads})


def _listed(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[pa.RecordBatch]:
    """The ids of each node's rows as text, at most `most` of them a string."""
    piece = 0
    for batch in batches:
        keys = [_column(batch, c) for c in ("depth", "s1", "s2")]
        cut = sorted({*np.flatnonzero(_starts(*keys)).tolist(), *range(0, batch.num_rows, most), batch.num_rows}) if batch.num_rows else [0]
        ids = batch["conv_id"].cast(pa.string()).to_pylist()
        at = np.array(cut[:-1], np.int64)
        text = [",".join(ids[a:b]) for a, b in zip(cut, cut[1:])]
        columns = {c: pa.array(k[at], pa.int64()) for c, k in zip(("depth", "s1", "s2"), keys)}
        yield pa.record_batch({**columns, "part": batch["part"].take(pa.array(at)), "piece": pa.array(np.arange(piece, piece + len(at))), "ids": pa.array(text, pa.string())})
        piece += len(at)


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One digest a node over its strings in order, holding one string at a time."""
    node, state = None, None
    for batch in batches:
        out = []
        for *key, ids in zip(*[batch[c].to_pylist() for c in ("depth", "s1", "s2", "ids")]):
            if key == node:
                state.update(b",")
            else:
                if node is not None:
                    out.append((*node, state.hexdigest()))
                node, state = key, hashlib.sha256()
            state.update(ids.encode())
        yield _digests(out)
    if node is not None:
        yield _digests([(*node, state.hexdigest())])


def _digests(rows: list[tuple]) -> pa.RecordBatch:
    columns = zip(*rows) if rows else ([], [], [], [])
    return pa.record_batch({c: pa.array(v, pa.string() if c == "ends" else pa.int64()) for c, v in zip(("depth", "s1", "s2", "ends"), columns)})


def ended(paths: DataFrame, most: int = IDS) -> DataFrame:
    """(depth, s1, s2, ends): the hash of the ids of the conversations that end at a node, ascending. A hash of one long text has no parallel
    form, so a node's ids reach one task, as strings of up to `most` ids, and pass through it as a stream."""
    node = ["depth", "s1", "s2"]
    rows = _ranged(paths.where("last").select("conv_id", *node), *node, "conv_id")
    listed = rows.mapInArrow(lambda batches: _listed(batches, most), "depth long, s1 long, s2 long, part int, piece long, ids string")
    return listed.repartition(*node).sortWithinPartitions(*node, "part", "piece").mapInArrow(_hashed, "depth long, s1 long, s2 long, ends string")


class Parentheses:
    """A sequence of parentheses (1 opens); blocks of its excess with their least and largest value, and a tree over the blocks."""

    BLOCK = 64

    def __init__(self, bits: np.ndarray):
        self.excess = np.cumsum(2 * bits.astype(np.int64) - 1)
        blocks = 1 << max(0, (-(-max(1, len(bits)) // self.BLOCK) - 1).bit_length())
        padded = np.full(blocks * self.BLOCK, np.iinfo(np.int64).max)
        padded[: len(bits)] = self.excess
        self.rows = padded.reshape(-1, self.BLOCK)
        low, high = self.rows.min(1), np.where(self.rows == np.iinfo(np.int64).max, np.iinfo(np.int64).min, self.rows).max(1)
        self.levels = [(low, high)]
        while len(low) > 1:
            low, high = low.reshape(-1, 2).min(1), high.reshape(-1, 2).max(1)
            self.levels.append((low, high))

    def _within(self, level: int, node: np.ndarray, target: np.ndarray) -> np.ndarray:
        low, high = self.levels[level]
        return (low[node] <= target) & (target <= high[node])

    def _in_block(self, block: np.ndarray, after: np.ndarray, target: np.ndarray) -> np.ndarray:
        """First place of the target in a block behind a place in it; -1 where there is none."""
        out = np.full(len(block), -1)
        for s in range(0, len(block), 1 << 14):
            part = slice(s, s + (1 << 14))
            hit = (self.rows[block[part]] == target[part, None]) & (np.arange(self.BLOCK) > after[part, None])
            out[part] = np.where(hit.any(1), block[part] * self.BLOCK + hit.argmax(1), -1)
        return out

    def findclose(self, opens: np.ndarray) -> np.ndarray:
        """Where the parentheses opened at these places close; -1 where the sequence ends before."""
        target, block = self.excess[opens] - 1, opens // self.BLOCK
        out = self._in_block(block, opens % self.BLOCK, target)
        todo = np.flatnonzero(out < 0)
        node, level = block[todo], np.full(len(todo), -1)
        climbing, at = np.arange(len(todo)), node.copy()
        for k in range(len(self.levels) - 1):
            beside = at[climbing] + 1
            hit = (at[climbing] % 2 == 0) & self._within(k, np.minimum(beside, len(self.levels[k][0]) - 1), target[todo[climbing]])
            node[climbing[hit]], level[climbing[hit]] = beside[hit], k
            climbing = climbing[~hit]
            at[climbing] >>= 1
        for k in range(len(self.levels) - 1, 0, -1):
            down = np.flatnonzero(level == k)
            left = node[down] * 2
            node[down] = np.where(self._within(k - 1, left, target[todo[down]]), left, left + 1)
            level[down] = k - 1
        met = np.flatnonzero(level == 0)
        out[todo[met]] = self._in_block(node[met], np.full(len(met), -1), target[todo[met]])
        return out


_OUT = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "ends")
_ROWS = (
    "kind string, shard long, conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, ends string, upto long, n_leaves long, saved long, open boolean"
)


def encoded(nodes: pa.Table, shard: int) -> Iterator[pa.RecordBatch]:
    """Rows of kind node, close and shard from a shard's nodes in preorder.

    node: leaf pairs and savings of the subtree, or, where it is still open at the shard's end, those before it.
    close: a stretch of depths (depth to upto) that earlier shards left open and a node here ends, with those
    before that node; upto is null at the first node, whose stretch reaches as deep as the shard before ended.
    shard: how deep the path is open at the end (upto), and the totals.
    """
    n = nodes.num_rows
    depth, children = nodes["depth"].to_numpy(), nodes["n_children"].to_numpy()
    weight = (nodes["n_convs"].to_numpy() - 1) * nodes["bytes"].to_numpy()
    closes = np.concatenate([[0], depth[:-1] - depth[1:] + 1])
    at = np.arange(n) + np.cumsum(closes)
    last = children[-1] == 0
    bits = np.zeros(at[-1] + 1 + last, np.int8)
    bits[at] = 1
    leaf = np.concatenate([[0], np.cumsum((bits[:-1] == 1) & (bits[1:] == 0)), [0]])[: len(bits)]
    before = np.concatenate([[0], np.cumsum(weight)])
    opened = np.cumsum(bits) - bits
    close = Parentheses(bits).findclose(at)
    is_open = close < 0
    leaves = np.where(is_open, leaf[at], leaf[close] - leaf[at])
    saves = np.where(is_open, before[:-1], before[opened[close]] - before[:-1])
    yield _rows("node", shard, n, **{c: nodes[c].combine_chunks() for c in _OUT}, n_leaves=leaves, saved=saves, open=is_open)
    least = np.minimum.accumulate(depth)
    ends = np.flatnonzero(np.concatenate([[True], depth[1:] < least[:-1]]))
    upto = pa.array([None, *(least[ends[1:] - 1] - 1).tolist()], pa.int64())
    yield _rows("close", shard, len(ends), depth=depth[ends], upto=upto, n_leaves=leaf[at[ends]], saved=before[ends])
    pairs = int(((bits[:-1] == 1) & (bits[1:] == 0)).sum())
    yield _rows("shard", shard, 1, upto=np.array([depth[-1] - last]), n_leaves=np.array([pairs]), saved=before[-1:])


def _rows(kind: str, shard: int, n: int, **given) -> pa.RecordBatch:
    types = {"kind": pa.string(), "ends": pa.string(), "open": pa.bool_()}
    given |= {"kind": pa.array([kind] * n), "shard": pa.array([shard] * n, pa.int64())}
    names = [c.split(" ")[0] for c in _ROWS.split(", ")]
    return pa.record_batch({c: pa.array(given[c]) if c in given else pa.nulls(n, types.get(c, pa.int64())) for c in names})


def _shards(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    """Shards of at most `size` nodes, cut from a partition as it is read."""
    held, rows, piece = [], 0, 0
    for batch in batches:
        while batch.num_rows:
            taken = batch.slice(0, size - rows)
            batch, rows = batch.slice(taken.num_rows), rows + taken.num_rows
            held.append(taken)
            if rows == size:
                yield from encoded(pa.Table.from_batches(held), (held[0]["part"][0].as_py() << 32) + piece)
                held, rows, piece = [], 0, piece + 1
    if rows:
        yield from encoded(pa.Table.from_batches(held), (held[0]["part"][0].as_py() << 32) + piece)


def preordered(paths: DataFrame) -> DataFrame:
    """The trie's nodes with their order: (conv_id, depth, parent_conv_id, n_convs, n_children, ends, bytes, branch).

    Nodes with the same smallest member are one path downwards, a branch. With the children of a node in the
    order of their members, a branch's nodes follow each other in preorder, and a branch is placed by the
    stretches its conversation passes on other branches, each by where it was left (deeper first) and for
    whom. That list is as long as branches are nested, and a conversation nested k deep has k turns: all lists
    together are no longer than the conversations, the longest is below the root of twice their turns.
    """
    node = ["depth", "s1", "s2"]
    paths = saved(prefixes(paths), "trie-prefixes")
    rows = _ranged(paths.drop("last"), *node, "conv_id").mapInArrow(
        _smallest, "conv_id long, depth long, s1 long, s2 long, bytes long, part int, member long, head boolean"
    )
    rows = saved(rows, "trie-members")
    nodes = saved(rows.groupBy(*node).agg(F.min("member").alias("member"), F.count("*").alias("n_convs"), F.max("bytes").alias("bytes")), "trie-nodes")
    # A node that goes on from one partition to the next has its smallest member in the earlier one.
    heads = rows.where("head").groupBy("part", *node).agg(F.min("member").alias("here")).join(nodes, node).where("member < here")
    rows = rows.join(heads.select("part", F.lit(True).alias("head"), F.col("member").alias("true")), ["part", "head"], "left")
    passed = rows.withColumn("member", F.coalesce("true", "member")).groupBy("conv_id", "member").agg(F.min("depth").alias("top"), F.max("depth").alias("end"))
    chain = passed.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("member", "top", "end"))).alias("chain"))
    own = F.element_at("chain", -1)
    key = F.transform(F.expr("slice(chain, 2, size(chain))"), lambda c: F.struct((-c["top"]).alias("up"), c["member"].alias("member")))
    branches = chain.where(own["member"] == F.col("conv_id")).select(
        F.col("conv_id").alias("member"), F.try_element_at("chain", F.lit(-2))["member"].alias("parent"), own["top"].alias("top"), own["end"].alias("end"), key.alias("key")
    )
    branches = branches.repartitionByRange("key").sortWithinPartitions("key").withColumn("branch", F.monotonically_increasing_id()).drop("key")
    branches = saved(branches, "trie-branches")
    beside = branches.where("parent is not null").groupBy(F.col("parent").alias("member"), (F.col("top") - 1).alias("depth")).agg(F.count("*").alias("beside"))
    spans = branches.withColumn("span", F.explode(F.expr(f"sequence(top div {SPAN}, end div {SPAN})")))
    found = nodes.withColumn("span", F.expr(f"depth div {SPAN}")).join(spans, ["member", "span"])
    found = found.join(beside, ["member", "depth"], "left").join(ended(paths), node, "left")
    return found.select(
        F.col("member").alias("conv_id"),
        "depth",
        F.when(F.col("depth") > F.col("top"), F.col("member")).otherwise(F.col("parent")).alias("parent_conv_id"),
        "n_convs",
        ((F.col("depth") < F.col("end")).cast("long") + F.coalesce("beside", F.lit(0))).alias("n_children"),
        F.coalesce("ends", F.lit(hashlib.sha256().hexdigest())).alias("ends"),
        "bytes",
        "branch",
    )


def trie(paths: DataFrame, size: int = SHARD) -> DataFrame:
    """One row per node of the trie of paths (conv_id, depth, digest, bytes, last; a row of depth 0 for each conversation).

    (conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256). Shards are
    stretches of the preorder, of at most `size` nodes. A subtree that ends inside its shard is measured there. For the others, the path
    left open at a shard's end, opening and closing are matched by depth: at most one path is open at a time,
    so a depth has no more than two rows a shard, and what lies between is a difference of sums over all
    shards before.
    """
    rows = saved(_ranged(preordered(paths), "branch", "depth").mapInArrow(lambda batches: _shards(batches, size), _ROWS), "trie-shards")
    along = Window.orderBy("shard")  # one row a shard
    before = lambda c: F.coalesce(F.sum(c).over(along.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    shards = rows.where("kind = 'shard'").select(
        "shard", F.lag("upto").over(along).alias("left_open"), before("n_leaves").alias("leaves_before"), before("saved").alias("saved_before")
    )
    total = rows.where("kind = 'shard'").agg(F.sum("n_leaves"), F.sum("saved")).first()
    leaves, saves = (F.col("leaves_before") + F.col("n_leaves")).alias("leaves"), (F.col("saved_before") + F.col("saved")).alias("saves")
    met = rows.where("kind = 'close' or open").join(shards, "shard")
    closes = met.where("kind = 'close'").withColumn("upto", F.coalesce("upto", "left_open")).where("upto >= depth")
    closes = closes.select("shard", F.explode(F.sequence("depth", "upto")).alias("depth"), F.lit(0).alias("opens"), leaves, saves)
    opens = met.where("open").select("shard", "depth", F.lit(1).alias("opens"), leaves, saves)
    at_depth = Window.partitionBy("depth").orderBy("shard", "opens")
    until = lambda c, end: F.coalesce(F.lead(c).over(at_depth), F.lit(end)) - F.col(c)
    merged = closes.unionByName(opens).select("shard", "depth", "opens", until("leaves", total[0]).alias("all_leaves"), until("saves", total[1]).alias("all_saved"))
    merged = merged.where("opens = 1").select("shard", "depth", F.lit(True).alias("open"), "all_leaves", "all_saved")
    return rows.where("kind = 'node'").join(merged, ["shard", "depth", "open"], "left").select(
        "conv_id",
        "depth",
        "parent_conv_id",
        "n_convs",
        "n_children",
        F.coalesce("all_leaves", "n_leaves").alias("n_leaves"),
        F.coalesce("all_saved", "saved").alias("saved_tokens"),
        F.col("ends").alias("ends_sha256"),
    )


def op13_prefix_trie(spark: SparkSession, folder: str) -> DataFrame:
    """Repeated rows are repeated turns; rows of one turn number follow each other by role, then by the SHA-256 of role length, colon, role and
    text. Rows without conv_id take no part; without any other row there is no node. Long texts are hashed where they are read; only their
    hashes and lengths are shuffled. Columns other than conv_id, turn, role and text are not read."""
    conversations = table(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    return trie(rebuilt(saved(ordered(conversations), "trie-ordered")))


OP13_SQL = f"""
WITH RECURSIVE t AS (
  SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, sha256(length(role) || ':' || role || text)) - 1 AS pos, role, text
  FROM (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL)),
tab AS (SELECT list_transform(range(256), lambda n: list_reduce(list_concat([n], range(8)),
          lambda c, i: CASE WHEN c & 1 = 1 THEN xor(3988292384, c >> 1) ELSE c >> 1 END)) AS tab),
c AS (SELECT conv_id, conv_id - conv_id % {GROUP} AS base,
        xor(4294967295, list_reduce(list_concat([4294967295], list_transform(string_split(conv_id::VARCHAR, ''), lambda x: ascii(x))),
          lambda c, x: xor(c >> 8, tab[(xor(c, x) & 255) + 1]))) % {BORROW} AS h
      FROM (SELECT DISTINCT conv_id FROM t), tab),
r AS (SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY own, pos) AS depth, role, text FROM (
        SELECT c.conv_id, 0 AS own, t.pos, t.role, t.text FROM c JOIN t ON t.conv_id = c.base AND t.pos < c.h
        UNION ALL SELECT c.conv_id, 1, t.pos, t.role, t.text FROM c JOIN t ON t.conv_id = c.conv_id AND t.pos >= c.h)),
p AS (SELECT conv_id, 0::BIGINT AS depth, '' AS key, 0::BIGINT AS bytes FROM c
      UNION ALL SELECT p.conv_id, p.depth + 1, sha256(p.key || length(r.role) || ':' || r.role || r.text), strlen(r.text)::BIGINT
      FROM p JOIN r ON r.conv_id = p.conv_id AND r.depth = p.depth + 1),
l AS (SELECT conv_id, max(depth) AS length FROM p GROUP BY conv_id),
n AS (SELECT depth, key, min(p.conv_id) AS conv_id, count(*) AS n_convs, max(bytes) AS bytes,
        string_agg(CASE WHEN depth = length THEN p.conv_id::VARCHAR END, ',' ORDER BY p.conv_id) AS ends FROM p JOIN l USING (conv_id) GROUP BY depth, key),
e AS (SELECT DISTINCT a.depth, a.key, b.depth AS below, b.key AS under FROM p a JOIN p b ON a.conv_id = b.conv_id AND b.depth >= a.depth),
k AS (SELECT depth, key, count(*) - 1 AS n_children FROM e WHERE below <= depth + 1 GROUP BY depth, key),
u AS (SELECT e.depth, e.key, count(*) FILTER (k.n_children = 0) AS n_leaves, sum((n.n_convs - 1) * n.bytes)::BIGINT AS saved_tokens
      FROM e JOIN k ON k.depth = e.below AND k.key = e.under JOIN n ON n.depth = e.below AND n.key = e.under GROUP BY e.depth, e.key)
SELECT n.conv_id, n.depth, up.conv_id AS parent_conv_id, n.n_convs, k.n_children, u.n_leaves, u.saved_tokens, sha256(coalesce(n.ends, '')) AS ends_sha256
FROM n JOIN k USING (depth, key) JOIN u USING (depth, key)
LEFT JOIN e ON e.below = n.depth AND e.under = n.key AND e.depth = n.depth - 1 LEFT JOIN n up ON up.depth = e.depth AND up.key = e.key"""
