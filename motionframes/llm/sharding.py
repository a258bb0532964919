"""Contiguous shards of near equal bytes from global prefix sums."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from motionframes.llm.common import saved, table

#: Rows that a partition of the order holds, about.
PART_ROWS = 200_000


def _running(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Adds what stands before a row in its partition: bytes and rows."""
    held = rows = 0
    for batch in batches:
        until = batch["size"].cumsum() + held
        yield batch.assign(before=until - batch["size"], row=range(rows, rows + len(batch)))
        if len(batch):
            held, rows = int(until.iloc[-1]), rows + len(batch)


def contiguous_shards(rows: DataFrame, order: list[str], shards: int) -> DataFrame:
    """rows (with a long column size >= 0) plus shard and slot: shards are stretches of the order.

    Nulls come first in the order; a null size counts as 0. Rows with equal order columns may be told apart anyhow,
    so a run of repeated rows can be cut by a shard's edge. Columns shard and slot of rows are replaced; all other
    names are free. An empty table gives no rows. Only sizes are read, so long texts cost what their rows cost.

    The rows are dealt by ranges of the order (a random last key splits even identical rows), each
    partition sums itself, and the partitions' totals (one number each) give the global prefix. A row
    belongs to the shard whose equal share of all bytes holds its middle byte, so a shard misses its
    target by less than the largest row. Sizes of 0 everywhere put all rows into shard 0.
    """
    names = [n for n in rows.columns if n not in ("shard", "slot")]
    kept = [f"c{i}" for i in range(len(names))]
    order = [f"c{names.index(n)}" for n in order]
    # Inside, the columns have numbers for names, so that none clashes.
    rows = rows.select(*[F.col(f"`{n}`").alias(c) for n, c in zip(names, kept)])
    rows = rows.withColumn("size", F.coalesce(f"c{names.index('size')}", F.lit(0)).cast("long"))
    spark = rows.sparkSession
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-rows.count() // PART_ROWS))
    keys = [*order, "salt"]
    ranged = rows.withColumn("salt", F.rand(11)).repartitionByRange(parts, *keys).sortWithinPartitions(*keys)
    ranged = ranged.withColumn("part", F.spark_partition_id()).drop("salt")
    types = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in ranged.schema)
    local = saved(ranged.mapInPandas(_running, f"{types}, before long, row long"), "shard-order")

    totals = sorted(local.groupBy("part").agg(F.sum("size").alias("size"), F.count("*").alias("n")).collect())
    starts, held, count = {}, 0, 0
    for t in totals:
        starts[t["part"]] = (held, count)
        held, count = held + t["size"], count + t["n"]
    at = lambda i: F.element_at(F.lit([starts.get(p, (0, 0))[i] for p in range(parts)]).cast("array<bigint>"), F.col("part") + 1)
    middle = (2 * (F.col("before") + at(0)) + F.col("size")) * shards
    share = F.expr(f"middle div {max(1, 2 * held)}L")
    shard = F.least(F.lit(shards - 1), share).cast("int").alias("shard")
    placed = local.withColumn("middle", middle).select(*kept, shard, (F.col("row") + at(1)).alias("row"))
    first = {r["shard"]: r["first"] for r in placed.groupBy("shard").agg(F.min("row").alias("first")).collect()}
    begin = F.element_at(F.lit([first.get(s, 0) for s in range(shards)]).cast("array<bigint>"), F.col("shard") + 1)
    return placed.select(*[F.col(c).alias(n) for n, c in zip(names, kept)], "shard", (F.col("row") - begin).alias("slot"))


def op9_prefix_sum_shards(spark: SparkSession, folder: str) -> DataFrame:
    """A null text has size 16 and the checksum of the empty text; a null or repeated id is a row like any other."""
    docs = table(spark, folder, "documents")
    rows = docs.select(
        "doc_id",
        (F.coalesce(F.octet_length("text"), F.lit(0)) + 16).cast("long").alias("size"),
        F.crc32(F.coalesce("text", F.lit(""))).alias("text_crc32"),
    )
    placed = contiguous_shards(rows, ["doc_id", "text_crc32", "size"], 40)
    return placed.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


OP9_SQL = """
WITH t AS (SELECT list_transform(range(256), lambda n: list_reduce(list_concat([n], range(8)),
             lambda c, i: CASE WHEN c & 1 = 1 THEN xor(3988292384, c >> 1) ELSE c >> 1 END)) AS tab),
d AS (SELECT doc_id, coalesce(text, '') AS text, strlen(coalesce(text, '')) AS n FROM documents),
b AS (SELECT doc_id, n, list_transform(regexp_extract_all(hex(encode(text)), '..'), lambda x: ('0x' || x)::BIGINT) AS bytes FROM d),
c AS (SELECT doc_id, (n + 16)::BIGINT AS size, xor(4294967295, list_reduce(list_concat([4294967295], bytes),
             lambda c, x: xor(c >> 8, tab[(xor(c, x) & 255) + 1])))::BIGINT AS text_crc32 FROM b, t),
p AS (SELECT *, coalesce(sum(size) OVER (ORDER BY doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before,
             sum(size) OVER () AS total FROM c),
s AS (SELECT *, least(39, ((2 * before + size) * 40 // (2 * total)))::INT AS shard FROM p)
SELECT doc_id, size, text_crc32, 'bytes' AS law, shard,
       (row_number() OVER (PARTITION BY shard ORDER BY doc_id) - 1)::BIGINT AS slot, NULL::INT AS grown_shard FROM s"""
