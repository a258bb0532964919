"""WARC archives: writing, reading back, and one globally ordered capture index merged from sorted runs."""

from __future__ import annotations

import base64
import gzip
import hashlib
from collections.abc import Iterator
from urllib.parse import urlsplit

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from motionframes.llm.common import saved, shared_folder, table

#: Fixed by the format: what ends a record, and the letters of base 32.
END, BASE32 = "\r\n\r\n", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
#: Rows of an archive at most, and index rows that a task merges, about.
ARCHIVE_ROWS, MERGE_ROWS = 5_000, 100_000

CAPTURE = "page_id long, url string, url_key string, captured string, record_type string, payload_digest string, payload_bytes long, refers_to long, digest_ok boolean"
INDEX = f"{CAPTURE}, archive string, run long, at long, block_offset long, block_bytes long"


def base32_sha1(payload: Column) -> Column:
    """Bare upper-case base 32 of the SHA-1 of a binary column."""
    hex_ = F.sha1(payload)
    twenty_bits = [F.lpad(F.conv(F.substring(hex_, 1 + 5 * i, 5), 16, 32), 4, "0") for i in range(8)]
    return F.translate(F.concat(*twenty_bits), "0123456789ABCDEFGHIJKLMNOPQRSTUV", BASE32)


def records(pages: DataFrame) -> DataFrame:
    """pages (page_id, url, html) with the fate of each: payload_digest, payload_bytes, record_type, refers_to.

    Among equal payloads the largest page_id is the response and the others revisit it; repeated rows of that
    page_id are all responses, as are rows with a null page_id. A null html is an empty payload.
    """
    payload = F.encode(F.coalesce("html", F.lit("")), "UTF-8")
    given = pages.select("page_id", "url", "html", base32_sha1(payload).alias("payload_digest"), F.length(payload).cast("long").alias("payload_bytes"))
    groups = given.groupBy("payload_digest").agg(F.max("page_id").alias("last"), F.min("page_id").alias("first"))
    groups = saved(groups.where("first < last").select("payload_digest", "last"), "warc-copies")
    revisit = F.col("page_id") < F.col("last")
    return given.join(groups, "payload_digest", "left").select(
        "page_id", "url", "html", "payload_digest", "payload_bytes",
        F.when(revisit, "revisit").otherwise("response").alias("record_type"),
        F.when(revisit, F.col("last")).alias("refers_to"),
    )


def write_warc(fated: DataFrame, folder: str) -> None:
    """One WARC 1.1 record a row, in gzipped archives of at most ARCHIVE_ROWS records.

    A record's end is the line separator of Spark's text sink, so executors write through whatever file
    system the folder is on. The capture time is derived from the page_id, as pages have none.
    """
    pid = F.coalesce(F.col("page_id").cast("string"), F.lit(""))
    name = F.concat(F.lit("<urn:page:"), pid, F.lit(">"))
    when = F.date_format(F.timestamp_seconds(F.lit(1_577_836_800) + F.pmod(F.coalesce("page_id", F.lit(0)), F.lit(1_000_000_000))), "yyyy-MM-dd'T'HH:mm:ss'Z'")
    # A line break in a URL would end its header.
    url = F.replace(F.replace(F.coalesce("url", F.lit("")), F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))
    http = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), F.col("payload_bytes").cast("string"), F.lit(END))
    fresh = F.col("record_type") == "response"
    block = F.when(fresh, F.concat(http, F.coalesce("html", F.lit("")))).otherwise(http)
    size = F.octet_length(http) + F.when(fresh, F.col("payload_bytes")).otherwise(0)
    back = F.concat(
        F.lit("\r\nWARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest\r\nWARC-Refers-To: <urn:page:"),
        F.col("refers_to").cast("string"), F.lit(">"),
    )
    head = F.concat(
        F.lit("WARC/1.1\r\nWARC-Type: "), "record_type", F.lit("\r\nWARC-Record-ID: "), name, F.lit("\r\nWARC-Date: "), when,
        F.lit("\r\nWARC-Target-URI: "), url, F.lit("\r\nWARC-Payload-Digest: sha1:"), "payload_digest", F.when(fresh, "").otherwise(back),
        F.lit("\r\nContent-Type: application/http; msgtype=response\r\nContent-Length: "), size.cast("string"), F.lit(END),
    )
    out = fated.select(F.concat(head, block).alias("value")).write.option("lineSep", END).option("compression", "gzip")
    out.option("maxRecordsPerFile", ARCHIVE_ROWS).text(folder)


def url_key(url: str) -> str:
    """Host labels from the last to the first, then the path: pages of a site sort together. A URL without a host is its own key."""
    try:
        parts = urlsplit(url.strip().lower())
        host = parts.hostname
    except ValueError:
        host = None
    if not host:
        return url.lower()
    return ",".join(reversed(host.split("."))) + ")" + (parts.path or "/") + ("?" + parts.query if parts.query else "")


def captures(data: bytes) -> Iterator[dict]:
    """The records of an archive, by their lengths alone, so that payloads may hold anything."""
    at = 0
    while at < len(data):
        stop = data.index(b"\r\n\r\n", at)
        head = dict(line.split(": ", 1) for line in data[at:stop].decode().split("\r\n")[1:])
        start, size = stop + 4, int(head["Content-Length"])
        block = data[start : start + size]
        body = block.index(b"\r\n\r\n") + 4
        length = int(next(x for x in block[:body].split(b"\r\n") if x.startswith(b"Content-Length: "))[16:])
        digest = head["WARC-Payload-Digest"].removeprefix("sha1:")
        fresh = head["WARC-Type"] == "response"
        number = lambda name: int(head[name][10:-1]) if head.get(name, "<urn:page:>") != "<urn:page:>" else None
        yield {
            "page_id": number("WARC-Record-ID"), "url": head["WARC-Target-URI"], "url_key": url_key(head["WARC-Target-URI"]), "captured": head["WARC-Date"],
            "record_type": head["WARC-Type"], "payload_digest": digest, "payload_bytes": length, "refers_to": number("WARC-Refers-To"),
            "digest_ok": not fresh or (base64.b32encode(hashlib.sha1(block[body:]).digest()).decode() == digest and len(block) - body == length),
            "block_offset": start, "block_bytes": size,
        }
        at = start + size + 4


def _order(row: dict) -> tuple:
    return (row["url_key"], row["captured"], -1 if row["page_id"] is None else row["page_id"])


def _runs(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The sorted run of each archive."""
    for batch in batches:
        for path, content in zip(batch["path"], batch["content"]):
            rows = sorted(captures(gzip.decompress(content)), key=_order)
            if not rows:
                continue
            run = int.from_bytes(hashlib.sha1(path.encode()).digest()[:7], "big")
            frame = pd.DataFrame(rows).assign(archive=path.rsplit("/", 1)[-1], run=run, at=range(len(rows)))
            yield frame.astype({"page_id": "Int64", "refers_to": "Int64"})[[x.split()[0] for x in INDEX.split(", ")]]


def loser_tree_merge(runs: list[list[tuple]]) -> Iterator[tuple]:
    """One sorted stream from sorted runs, ties to the earlier run.

    Leaves are the runs' heads; an inner node holds the loser of its match, so after a winner leaves
    only the matches on the path from its leaf to the root are played again.
    """
    size = 1 << max(0, (len(runs) - 1).bit_length())
    heads = [iter(r) for r in runs] + [iter(())] * (size - len(runs))
    front = [next(h, None) for h in heads]

    def beats(a: int, b: int) -> bool:
        if front[a] is None or front[b] is None:
            return front[b] is None and (front[a] is not None or a < b)
        return (front[a], a) < (front[b], b)

    loser, winner = [0] * size, [0] * size + list(range(size))
    for node in range(size - 1, 0, -1):
        a, b = winner[2 * node], winner[2 * node + 1]
        winner[node], loser[node] = (a, b) if beats(a, b) else (b, a)
    best = winner[1] if size > 1 else 0
    while front[best] is not None:
        yield front[best]
        front[best] = next(heads[best], None)
        node = (best + size) // 2
        while node:
            if beats(loser[node], best):
                loser[node], best = best, loser[node]
            node //= 2


def _merge(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Merges the slices of all runs that fell into this range of keys."""
    rows = pd.concat(list(batches))
    if rows.empty:
        return
    ids = [None if pd.isna(x) else int(x) for x in rows["page_id"]]
    keys = list(zip(rows["url_key"], rows["captured"], (-1 if x is None else x for x in ids), range(len(rows))))
    edge = [0, *(rows["run"].to_numpy()[1:] != rows["run"].to_numpy()[:-1]).nonzero()[0] + 1, len(rows)]
    order = [key[3] for key in loser_tree_merge([keys[a:b] for a, b in zip(edge, edge[1:])])]
    merged = rows.iloc[order].assign(row=range(len(rows)))
    yield merged.astype({"page_id": "Int64", "refers_to": "Int64"})


def merged_index(runs: DataFrame) -> DataFrame:
    """All runs as one index in order of (url_key, captured, page_id), with each row's position from 0.

    The key space is cut into ranges of about MERGE_ROWS rows (a crowded URL is cut by time and id),
    each range takes its slice of every run, and a loser tree merges the slices.
    """
    spark = runs.sparkSession
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-runs.count() // MERGE_ROWS))
    dealt = runs.repartitionByRange(parts, "url_key", "captured", "page_id", "run").sortWithinPartitions("run", "at")
    types = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in runs.schema) + ", part int, row long"
    merged = saved(dealt.withColumn("part", F.spark_partition_id()).mapInPandas(_merge, types), "warc-index")
    starts, held = {}, 0
    for part, n in sorted(map(tuple, merged.groupBy("part").count().collect())):
        starts[part], held = held, held + n
    begin = F.element_at(F.lit([starts.get(p, 0) for p in range(parts)]).cast("array<bigint>"), F.col("part") + 1)
    return merged.withColumn("position", F.col("row") + begin).drop("part", "row", "run", "at")


def read_warc(spark: SparkSession, folder: str) -> DataFrame:
    """The capture runs of all archives below a folder: one sorted run each."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(folder)
    return files.select("path", "content").mapInPandas(_runs, INDEX)


def op3_warc_index(spark: SparkSession, folder: str) -> DataFrame:
    archives = shared_folder(spark, "warc")
    write_warc(records(table(spark, folder, "pages")), archives)
    index = merged_index(saved(read_warc(spark, archives), "warc-runs"))
    return index.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "url_key", "captured", "position")


OP3_SQL = """
WITH h AS (SELECT page_id, url, sha1(coalesce(html, '')) AS h, strlen(coalesce(html, ''))::BIGINT AS payload_bytes FROM pages),
g AS (SELECT *, translate(list_aggregate(list_transform(range(8), lambda i: to_base(('0x' || substr(h, (1 + 5 * i)::INT, 5))::BIGINT, 32, 4)), 'string_agg', ''),
  '0123456789ABCDEFGHIJKLMNOPQRSTUV', 'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567') AS payload_digest, max(page_id) OVER (PARTITION BY h) AS last,
  strftime(to_timestamp(1577836800 + page_id) AT TIME ZONE 'UTC', '%Y-%m-%dT%H:%M:%SZ') AS captured,
  regexp_extract(lower(url), '^https?://([^/?#:]*)(?::[0-9]*)?([^?#]*)(\\?[^#]*)?', ['host', 'path', 'query']) AS u FROM h),
k AS (SELECT *, list_aggregate(list_reverse(string_split(u.host, '.')), 'string_agg', ',') || ')' || CASE WHEN u.path = '' THEN '/' ELSE u.path END
  || CASE WHEN u.query IN ('', '?') THEN '' ELSE u.query END AS url_key FROM g)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN page_id < last THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN page_id < last THEN last END AS refers_to, url_key, captured,
  row_number() OVER (ORDER BY url_key, captured, page_id) - 1 AS position FROM k"""
