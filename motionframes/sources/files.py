"""Listings, checksum lists, sequence names and indexes."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Mapping, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as X
from .archives import opened


def list_files(spark: SparkSession, folder: str) -> DataFrame:
    """S10. Path and length of every file below a folder; contents are not read. Spark's listing passes over files without bytes."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(folder)
    return files.select("path", "length")


def source_files(listing: DataFrame, *, path: str) -> DataFrame:
    """S10. Without operating-system files and unfinished copies, in name order."""
    name = X.base_name(F.col(path))
    return listing.where(~X.is_metadata(name) & ~X.is_unfinished(name)).orderBy(path)


def unfinished_files(listing: DataFrame, *, path: str) -> DataFrame:
    """S10. Only the unfinished copies."""
    return listing.where(X.is_unfinished(X.base_name(F.col(path)))).orderBy(path)


def checksums(files: DataFrame, *, content: str, folder: Column) -> tuple[DataFrame, DataFrame]:
    """S11. Digest and size per file, and the totals per folder."""
    hashed = files.withColumns({"sha256": F.sha2(content, 256), "bytes": F.octet_length(content), "folder": folder}).drop(content)
    totals = hashed.groupBy("folder").agg(F.count(F.lit(1)).alias("files"), F.sum("bytes").alias("bytes"))
    return hashed, totals


def file_checksums(files: DataFrame, *, path: str, chunk: int = 1 << 20) -> DataFrame:
    """S11. Digest and size of files of any size, by path: a task reads a file in pieces of ``chunk`` bytes.

    A file that can't be read has no digest, and a ``problem``.
    """

    def digests(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for name in batch["path"]:
                digest, size = hashlib.sha256(), 0
                try:
                    with opened(name) as source:
                        while piece := source.read(chunk):
                            digest.update(piece)
                            size += len(piece)
                    rows.append((name, digest.hexdigest(), size, None))
                except OSError as broken:
                    rows.append((name, None, None, type(broken).__name__))
            found = pd.DataFrame(rows, columns=["path", "sha256", "bytes", "problem"])
            yield found.astype({"bytes": "Int64"})

    return files.select(F.col(path).alias("path")).where("path is not null").mapInPandas(digests, "path string, sha256 string, bytes bigint, problem string")


def sums_line(digest: Column, name: Column) -> Column:
    """S12. One checksum line; a name with a backslash or a line break is escaped and marked."""
    escaped = F.replace(F.replace(F.replace(name, F.lit("\\"), F.lit("\\\\")), F.lit("\n"), F.lit("\\n")), F.lit("\r"), F.lit("\\r"))
    return F.when(escaped == name, F.concat(digest, F.lit("  "), name)).otherwise(
        F.concat(F.lit("\\"), digest, F.lit("  "), escaped)
    )


# Fixed value: the line format of the public checksum tools (escape mark, 64 hex digits, a space, text or binary mark, name).
SUMS_LINE = r"(?s)^(\\?)([0-9a-fA-F]{64}) [ *](.+)$"


def _unescaped(name: Column) -> Column:
    # A backslash pair is set aside first so that its second half cannot start another escape.
    mark = F.lit("\u0000")
    out = F.replace(name, F.lit("\\\\"), mark)
    out = F.replace(F.replace(out, F.lit("\\n"), F.lit("\n")), F.lit("\\r"), F.lit("\r"))
    return F.replace(out, mark, F.lit("\\"))


def parse_sums(lines: DataFrame, *, line: str) -> DataFrame:
    """S12. Digest and name per line; ``valid`` is false for what is not a checksum line."""
    part = lambda i: F.regexp_extract(line, SUMS_LINE, i)
    name = F.when(part(1) == "\\", _unescaped(part(3))).otherwise(part(3))
    valid = F.col(line).rlike(SUMS_LINE)
    return lines.withColumns(
        {"valid": valid, "digest": F.when(valid, F.lower(part(2))), "name": F.when(valid, name)}
    )


def repeated_names(entries: DataFrame, *, name: str) -> DataFrame:
    """S12. Names listed more than once."""
    return entries.groupBy(name).agg(F.count(F.lit(1)).alias("times")).where("times > 1")


def classify_sequences(paths: DataFrame, *, path: str) -> DataFrame:
    """S13. Dataset, subject (the folder above the file) and sequence of a path; files that are no motion
    keep an explicit status."""
    parts = F.split(path, "/")
    stem = F.regexp_replace(F.element_at(parts, -1), r"\.[^.]*$", "")
    motion = stem.endswith("_poses")
    return paths.select(
        path,
        parts[0].alias("dataset"),
        F.get(parts, F.size(parts) - 2).alias("subject"),
        stem.alias("sequence"),
        F.when(motion, "ok").otherwise("excluded_non_motion").alias("status"),
    )


ENTRY = "struct<take_id: string, take: string, sequence_id: string, relative_path: string, status: string>"
INDEX = f"struct<spec_version: string, counts: struct<ok: bigint, failed: bigint, excluded: bigint, total: bigint>, takes: array<{ENTRY}>>"


def index_entries(texts: DataFrame, *, keys: Sequence[str], text: str) -> DataFrame:
    """S3. Take entries of an index in its older or newer shape."""
    parsed = texts.select(*keys, F.from_json(text, INDEX).alias("_i"))
    entry = F.col("_e")
    take = F.coalesce(entry["take_id"], entry["take"], entry["sequence_id"])
    return parsed.select(*keys, F.explode("_i.takes").alias("_e")).select(
        *keys,
        take.alias("take_id"),
        F.coalesce(entry["relative_path"], take).alias("rel"),
        F.coalesce(entry["status"], F.lit("ok")).alias("status"),
    )


def index_counts(texts: DataFrame, *, keys: Sequence[str], text: str) -> DataFrame:
    """S3, A7. The counts an index states."""
    return texts.select(*keys, F.from_json(text, INDEX).alias("_i")).select(*keys, F.col("_i.counts.*"))


def manifests(texts: DataFrame, *, keys: Sequence[str], text: str, fields: Mapping[str, str]) -> DataFrame:
    """S4. Named JSON paths of a manifest; a malformed one gives an empty record, never an error."""
    parsed = texts.withColumn("_m", F.try_parse_json(F.col(text)))
    return parsed.select(
        *keys,
        F.col("_m").isNotNull().alias("readable"),
        *[F.try_variant_get("_m", path, "string").alias(n) for n, path in fields.items()],
    )


def dataset_profile(takes: DataFrame, *, dataset: str, mode: str, capability: str, status: str) -> DataFrame:
    """S17. Mode, capabilities and counts per dataset."""
    sets = takes.select(dataset, capability).distinct().groupBy(dataset).agg(
        F.array_join(F.sort_array(F.collect_list(capability)), ",").alias("capabilities")
    )
    sums = takes.groupBy(dataset).agg(
        F.min(mode).alias("mode"), F.count_if(F.col(status) == "ok").alias("ok"), F.count(F.lit(1)).alias("total")
    )
    return sums.join(sets, dataset)


def limitation_rows(entries: DataFrame, *, bundles: str, id_: str) -> DataFrame:
    """S18. One row per bundle and entry, sorted by bundle and id."""
    return entries.withColumn("bundle", F.explode(bundles)).drop(bundles).orderBy("bundle", id_)


def drifted(rendered: DataFrame, stored: DataFrame) -> DataFrame:
    """S18. Rows of one copy that the other lacks."""
    left = rendered.exceptAll(stored).withColumn("copy", F.lit("rendered"))
    return left.unionByName(stored.exceptAll(rendered).withColumn("copy", F.lit("stored")))
