"""Columnar archives and tables: what is in them without reading the values (S1, S2), and the sinks."""

from __future__ import annotations

import re
import zipfile
import zlib
from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schemas import nan_to_null

# Dtype class per kind code and item size.
DTYPE_CLASS = {("f", 4): "f4", ("f", 8): "f8", ("b", 1): "bool", ("i", 8): "i8", ("U", None): "U", ("O", None): "object"}

HEADERS = T.StructType(
    [
        T.StructField("path", T.StringType()),
        T.StructField("key", T.StringType()),
        T.StructField("shape", T.ArrayType(T.LongType())),
        T.StructField("dtype", T.StringType()),
        T.StructField("problem", T.StringType()),
    ]
)

# Fixed value: the first bytes of an array member.
ARRAY_MAGIC = b"\x93NUMPY"


def opened(path: str):
    """A file with random access, by the path that Spark's listing gives."""
    from pyarrow import fs

    system, inner = fs.FileSystem.from_uri(re.sub("^file:/+", "file:///", path) if ":" in path.split("/")[0] else f"file://{path}")
    return system.open_input_file(inner)


def _members(path: str) -> Iterator[tuple]:
    """A row per array of an archive; what can't be read is a row with the reason, other members are passed over."""
    from numpy.lib import format as npy

    try:
        with opened(path) as handle, zipfile.ZipFile(handle) as archive:
            for member in sorted(archive.namelist()):
                key = member.removesuffix(".npy")
                try:
                    with archive.open(member) as data:
                        if data.peek(len(ARRAY_MAGIC))[: len(ARRAY_MAGIC)] != ARRAY_MAGIC:
                            continue
                        version = npy.read_magic(data)
                        read = npy.read_array_header_1_0 if version == (1, 0) else npy.read_array_header_2_0
                        shape, _, dtype = read(data)
                except (ValueError, zipfile.BadZipFile, zlib.error, EOFError, NotImplementedError) as broken:
                    yield path, key, None, None, f"unreadable array: {type(broken).__name__}"
                    continue
                size = None if dtype.kind in "UO" else dtype.itemsize
                yield path, key, [int(n) for n in shape], DTYPE_CLASS.get((dtype.kind, size), f"{dtype.kind}{dtype.itemsize}"), None
    except (zipfile.BadZipFile, EOFError) as broken:
        yield path, None, None, None, f"unreadable archive: {type(broken).__name__}"


def _headers(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        yield pd.DataFrame([row for path in batch["path"] for row in _members(path)], columns=HEADERS.names)


def archive_headers(spark: SparkSession, folder: str) -> DataFrame:
    """S1. Key, shape and dtype class of every array of every archive below a folder.

    Spark lists the paths; a task opens an archive with random access and reads its directory and
    the members' headers, not the values. Members that are no arrays have no row; a broken archive
    has one without a key and a broken array one without a shape, with the ``problem``.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.npz")
    return files.load(folder).select("path").mapInPandas(_headers, HEADERS)


def write_archives(df: DataFrame, *, bucket: str, columns: Sequence[str], folder: str, notes: str | None = None) -> DataFrame:
    """S14. One archive per bucket with an array per column, in the buckets' rows' order of ``columns``; (bucket, path).

    A bucket is one task's frame, so buckets must be bounded (ranges of a key). ``notes`` adds a text member. A task
    that is run again replaces its archive.
    """

    def write(rows: pd.DataFrame) -> pd.DataFrame:
        import io

        import numpy as np
        from pyarrow import fs

        rows, held = rows.sort_values(list(columns)), io.BytesIO()
        with zipfile.ZipFile(held, "w") as archive:
            for c in columns:
                values, member = rows[c].to_numpy(), io.BytesIO()
                np.save(member, values.astype(str) if values.dtype == object else values)
                archive.writestr(f"{c}.npy", member.getvalue())
            if notes is not None:
                archive.writestr("notes.txt", notes)
        key = int(rows[bucket].iloc[0])
        system, inner = fs.FileSystem.from_uri(re.sub("^file:/+", "file:///", folder) if ":" in folder.split("/")[0] else f"file://{folder}")
        system.create_dir(inner, recursive=True)
        with system.open_output_stream(f"{inner}/{key}.npz") as out:
            out.write(held.getvalue())
        return pd.DataFrame({"bucket": [key], "path": [f"{folder}/{key}.npz"]})

    return df.select(F.col(bucket).cast("bigint").alias(bucket), *columns).groupBy(bucket).applyInPandas(write, "bucket bigint, path string")


_COLUMN_CLASS = {"double": "f8", "float": "f4", "bigint": "i8", "int": "i4", "boolean": "bool", "string": "U"}


def observed_columns(df: DataFrame, *, artifact: str) -> DataFrame:
    """S1 on a table: one row per column with its type class, row count and present values.

    A single pass; only the columns' presence is aggregated.
    """
    counts = df.agg(F.count(F.lit(1)).alias("_rows"), *[F.count(F.col(c)).alias(f"_n_{i}") for i, c in enumerate(df.columns)])
    cells = [
        F.struct(
            F.lit(f.name).alias("key"),
            F.lit(_COLUMN_CLASS.get(f.dataType.simpleString(), f.dataType.typeName())).alias("dtype"),
            F.col("_rows").alias("rows"),
            F.col(f"_n_{i}").alias("present"),
        )
        for i, f in enumerate(df.schema)
    ]
    return counts.select(F.lit(artifact).alias("artifact"), F.inline(F.array(*cells)))


def load_columns(spark: SparkSession, path: str, wanted: Sequence[str]) -> DataFrame:
    """S2. The wanted columns that exist; the others are not read, missing ones are left out."""
    df = spark.read.parquet(path)
    return df.select(*[c for c in wanted if c in df.columns])


def load_frames(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A frame table with its declared schema, NaN turned into NULL."""
    return nan_to_null(spark.read.schema(schema).parquet(path))


def write_bundle(tables: dict[str, DataFrame], path: str, *, partition_by: Sequence[str], problems: DataFrame | None = None) -> None:
    """S14. One Parquet table per artifact. Nothing is written while ``problems`` has a row."""
    if problems is not None and not problems.isEmpty():
        raise ValueError(f"the artifacts do not fit their declaration: {problems.first()}")
    for name, df in tables.items():
        df.write.mode("overwrite").partitionBy(*partition_by).parquet(f"{path}/{name}")


def column_aliases(df: DataFrame, aliases: dict[str, str]) -> DataFrame:
    """P22. Additional names for existing columns; an unknown column is an error."""
    return df.select("*", *[F.col(old).alias(new) for old, new in aliases.items()])


def refuse_unless(condition: Column, message: str) -> Column:
    """A true column, or an error when the condition does not hold."""
    return F.when(condition, F.lit(True)).otherwise(F.raise_error(F.lit(message)).cast("boolean"))
