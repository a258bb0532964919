"""Wide motion tables to long rows: markers, orientations, segments, bindings, text motion files."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_wide(spark: SparkSession, path: str) -> DataFrame:
    """A wide CSV with a header; the column types come from the later casts."""
    return spark.read.csv(path, header=True)


def split_columns(columns: Sequence[str], pattern: str) -> dict[str, dict[str, str]]:
    """Name to {component: column} of the columns that fit ``pattern`` (groups: name, component).

    A component given twice is refused.
    """
    import re

    found: dict[str, dict[str, str]] = {}
    for column in columns:
        match = re.match(pattern, column)
        if match:
            parts = found.setdefault(match.group(1), {})
            if match.group(2).lower() in parts:
                raise ValueError(f"{match.group(1)}: component {match.group(2)} appears twice")
            parts[match.group(2).lower()] = column
    return found


def tidy_components(
    wide: DataFrame, *, keys: Sequence[str], pattern: str, components: str, name: str, scale: float = 1.0
) -> DataFrame:
    """S5, S6. ``<name>_<component>`` columns to one row per name with one column per component.

    The file's own component order does not matter. A name that lacks a component is refused.
    """
    found = split_columns([c for c in wide.columns if c not in keys], pattern)
    if not found:
        raise ValueError("no component columns")
    for who, parts in found.items():
        if set(parts) != set(components):
            raise ValueError(f"{who}: has {sorted(parts)}, needs {sorted(components)}")
    cells = [
        F.struct(
            F.lit(who).alias(name),
            *[(F.col(f"`{parts[c]}`").try_cast("double") * scale).alias(c) for c in components],
        )
        for who, parts in sorted(found.items())
    ]
    return wide.select(*keys, F.inline(F.array(*cells)))


def read_markers(spark: SparkSession, path: str, *, time: str) -> DataFrame:
    """S5. Marker CSV in millimetres to rows in metres."""
    rows = tidy_components(read_wide(spark, path), keys=[time], pattern=r"^(.+)_([xyzXYZ])$", components="xyz", name="marker", scale=1e-3)
    return rows.withColumn(time, F.col(time).cast("double"))


def read_orientations(spark: SparkSession, path: str, *, time: str) -> DataFrame:
    """S6. Orientation CSV with any component order to w, x, y, z rows."""
    rows = tidy_components(read_wide(spark, path), keys=[time], pattern=r"^(.+)_[Qq]([wxyzWXYZ])$", components="wxyz", name="sensor")
    return rows.withColumn(time, F.col(time).cast("double"))


def tidy_segments(raw: DataFrame, *, label: str, start: str, stop: str, velocity: str) -> DataFrame:
    """S7. Labelled intervals; an empty velocity is null; an interval that does not advance stays, joins by interval find nothing in it."""
    number = lambda c: F.expr(f"try_cast(nullif(trim(`{c}`), '') as double)")
    return raw.select(
        *[c for c in raw.columns if c not in (label, start, stop, velocity)],
        F.col(f"`{label}`").alias("label"), number(start).alias("start_s"), number(stop).alias("end_s"), number(velocity).alias("velocity"),
    )


BINDINGS = "map<string, struct<marker_names: array<string>, imu_name: string>>"


def bindings(texts: DataFrame, *, keys: Sequence[str], text: str) -> tuple[DataFrame, DataFrame]:
    """S8. Body to markers and body to sensor, from a JSON object per body."""
    bodies = texts.select(*keys, F.explode(F.from_json(text, BINDINGS)).alias("body", "_b"))
    markers = bodies.select(*keys, "body", F.posexplode("_b.marker_names").alias("position", "marker"))
    sensors = bodies.select(*keys, "body", F.col("_b.imu_name").alias("sensor")).where(F.col("sensor").isNotNull())
    return markers, sensors


def motion_rows(lines: DataFrame, *, file: str, line: str, number: str) -> DataFrame:
    """S9. Text motion files: a free header up to ``endheader``, one line of names, then numbers.

    ``lines`` has the file's numbered lines. Angles declared in degrees become radians (``time`` is
    left alone). Each row carries the declared and the found number of data rows of its file.
    """
    head = F.lower(F.trim(line))
    facts = lines.groupBy(file).agg(
        F.min(F.when(head == "endheader", F.col(number))).alias("_end"),
        F.max(head == "indegrees=yes").alias("_degrees"),
        F.max(F.regexp_extract(head, r"^nrows=(\d+)$", 1)).alias("_rows"),
    )
    names = lines.join(facts, file).where(F.col(number) == F.col("_end") + 1)
    names = names.select(file, "_end", "_degrees", F.expr("try_cast(_rows as bigint)").alias("declared"), F.split(F.trim(line), r"\s+").alias("_names"))
    data = lines.join(names, file).where((F.col(number) > F.col("_end") + 1) & (F.trim(line) != ""))
    cells = F.arrays_zip(F.col("_names").alias("name"), F.split(F.trim(line), r"\s+").alias("raw"))
    rows = data.select(file, (F.col(number) - F.col("_end") - 2).alias("row"), "declared", "_degrees", F.inline(cells).alias("name", "raw"))
    value = F.expr("try_cast(raw as double)")
    turned = F.when(F.coalesce("_degrees", F.lit(False)) & (F.col("name") != "time"), F.radians(value)).otherwise(value)
    return rows.select(file, "row", "declared", "name", turned.alias("value"))


def row_count_problems(rows: DataFrame, *, file: str) -> DataFrame:
    """S9. Files whose declared row count is not the one found."""
    found = rows.groupBy(file).agg(F.first("declared").alias("declared"), (F.max("row") + 1).alias("found"))
    return found.where(F.col("declared").isNotNull() & (F.col("declared") != F.col("found")))
