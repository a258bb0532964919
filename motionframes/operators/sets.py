"""Ordered output, top rows and set operations."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def name_order(df: DataFrame, *, order: Sequence[str]) -> DataFrame:
    """T1. Rows in name order (a range-partitioned sort)."""
    return df.orderBy(*order)


def first_rows(df: DataFrame, *, order: Sequence[str], count: int) -> DataFrame:
    """T2. The first rows in order; planned as a top-k, without a full sort."""
    return df.orderBy(*order).limit(count)


def top_per_category(df: DataFrame, *, category: str, order: Sequence[Column | str], k: int) -> DataFrame:
    """T4. The first ``k`` rows of each category and how many more there are.

    A partial top-k per hash bucket precedes the final one, so a huge category is never sorted in
    one task; the remainder comes from plain counts.
    """
    salted = df.withColumn("_salt", F.pmod(F.xxhash64(*df.columns), F.lit(256)))
    partial = Window.partitionBy(category, "_salt").orderBy(*order)
    final = Window.partitionBy(category).orderBy(*order)
    top = salted.withColumn("rank", F.row_number().over(partial)).where(F.col("rank") <= k)
    top = top.withColumn("rank", F.row_number().over(final)).where(F.col("rank") <= k).drop("_salt")
    counts = df.groupBy(category).agg(F.count(F.lit(1)).alias("_n"))
    joined = top.join(counts, category)
    return joined.withColumn("more", F.greatest(F.col("_n") - k, F.lit(0))).drop("_n")


def key_differences(
    observed: DataFrame, declared: DataFrame, *, keys: Sequence[str], name: str, required: Column, forbidden: Column
) -> DataFrame:
    """O1. Missing, forbidden and unexpected names per key.

    ``declared`` holds the names a key may carry; ``required`` and ``forbidden`` are conditions on it.
    """
    on = [*keys, name]
    have = observed.select(*on).distinct()
    wants = declared.where(required).select(*on)
    bans = declared.where(forbidden).select(*on)
    return (
        wants.join(have, on, "left_anti").withColumn("problem", F.lit("missing"))
        .unionByName(have.join(bans, on, "left_semi").withColumn("problem", F.lit("forbidden")))
        .unionByName(have.join(declared.select(*on), on, "left_anti").withColumn("problem", F.lit("unexpected")))
    )


def undeclared(observed: DataFrame, allowed: DataFrame, waived: DataFrame, *, on: Sequence[str]) -> DataFrame:
    """O2. Names neither allowed nor waived."""
    return observed.select(*on).distinct().join(allowed, list(on), "left_anti").join(waived, list(on), "left_anti")


def ordered_union(lists: DataFrame, *, name: str, position: Sequence[str]) -> DataFrame:
    """O3. Each name once, at its first position, in order."""
    return (
        lists.groupBy(name)
        .agg(F.min(F.struct(*position)).alias("_at"))
        .orderBy("_at")
        .select(name, *[F.col("_at")[p].alias(p) for p in position])
    )


def all_findings(first: DataFrame, *others: DataFrame) -> DataFrame:
    """O4. Findings of different shapes in one table."""
    for other in others:
        first = first.unionByName(other, allowMissingColumns=True)
    return first


def common_rows(a: DataFrame, b: DataFrame) -> DataFrame:
    """O5."""
    return a.intersect(b)


def symmetric_difference(a: DataFrame, b: DataFrame) -> DataFrame:
    """O5. Rows on one side only, with the side."""
    left = a.exceptAll(b).withColumn("side", F.lit("a"))
    return left.unionByName(b.exceptAll(a).withColumn("side", F.lit("b")))
