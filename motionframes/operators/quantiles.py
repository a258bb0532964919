"""Exact linear-interpolated quantiles per group that survive a group of any size."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

HOT_ROWS = 4_000_000
SKETCH_ACCURACY = 20_000


def exact_quantiles(
    df: DataFrame,
    *,
    keys: Sequence[str],
    value: str,
    probs: Mapping[str, float],
    aggs: Sequence[Column] = (),
    hot_rows: int = HOT_ROWS,
    sized_by: DataFrame | None = None,
) -> DataFrame:
    """Per key: the quantiles named in ``probs`` plus any plain aggregates in ``aggs``.

    Group sizes are counted first (a map-side combined count of the keys). While every group has at
    most ``hot_rows`` rows, ``percentile`` does the work. Larger groups - at most ``rows / hot_rows``
    of them, so their key list is small enough to broadcast - never meet in one hash table: a
    mergeable sketch brackets each wanted rank, the rows below the bracket are only counted, and the
    exact order statistics are picked from the few values inside it.
    Nulls are left out, as in SQL.

    ``sized_by`` saves counting a derived input: a table it was derived from, with some of the keys
    and at least as many rows for each. Only when one of its groups is large is ``df`` counted.
    """
    keys = list(keys)
    prepared = df.withColumn("_q", F.col(value).cast("double"))
    if sized_by is not None:
        shared = [k for k in keys if k in sized_by.columns]
        if _groups_above(sized_by, shared, hot_rows).isEmpty():
            return _small_groups(prepared, keys, probs, aggs)
    hot = _groups_above(df, keys, hot_rows)
    if hot.isEmpty():
        return _small_groups(prepared, keys, probs, aggs)
    hot = hot.select(*keys)
    usual = _small_groups(prepared.join(hot, keys, "left_anti"), keys, probs, aggs)
    return usual.unionByName(_large_groups(prepared.join(hot, keys), keys, probs, aggs))


def exact_quantiles_of(
    df: DataFrame,
    *,
    keys: Sequence[str],
    probs: Mapping[str, Mapping[str, float]],
    aggs: Sequence[Column] = (),
    hot_rows: int = HOT_ROWS,
    sized_by: DataFrame | None = None,
) -> DataFrame:
    """As ``exact_quantiles`` for several columns: ``probs`` names the quantiles of each, {column: {name: share}}.

    One pass over the rows serves all columns. The rows of groups above ``hot_rows`` are stacked, one
    value a row, and selected together: every column of a group is a group of its own, and all share
    one set of brackets.
    """
    keys = list(keys)
    usual, hot = df, None
    shared = keys if sized_by is None else [k for k in keys if k in sized_by.columns]
    if not _groups_above(df if sized_by is None else sized_by, shared, hot_rows).isEmpty():
        hot = _groups_above(df, keys, hot_rows).select(*keys)
        usual = df.join(hot, keys, "left_anti")
    packed = [F.percentile(F.col(c).cast("double"), F.array(*[F.lit(float(p)) for p in named.values()])).alias(f"_{c}") for c, named in probs.items()]
    grouped = usual.groupBy(*keys).agg(*packed, *aggs)
    names = [n for named in probs.values() for n in named]
    picked = [F.col(f"_{c}")[i].alias(n) for c, named in probs.items() for i, n in enumerate(named)]
    extra = [c for c in grouped.columns if c not in (*keys, *[f"_{c}" for c in probs])]
    found = grouped.select(*keys, *picked, *extra)
    if hot is None:
        return found
    rows = df.join(hot, keys)
    shares = sorted({p for named in probs.values() for p in named.values()})
    stack = F.array(*[F.struct(F.lit(c).alias("_column"), F.col(c).cast("double").alias("_q")) for c in probs])
    large = _large_groups(rows.select(*keys, F.inline(stack)), [*keys, "_column"], {f"_p{i}": p for i, p in enumerate(shares)}, [])
    of = lambda c, n, p: F.max(F.when(F.col("_column") == c, F.col(f"_p{shares.index(p)}"))).alias(n)
    wide = large.groupBy(*keys).agg(*[of(c, n, p) for c, named in probs.items() for n, p in named.items()])
    if aggs:
        wide = wide.join(rows.groupBy(*keys).agg(*aggs), keys)
    return found.unionByName(wide.select(*keys, *names, *extra))


def _groups_above(df: DataFrame, keys: Sequence[str], hot_rows: int) -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > hot_rows)


def _small_groups(
    prepared: DataFrame, keys: list[str], probs: Mapping[str, float], aggs: Sequence[Column]
) -> DataFrame:
    wanted = F.array(*[F.lit(float(p)) for p in probs.values()])
    grouped = prepared.groupBy(*keys).agg(F.percentile("_q", wanted).alias("_p"), *aggs)
    return grouped.select(
        *keys,
        *[F.col("_p")[i].alias(n) for i, n in enumerate(probs)],
        *[c for c in grouped.columns if c not in (*keys, "_p")],
    )


def _large_groups(
    mine: DataFrame, keys: list[str], probs: Mapping[str, float], aggs: Sequence[Column]
) -> DataFrame:
    margin = 2.0 / SKETCH_ACCURACY
    wanted: list[float] = []
    for p in probs.values():
        wanted += [max(0.0, p - margin), min(1.0, p + margin)]
    sketched = mine.groupBy(*keys).agg(
        F.count("_q").alias("_n"),
        F.percentile_approx("_q", wanted, SKETCH_ACCURACY).alias("_s"),
        F.min("_q").alias("_lo"),
        F.max("_q").alias("_hi"),
        *aggs,
    )
    extra = [c for c in sketched.columns if c not in (*keys, "_n", "_s", "_lo", "_hi")]
    # A large group can hold few values that aren't null; then the margin is less than a rank and all of them are taken.
    few = F.col("_n") * margin < 2
    rank = [
        F.struct(
            F.lit(n).alias("name"),
            (F.lit(float(p)) * (F.col("_n") - 1)).alias("rank"),
            F.when(few | F.lit(p - margin <= 0), F.col("_lo")).otherwise(F.col("_s")[2 * i]).alias("low"),
            F.when(few | F.lit(p + margin >= 1), F.col("_hi")).otherwise(F.col("_s")[2 * i + 1]).alias("high"),
        )
        for i, (n, p) in enumerate(probs.items())
    ]
    brackets = sketched.select(*keys, F.array(*rank).alias("_b"))
    placed = mine.select(*keys, "_q").join(brackets, keys)
    placed = placed.where("_q is not null").select(*keys, "_q", F.explode("_b").alias("b"))
    below = placed.where(F.col("_q") < F.col("b.low")).groupBy(*keys, F.col("b.name").alias("name"))
    below = below.agg(F.count(F.lit(1)).alias("below"))
    inside = (
        placed.where(F.col("_q").between(F.col("b.low"), F.col("b.high")))
        .groupBy(*keys, F.col("b.name").alias("name"), F.col("b.rank").alias("rank"), "_q")
        .agg(F.count(F.lit(1)).alias("times"))
        .join(below, [*keys, "name"], "left")
    )
    order = Window.partitionBy(*keys, "name").orderBy("_q")
    upto = F.coalesce("below", F.lit(0)) + F.sum("times").over(
        order.rowsBetween(Window.unboundedPreceding, 0)
    )
    ranked = inside.withColumn("upto", upto)
    floor, ceil = F.floor("rank"), F.ceil("rank")
    picked = ranked.groupBy(*keys, "name", "rank").agg(
        F.min(F.when(F.col("upto") > floor, F.col("_q"))).alias("a"),
        F.min(F.when(F.col("upto") > ceil, F.col("_q"))).alias("b"),
    )
    result = picked.withColumn(
        "v", F.col("a") + (F.col("b") - F.col("a")) * (F.col("rank") - F.floor("rank"))
    )
    wide = result.groupBy(*keys).agg(
        *[F.max(F.when(F.col("name") == n, F.col("v"))).alias(n) for n in probs]
    )
    # A group whose values are all NULL has no picked values, but is a row all the same.
    return sketched.select(*keys, *extra).join(wide, keys, "left").select(*keys, *probs, *extra)
