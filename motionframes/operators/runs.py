"""Runs (gaps and islands) and everything that is cut along them."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .blocks import BLOCK_ROWS, attach, block_of, over_neighbours, running, running_steps


def runs(
    df: DataFrame,
    *,
    keys: Sequence[str],
    frame: str,
    state: Column,
    totals: Mapping[str, Column] | None = None,
    rows: int = BLOCK_ROWS,
) -> DataFrame:
    """W2. Half-open runs ``[start, stop)`` of equal ``state`` on consecutive frames.

    ``totals`` sums columns over each run. Runs are found inside frame blocks; only those that
    touch a block edge are merged across blocks.
    """
    totals = dict(totals or {})
    named = df.select(
        *keys,
        F.col(frame).cast("bigint").alias("_f"),
        state.alias("state"),
        *[c.alias(n) for n, c in totals.items()],
    ).withColumn("_blk", block_of("_f", rows))
    w = Window.partitionBy(*keys, "_blk").orderBy("_f")
    fresh = F.lag("_f").over(w).isNull() | (F.lag("_f").over(w) + 1 != F.col("_f"))
    fresh = fresh | ~F.lag("state").over(w).eqNullSafe(F.col("state"))
    local = (
        named.withColumn("_new", fresh.cast("int"))
        .withColumn("_run", F.sum("_new").over(w.rowsBetween(Window.unboundedPreceding, 0)))
        .groupBy(*keys, "_blk", "_run", "state")
        .agg(
            F.min("_f").alias("start"),
            (F.max("_f") + 1).alias("stop"),
            *[F.sum(n).alias(n) for n in totals],
        )
    )
    edge = ((F.col("start") % rows == 0) & (F.col("start") > 0)) | (F.col("stop") % rows == 0)
    edged = local.withColumn("_edge", F.when(edge, F.lit(-1)).otherwise(F.col("start")))
    e = Window.partitionBy(*keys, "_edge").orderBy("start")
    apart = F.lag("stop").over(e).isNull() | (F.lag("stop").over(e) != F.col("start"))
    apart = apart | ~F.lag("state").over(e).eqNullSafe(F.col("state"))
    return (
        edged.withColumn("_apart", apart.cast("int"))
        .withColumn("_part", F.sum("_apart").over(e.rowsBetween(Window.unboundedPreceding, 0)))
        .groupBy(*keys, "_edge", "_part", "state")
        .agg(
            F.min("start").alias("start"),
            F.max("stop").alias("stop"),
            *[F.sum(n).alias(n) for n in totals],
        )
        .withColumn("length", F.col("stop") - F.col("start"))
        .drop("_edge", "_part")
    )


def gap_runs(df: DataFrame, *, keys: Sequence[str], frame: str, solved: Column, rows: int = BLOCK_ROWS) -> DataFrame:
    """W2. The runs where ``solved`` is false."""
    return runs(df, keys=keys, frame=frame, state=solved, rows=rows).where(~F.col("state")).drop("state")


def longest_span(df: DataFrame, *, keys: Sequence[str], frame: str, solved: Column, rows: int = BLOCK_ROWS) -> DataFrame:
    """W3. The longest solved run per key (the first on a tie) and the share of frames it covers.

    A key without a solved frame has the empty run ``[0, 0)``.
    """
    found = runs(df, keys=keys, frame=frame, state=solved, rows=rows)
    best = F.max(F.when(F.col("state"), F.struct("length", -F.col("start"))))
    return (
        found.groupBy(*keys)
        .agg(best.alias("b"), F.sum("length").alias("frames"))
        .select(*keys, "frames", *[F.coalesce(F.col(f"b.{c}"), F.lit(0)).alias(n) for c, n in (("length", "length"), ("col2", "_from"))])
        .select(
            *keys,
            (-F.col("_from")).alias("start"),
            (F.col("length") - F.col("_from")).alias("stop"),
            "length",
            (F.col("length") / F.col("frames")).alias("coverage"),
        )
    )


def edge_segments(df: DataFrame, *, keys: Sequence[str], frame: str, contact: Column, rows: int = BLOCK_ROWS) -> DataFrame:
    """W4. Number each frame by the rising edges of ``contact`` up to it, from row to row; partial ends count too."""
    rise = lambda before, here: (here & ~before).cast("bigint")
    return running_steps(df, keys=keys, frame=frame, value=contact, step=rise, out="_rise", total="segment", rows=rows).drop("_rise")


def edge_status(
    df: DataFrame,
    *,
    keys: Sequence[str],
    frame: str,
    solved: Column,
    trim: int,
    rows: int = BLOCK_ROWS,
) -> DataFrame:
    """W17. ``inside`` is true where the row and its ``trim`` frames on both sides are all solved.

    Equal to dropping ``trim`` frames at both ends of every solved run.
    """
    def stage(w, _):
        around = w.rangeBetween(-trim, trim)
        return {"inside": solved & (F.count_if(solved).over(around) == 2 * trim + 1)}

    return over_neighbours(df, keys=keys, frame=frame, before=trim, after=trim, stages=[stage], rows=rows)


def long_enough_runs(
    df: DataFrame, *, keys: Sequence[str], frame: str, solved: Column, minimum: int, trim: int, rows: int = BLOCK_ROWS
) -> DataFrame:
    """W17. Solved runs of at least ``minimum`` frames, with the usable part left after trimming."""
    found = runs(df, keys=keys, frame=frame, state=solved, rows=rows).where("state").drop("state")
    usable = F.greatest(F.col("length") - 2 * trim, F.lit(0))
    return found.where(F.col("length") >= minimum).withColumn("usable", usable)


def trim_outer(df: DataFrame, *, keys: Sequence[str], frame: str, valid: Column, rows: int = BLOCK_ROWS) -> DataFrame:
    """W14. Cut the frames before the first and after the last valid one; interior gaps stay."""
    bounds = df.groupBy(*keys).agg(
        F.min(F.when(valid, F.col(frame))).alias("first_valid"),
        F.max(F.when(valid, F.col(frame))).alias("last_valid"),
        F.max(frame).alias("_last"),
    )
    joined = attach(df, bounds, keys=keys, frame=frame, last_frame="_last", rows=rows)
    return joined.where(F.col(frame).between(F.col("first_valid"), F.col("last_valid")))


def accept_windows(
    df: DataFrame,
    *,
    keys: Sequence[str],
    frame: str,
    status: str,
    window: int,
    stride: int,
    max_fraction: float,
    rows: int = BLOCK_ROWS,
) -> DataFrame:
    """W15. Sliding windows: refused with any UNAVAILABLE frame or too large an INTERPOLATED share."""
    def stage(w, _):
        ahead = w.rangeBetween(0, window - 1)
        return {
            "_n": F.count(F.lit(1)).over(ahead),
            "unavailable": F.count_if(F.col(status) == "UNAVAILABLE").over(ahead),
            "_interp": F.count_if(F.col(status) == "INTERPOLATED").over(ahead),
        }

    seen = over_neighbours(
        df, keys=keys, frame=frame, before=0, after=window - 1, stages=[stage], rows=rows
    ).where((F.col(frame) % stride == 0) & (F.col("_n") == window))
    share = F.col("_interp") / F.lit(float(window))
    return seen.select(
        *keys,
        F.col(frame).alias("start"),
        share.alias("fraction"),
        (F.col("unavailable") > 0).alias("has_unavailable"),
        ((F.col("unavailable") == 0) & (share <= max_fraction)).alias("accepted"),
    )


def with_run_bounds(
    df: DataFrame, *, keys: Sequence[str], frame: str, state: Column, rows: int = BLOCK_ROWS
) -> DataFrame:
    """Add ``run_start`` and ``run_stop`` of the run of equal ``state`` each frame lies in."""
    f = F.col(frame).cast("bigint")

    def edges(w, _):
        same = lambda step, gap: (step(f).over(w) == f + gap) & step(state).over(w).eqNullSafe(state)
        return {
            "_s": F.when(~F.coalesce(same(F.lag, -1), F.lit(False)), f),
            "_e": F.when(~F.coalesce(same(F.lead, 1), F.lit(False)), f + 1),
        }

    marked = over_neighbours(df, keys=keys, frame=frame, before=1, after=1, stages=[edges], rows=rows)
    scans = {"run_start": ("last", F.col("_s")), "run_stop": ("next", F.col("_e"))}
    return running(marked, keys=keys, frame=frame, scans=scans, rows=rows).drop("_s", "_e")


def overlapped_windows(
    df: DataFrame,
    *,
    keys: Sequence[str],
    frame: str,
    good: Column,
    window: int,
    stride: int,
    keep_from: int,
    rows: int = BLOCK_ROWS,
) -> DataFrame:
    """W16. The frames that the kept centres of overlapped windows cover, with their window's start.

    Windows start every ``stride`` frames of each good run while they fit into it; each keeps the
    ``stride`` frames from ``keep_from``, so the centres tile and a frame appears once.
    """
    bounded = with_run_bounds(df.withColumn("_good", good), keys=keys, frame=frame, state=F.col("_good"), rows=rows)
    index = F.floor((F.col(frame) - F.col("run_start") - keep_from) / stride)
    start = F.col("run_start") + index * stride
    return (
        bounded.where("_good")
        .withColumn("window_start", start)
        .where((index >= 0) & (F.col("window_start") + window <= F.col("run_stop")))
        .withColumn("window_offset", F.col(frame) - F.col("window_start"))
        .drop("_good", "run_start", "run_stop")
    )


def island_parity(
    islands: DataFrame,
    *,
    keys: Sequence[str],
    start: str,
    crossing: Column,
    rows: int = BLOCK_ROWS,
) -> DataFrame:
    """W13. Toggle a parity at each island whose gap to the island before it counts as a crossing.

    ``crossing`` may use ``before``, the previous island's row (null for the first).
    """
    whole = F.struct(*[F.col(c) for c in islands.columns if c not in keys])
    paired = running(islands, keys=keys, frame=start, scans={"before": ("previous", whole)}, rows=rows)
    flagged = paired.withColumn("crossed", F.coalesce(crossing, F.lit(False)))
    return running(
        flagged, keys=keys, frame=start, scans={"_x": ("sum", F.col("crossed").cast("bigint"))}, rows=rows
    ).withColumn("parity", F.col("_x") % 2).drop("_x")


def parity_vote(islands: DataFrame, *, keys: Sequence[str], max_fraction: float) -> DataFrame:
    """A33. The parity with fewer rows is withdrawn; refused when its share is above the limit."""
    sides = islands.groupBy(*keys).agg(
        F.sum(F.when(F.col("parity") == 0, F.col("length")).otherwise(0)).alias("even"),
        F.sum(F.when(F.col("parity") == 1, F.col("length")).otherwise(0)).alias("odd"),
    )
    fewer = F.least("even", "odd")
    share = fewer / (F.col("even") + F.col("odd"))
    return sides.select(
        *keys,
        "even",
        "odd",
        F.when(F.col("even") <= F.col("odd"), 0).otherwise(1).cast("bigint").alias("minority"),
        share.alias("fraction"),
        ((fewer > 0) & (share > max_fraction)).alias("refused"),
    )


def within_spans(
    df: DataFrame, spans: DataFrame, *, keys: Sequence[str], frame: str, rows: int = BLOCK_ROWS
) -> DataFrame:
    """The frames inside one half-open span ``start, stop`` per key."""
    limits = spans.select(*keys, F.col("start").alias("_a"), F.col("stop").alias("_b"))
    limits = limits.withColumn("_last", F.col("_b") - 1)
    joined = attach(df, limits, keys=keys, frame=frame, last_frame="_last", rows=rows)
    return joined.where((F.col(frame) >= F.col("_a")) & (F.col(frame) < F.col("_b"))).drop("_a", "_b")
