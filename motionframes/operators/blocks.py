"""Frame blocks: ordered work on one recording, split so that no task holds a whole recording.

A recording is ``keys`` plus an integer ``frame``. Every ordered operator works on blocks of
``rows`` consecutive frame numbers, so a key that holds a third of all rows is spread over many
tasks. Bounded look-around copies only the rows next to a block edge (``over_neighbours``).
Unbounded look-back is a two-level scan (``running``, ``running_steps``): inside each block, then
over one summary row per block, joined back on the block.

Frames may be absent. Rates, steps and fits see an absent frame as an end: a neighbour is a frame
number next to one's own. What adds up along a recording (turns, flips, edges) goes from each row
to the next one there is. Neither depends on where a block ends.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from ..session import checkpoint_dir

BLOCK_ROWS = 65_536
#: Rows that a task takes from a shuffle which ``dealt`` sizes.
TASK_ROWS = 500_000
#: Rows of one key that a single window may number.
HOT_ROWS = 4_000_000

Stage = Callable[[WindowSpec, WindowSpec], Mapping[str, Column]]


def block_of(frame: str, rows: int = BLOCK_ROWS) -> Column:
    return F.expr(f"cast(`{frame}` as bigint) div {int(rows)}L")


def over_neighbours(
    df: DataFrame,
    *,
    keys: Sequence[str],
    frame: str,
    before: int,
    after: int,
    stages: Sequence[Stage],
    rows: int = BLOCK_ROWS,
) -> DataFrame:
    """Add window columns that look at most ``before`` / ``after`` frame numbers away.

    Each stage maps two windows to new columns and may use columns of earlier stages: the block's,
    for ranges of frame numbers, and the one over consecutive frames, for ``lag`` and ``lead``, which
    an absent frame ends. ``before`` and ``after`` must cover all stages together.
    """
    f = F.col(frame).cast("bigint")
    first = F.expr(f"greatest(cast(`{frame}` as bigint) - {int(after)}L, 0L) div {int(rows)}L")
    last = F.expr(f"(cast(`{frame}` as bigint) + {int(before)}L) div {int(rows)}L")
    out = df.withColumn("_own", block_of(frame, rows)).withColumn(
        "_blk", F.explode(F.sequence(first, last))
    )
    window = Window.partitionBy(*keys, "_blk").orderBy(f)
    out = out.withColumn("_stretch", f - F.row_number().over(window))
    consecutive = Window.partitionBy(*keys, "_blk", "_stretch").orderBy(f)
    for stage in stages:
        out = out.withColumns(dict(stage(window, consecutive)))
    return out.where(F.col("_blk") == F.col("_own")).drop("_blk", "_own", "_stretch")


_TOTALS: dict[str, Callable[[Column, Column], Column]] = {
    "sum": lambda value, at: F.sum(value),
    "max": lambda value, at: F.max(value),
    "min": lambda value, at: F.min(value),
    "last": lambda value, at: F.max_by(value, F.when(value.isNotNull(), at)),
    "next": lambda value, at: F.min_by(value, F.when(value.isNotNull(), at)),
    "previous": lambda value, at: F.max_by(F.struct(value.alias("v")), at),
    "following": lambda value, at: F.min_by(F.struct(value.alias("v")), at),
}


def running(
    df: DataFrame,
    *,
    keys: Sequence[str],
    frame: str,
    scans: Mapping[str, tuple[str, Column]],
    ties: Sequence[str] = (),
    rows: int = BLOCK_ROWS,
) -> DataFrame:
    """Add prefix results per key in frame order. ``scans`` maps a new name to (kind, value).

    ``sum`` / ``max`` / ``min`` run up to and with the row; ``last`` / ``next`` give the nearest
    non-null value at or before / after the row; ``previous`` / ``following`` give the value of the
    neighbouring row, however far away its frame number is. Nulls in ``sum`` count as zero.
    ``ties`` orders rows that share a frame number.
    """
    prepared = df.withColumn("_blk", block_of(frame, rows))
    names = list(scans)
    prepared = prepared.withColumns({f"_v_{n}": scans[n][1] for n in names})
    at = F.struct(frame, *ties) if ties else F.col(frame)
    ordered = Window.partitionBy(*keys, "_blk").orderBy(frame, *ties)
    upto = ordered.rowsBetween(Window.unboundedPreceding, 0)
    onward = ordered.rowsBetween(0, Window.unboundedFollowing)

    local: dict[str, Column] = {}
    carry: dict[str, Column] = {}
    blocks = Window.partitionBy(*keys).orderBy("_blk")
    earlier = blocks.rowsBetween(Window.unboundedPreceding, -1)
    later = blocks.rowsBetween(1, Window.unboundedFollowing)
    for n in names:
        kind, value, total = scans[n][0], F.col(f"_v_{n}"), F.col(f"_t_{n}")
        if kind in ("sum", "max", "min"):
            step = getattr(F, kind)
            local[f"_l_{n}"], carry[f"_c_{n}"] = step(value).over(upto), step(total).over(earlier)
        elif kind == "last":
            local[f"_l_{n}"] = F.last(value, True).over(upto)
            carry[f"_c_{n}"] = F.last(total, True).over(earlier)
        elif kind == "next":
            local[f"_l_{n}"] = F.first(value, True).over(onward)
            carry[f"_c_{n}"] = F.first(total, True).over(later)
        elif kind == "previous":
            local[f"_l_{n}"] = F.lag(F.struct(value.alias("v"))).over(ordered)
            carry[f"_c_{n}"] = F.lag(total).over(blocks)
        elif kind == "following":
            local[f"_l_{n}"] = F.lead(F.struct(value.alias("v"))).over(ordered)
            carry[f"_c_{n}"] = F.lead(total).over(blocks)
        else:
            raise ValueError(f"unknown scan kind {kind!r}")

    totals = prepared.groupBy(*keys, "_blk").agg(
        *[_TOTALS[scans[n][0]](F.col(f"_v_{n}"), at).alias(f"_t_{n}") for n in names]
    )
    carried = totals.select(*keys, "_blk", *[c.alias(n) for n, c in carry.items()])
    joined = prepared.withColumns(local).join(carried, [*keys, "_blk"])

    final: dict[str, Column] = {}
    for n in names:
        kind, mine, theirs = scans[n][0], F.col(f"_l_{n}"), F.col(f"_c_{n}")
        if kind == "sum":
            final[n] = F.coalesce(mine, F.lit(0)) + F.coalesce(theirs, F.lit(0))
        elif kind in ("max", "min"):
            final[n] = (F.greatest if kind == "max" else F.least)(mine, theirs)
        elif kind in ("last", "next"):
            final[n] = F.coalesce(mine, theirs)
        else:
            final[n] = F.coalesce(mine, theirs)["v"]
    spent = ["_blk"] + [f"_{p}_{n}" for p in "vlc" for n in names]
    return joined.withColumns(final).drop(*spent)


def running_steps(
    df: DataFrame,
    *,
    keys: Sequence[str],
    frame: str,
    value: Column,
    step: Callable[[Column, Column], Column],
    out: str,
    total: str,
    rows: int = BLOCK_ROWS,
) -> DataFrame:
    """Add ``step(value of the previous row, value)`` as ``out`` and its running sum as ``total``.

    The previous row counts, however far away its frame number is. The step is null at a key's first
    row; null steps add nothing. Only a block's first and last value and its sum leave the block.
    """
    block = Window.partitionBy(*keys, "_blk").orderBy(frame)
    inside = df.withColumn("_blk", block_of(frame, rows)).withColumn("_v", value)
    inside = inside.withColumns({"_s": step(F.lag("_v").over(block), F.col("_v")), "_first": F.lag(F.lit(1)).over(block).isNull()})
    summary = inside.groupBy(*keys, "_blk").agg(
        F.min_by("_v", frame).alias("_a"), F.max_by("_v", frame).alias("_z"), F.sum("_s").alias("_t")
    )
    blocks = Window.partitionBy(*keys).orderBy("_blk")
    upto, earlier = (blocks.rowsBetween(Window.unboundedPreceding, end) for end in (0, -1))
    none = F.lit(0)
    edges = summary.withColumn("_e", step(F.lag("_z").over(blocks), F.col("_a")))
    carry = F.coalesce(F.sum("_t").over(earlier), none) + F.coalesce(F.sum("_e").over(upto), none)
    mine = F.coalesce(F.sum("_s").over(block.rowsBetween(Window.unboundedPreceding, 0)), none)
    joined = inside.withColumn("_u", mine).join(edges.select(*keys, "_blk", "_e", carry.alias("_c")), [*keys, "_blk"])
    found = {out: F.when(F.col("_first"), F.col("_e")).otherwise(F.col("_s")), total: F.col("_u") + F.col("_c")}
    return joined.withColumns(found).drop("_blk", "_v", "_s", "_first", "_u", "_e", "_c")


def small(df: DataFrame, *, limit: int = 100_000) -> DataFrame:
    """A configuration table for the broadcast side of a join, once its size has been checked.

    Beyond ``limit`` rows it is joined like any other table.
    """
    return F.broadcast(df) if df.limit(limit + 1).count() <= limit else df


def task_count(sized_by: DataFrame, *, per_row: int = 1, rows: int = TASK_ROWS) -> int:
    """How many tasks share a shuffle of ``per_row`` rows for each row of ``sized_by``; 0 where one could take them all.

    Bytes of a shuffle say little of the rows in it: narrow rows pack so well that partitions merged up
    to a size in bytes hold millions, and a task's sort or hash table grows with the table.
    """
    n = sized_by.count() * per_row
    return 0 if n <= rows else max(-(-n // rows), int(sized_by.sparkSession.conf.get("spark.sql.shuffle.partitions")))


def dealt(df: DataFrame, tasks: int, *keys: str) -> DataFrame:
    """The rows dealt by ``keys`` over so many tasks, see ``task_count``."""
    return df.repartition(tasks, *keys) if tasks else df


def dense_frames(
    df: DataFrame,
    *,
    keys: Sequence[str],
    order: Sequence[str],
    frame: str = "frame",
    minima: Mapping[str, Column] | None = None,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Number the rows of each key 0, 1, 2, ... in ``order``, nulls first. ``minima`` adds per-key minimum columns.

    Key sizes are counted first. While no key has more than ``hot_rows`` rows, one window per key
    numbers them. Otherwise the rows are dealt by ranges of key and order, so a large key is cut
    wherever a range ends, and counted per key and range: a row's number is its place in the range,
    shifted by what its key holds in earlier ranges. The ranges are checkpointed, because a second
    evaluation could cut elsewhere. The ``order`` columns are of any orderable type; rows equal in all
    of them are numbered in any order.
    """
    minima = dict(minima or {})
    if df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > hot_rows).isEmpty():
        whole = Window.partitionBy(*keys)
        number = F.row_number().over(whole.orderBy(*order)).cast("bigint") - 1
        return df.withColumns({frame: number, **{n: F.min(c).over(whole) for n, c in minima.items()}})
    checkpoint_dir(df.sparkSession)
    ranged = df.repartitionByRange(*keys, *order).sortWithinPartitions(*keys, *order)
    ranged = ranged.withColumns({"_part": F.spark_partition_id(), "_place": F.monotonically_increasing_id()}).checkpoint()
    parts = ranged.groupBy(*keys, "_part").agg(
        F.min("_place").alias("_first"), F.count(F.lit(1)).alias("_n"), *[F.min(c).alias(n) for n, c in minima.items()]
    )
    per_key = Window.partitionBy(*keys)
    earlier = per_key.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    shifts = parts.select(
        *[F.col(k).alias(f"_k_{k}") for k in keys],
        F.col("_part").alias("_p"),
        (F.coalesce(F.sum("_n").over(earlier), F.lit(0)) - F.col("_first")).alias("_shift"),
        *[F.min(n).over(per_key).alias(n) for n in minima],
    )
    same = F.col("_part") == F.col("_p")
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"_k_{k}"))
    numbered = ranged.join(shifts, same).withColumn(frame, F.col("_place") + F.col("_shift"))
    return numbered.select(*df.columns, frame, *minima)


def attach(
    df: DataFrame,
    per_key: DataFrame,
    *,
    keys: Sequence[str],
    frame: str,
    last_frame: str,
    how: str = "inner",
    rows: int = BLOCK_ROWS,
) -> DataFrame:
    """Join one row per key to the frames of that key, one copy of the row per frame block.

    ``per_key`` carries the key's highest frame in ``last_frame`` (dropped from the result), so a
    hot key's frames stay spread over its blocks instead of meeting in one join task.
    """
    copies = per_key.withColumn(
        "_blk", F.explode(F.sequence(F.lit(0).cast("bigint"), block_of(last_frame, rows)))
    ).drop(last_frame)
    return df.withColumn("_blk", block_of(frame, rows)).join(copies, [*keys, "_blk"], how).drop("_blk")
