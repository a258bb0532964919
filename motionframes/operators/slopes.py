"""Median of pairwise slopes (A24): a key of bounded size goes through its pairs in one call, a larger one counts crossings over ranges of points.

A pair of points with x_i < x_j has a slope of at most s exactly when the line y - s x puts j no higher than i. Sorted by that
height (the larger x first on ties), such pairs are inversions of the order by x, so a slope's rank is a count of inversions.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import checkpoint_dir
from .blocks import attach, dealt, dense_frames, task_count

#: Points of a key whose pairs one call goes through: at most 32,768 pairs a point. Larger keys are counted, without their pairs.
PAIRED_POINTS = 65_536

#: Pairs of a key whose slopes are kept at once, 17 MB. Of more pairs only the slopes near the median are kept.
KEPT_PAIRS = 2_100_000

#: Slopes drawn for each point of a key with more pairs: they tell what is near its median.
DRAWN = 64

#: Points whose keys one task goes through.
LISTED_POINTS = 100_000

#: Points of a key, neighbours by x, that one task sorts at once.
BLOCK_POINTS = 4096

#: Blocks are told apart digit by digit in this base (``conv`` writes it).
BASE = 32


def _near_median(x: np.ndarray, y: np.ndarray, beyond: np.ndarray, ranks: tuple[int, int]) -> tuple[float, float]:
    """The slopes of two neighbouring ranks; a drawn bracket says which slopes are kept, and is widened if it misses a rank.

    Slopes equal to an end of the bracket are only counted, so ties take no room.
    """
    n, rng = len(x), np.random.default_rng(0)
    upto = np.cumsum(n - beyond)
    pick = np.sort(rng.integers(0, upto[-1], DRAWN * n))
    i = np.searchsorted(upto, pick, side="right")
    j = n - (upto[i] - pick)
    drawn = np.sort(np.r_[-np.inf, (y[j] - y[i]) / (x[j] - x[i]), np.inf])
    # Five standard deviations of the median's place among the drawn.
    reach = int(2.5 * len(drawn) ** 0.5) + 1
    a, b = max(len(drawn) // 2 - reach, 0), min(len(drawn) // 2 + reach, len(drawn) - 1)
    while True:
        lo, hi = drawn[a], drawn[b]
        under = upto_lo = upto_hi = 0
        kept = []
        for p, first in enumerate(beyond):
            slopes = (y[first:] - y[p]) / (x[first:] - x[p])
            under += np.count_nonzero(slopes < lo)
            upto_lo += np.count_nonzero(slopes <= lo)
            upto_hi += np.count_nonzero(slopes <= hi)
            kept.append(slopes[(slopes > lo) & (slopes < hi)])
        reach *= 8
        if ranks[0] < under:
            a = max(a - reach, 0)
        elif ranks[1] >= upto_hi and b < len(drawn) - 1:
            b = min(b + reach, len(drawn) - 1)
        else:
            break
    inside = np.sort(np.concatenate(kept))

    def at(rank: int) -> float:
        place = rank - upto_lo
        if place < 0:
            return lo
        if place < len(inside):
            return inside[place]
        return hi if rank < upto_hi else np.nan

    return at(ranks[0]), at(ranks[1])


def paired_median(x: np.ndarray, y: np.ndarray) -> float:
    """Median of the slopes between points with different x; NaN without any."""
    order = np.argsort(x)
    x, y = x[order], y[order]
    n, beyond = len(x), np.searchsorted(x, x, side="right")
    pairs, at = int((n - beyond).sum()), 0
    if pairs == 0:
        return np.nan
    ranks = (pairs - 1) // 2, pairs // 2
    with np.errstate(over="ignore", invalid="ignore"):
        if pairs > KEPT_PAIRS:
            low, high = _near_median(x, y, beyond, ranks)
        else:
            slopes = np.empty(pairs)
            for i, j in enumerate(beyond):
                np.divide(y[j:] - y[i], x[j:] - x[i], out=slopes[at : at + n - j])
                at += n - j
            slopes.partition(ranks)
            low, high = slopes[list(ranks)]
        return low if low == high else low + (high - low) * 0.5


def _paired_medians(xs: pd.Series, ys: pd.Series) -> pd.Series:
    return pd.Series([paired_median(np.asarray(x), np.asarray(y)) for x, y in zip(xs, ys)], dtype=float)


def inversions(order: np.ndarray) -> np.ndarray:
    """Per row of a table of permutations, its pairs in which the larger number comes first."""
    rows, n = order.shape
    total = np.zeros(rows, dtype=np.int64)
    at = np.arange(n)
    width = 1
    while width < n:
        # The right half of each stretch of places against its left half: smaller numbers right of larger ones.
        stretch, right = at // (2 * width), (at // width) % 2 == 1
        sorted_at = np.argsort(stretch * n + order, axis=1)
        came = right[sorted_at]
        rights = np.cumsum(came, axis=1) - stretch[sorted_at] * width
        total += np.where(came, 0, rights).sum(axis=1)
        width *= 2
    return total


def _halves(a: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    high = a * 134217729.0
    high = high - (high - a)
    return high, a - high


def heights(x: np.ndarray, y: np.ndarray, slope: np.ndarray | float) -> tuple[np.ndarray, np.ndarray]:
    """``y - slope * x`` as a double and the part it leaves: order by both is right where doubles alone would round."""
    slope = np.asarray(slope, dtype=float)
    product = slope * x
    (sh, sl), (xh, xl) = _halves(slope), _halves(x)
    product_left = ((sh * xh - product) + sh * xl + sl * xh) + sl * xl
    height = y - product
    back = height - y
    left = (y - (height - back)) + (-product - back) - product_left
    whole = height + left
    return whole, left - (whole - height)


def crossed(x: np.ndarray, y: np.ndarray, probes: np.ndarray) -> np.ndarray:
    """Per probe, the pairs of points (sorted by x, then y) with different x whose slope is at most the probe."""
    ties = np.lexsort((np.arange(len(x)), -x))
    whole, left = heights(x[ties], y[ties], probes[:, None])
    return inversions(ties[np.lexsort((left, whole), axis=-1)])


def _within_blocks(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        found = [crossed(np.asarray(x), np.asarray(y), np.asarray(p)) for x, y, p in zip(batch["xs"], batch["ys"], batch["probes"])]
        yield pd.DataFrame({"id": batch["id"], "counts": found})


def _at_lo(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The points of each block with their heights at ``lo``."""
    for batch in batches:
        for row in batch.itertuples(index=False):
            x, y = np.asarray(row.xs), np.asarray(row.ys)
            whole, left = heights(x, y, row.lo)
            at = np.arange(len(x))
            yield pd.DataFrame({"id": row.id, "h": whole, "l": left, "back": -x, "blk": row.blk, "at": at, "x": x, "y": y})


def _at_probes(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The points of each block with their heights at every probe, once per digit of the block's number."""
    for batch in batches:
        for row in batch.itertuples(index=False):
            x, y, slopes = np.asarray(row.xs), np.asarray(row.ys), np.asarray(row.probes)
            whole, left = heights(x, y, slopes[:, None])
            probe, at = (grid.ravel() for grid in np.indices(whole.shape))
            same = {"h": whole.ravel(), "l": left.ravel(), "back": -x[at], "blk": row.blk, "at": at}
            for level in range(row.levels):
                section, digit = divmod(row.blk // BASE**level, BASE)
                yield pd.DataFrame({"id": row.id, "probe": probe, "level": level, "section": section, "digit": digit, **same})


def _runs(batch: pd.DataFrame, names: Sequence[str]) -> Iterator[tuple[tuple[int, ...], slice]]:
    """Stretches of equal ``names`` in a sorted batch."""
    values = batch[list(names)].to_numpy()
    if len(values) == 0:
        return
    starts = np.flatnonzero(np.r_[True, (values[1:] != values[:-1]).any(axis=1)])
    for a, b in zip(starts, np.r_[starts[1:], len(values)]):
        yield tuple(int(v) for v in values[a]), slice(a, b)


def _between_blocks(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Of rows in order of height: per group, pairs in which the larger digit comes first, and how often each digit came."""
    part = TaskContext.get().partitionId()
    names = ["id", "probe", "level", "section"]
    found: dict[tuple[int, ...], list] = {}
    for batch in batches:
        digits = batch["digit"].to_numpy()
        for name, rows in _runs(batch, names):
            inside, seen = found.get(name, (0, np.zeros(BASE, dtype=np.int64)))
            mine = digits[rows]
            came = np.zeros((len(mine) + 1, BASE), dtype=np.int64)
            came[0] = seen
            came[np.arange(1, len(mine) + 1), mine] = 1
            came = came.cumsum(axis=0)
            upto = came[:-1].cumsum(axis=1)
            larger = upto[:, -1] - upto[np.arange(len(mine)), mine]
            found[name] = [inside + int(larger.sum()), came[-1]]
    if found:
        rows = [[*name, part, inside, seen.tolist()] for name, (inside, seen) in found.items()]
        yield pd.DataFrame(rows, columns=[*names, "part", "inside", "seen"])


def _next_in_order(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Of rows in order of height at ``lo``: per key the least slope between neighbours that still cross, and the end points."""
    part = TaskContext.get().partitionId()
    found: dict[int, list] = {}
    for batch in batches:
        xs, ys = batch["x"].to_numpy(), batch["y"].to_numpy()
        for (name,), rows in _runs(batch, ["id"]):
            x, y = xs[rows], ys[rows]
            mine = found.setdefault(name, [np.inf, x[0], y[0], None, None])
            if mine[3] is not None:
                x, y = np.r_[mine[3], x], np.r_[mine[4], y]
            step, rise = np.diff(x), np.diff(y)
            mine[0] = min(mine[0], (rise[step > 0] / step[step > 0]).min(initial=np.inf))
            mine[3:] = x[-1], y[-1]
    if found:
        rows = [[name, part, *mine] for name, mine in found.items()]
        yield pd.DataFrame(rows, columns=["id", "part", "best", "x0", "y0", "x1", "y1"])


def _per_block(state: DataFrame, blocks: DataFrame, *columns: str) -> DataFrame:
    """A key's row meets the key's blocks, one copy per block."""
    copies = state.select("id", *columns, F.explode(F.sequence(F.lit(0).cast("bigint"), "last")).alias("blk"))
    return blocks.join(copies, ["id", "blk"])


def _next_slopes(state: DataFrame, blocks: DataFrame) -> DataFrame:
    """Per key the least slope above ``lo``. The next two points to change places are neighbours in the order at ``lo``, the one with
    the larger x above; that order is exact, so a slope that rounds down to ``lo`` still counts."""
    rows = _per_block(state, blocks, "lo").select("id", "blk", "xs", "ys", "lo")
    rows = rows.mapInPandas(_at_lo, "id long, h double, l double, back double, blk long, at int, x double, y double")
    order = ["id", "h", "l", "back", "blk", "at"]
    parts = rows.repartitionByRange(*order).sortWithinPartitions(*order).select("id", "x", "y")
    parts = parts.mapInPandas(_next_in_order, "id long, part int, best double, x0 double, y0 double, x1 double, y1 double")
    line = Window.partitionBy("id").orderBy("part")
    step, rise = F.col("x0") - F.lag("x1").over(line), F.col("y0") - F.lag("y1").over(line)
    edges = parts.withColumn("edge", F.when(step > 0, rise / step))
    return edges.groupBy("id").agg(F.min(F.least("best", "edge")).alias("next"))


def _between(state: DataFrame, blocks: DataFrame) -> DataFrame:
    """Per key and probe, crossed pairs whose points lie in different blocks.

    Two blocks differ first in one digit of their number. Per digit the points of blocks alike above it are sorted by height
    over ranges; a range gives its own pairs and a count per digit, and the counts of earlier ranges give the pairs between ranges.
    """
    many = state.where("last > 0").withColumn("levels", F.length(F.conv(F.col("last").cast("string"), 10, BASE)))
    rows = _per_block(many, blocks, "probes", "levels").select("id", "blk", "xs", "ys", "probes", "levels")
    named = "id long, probe int, level int, section long, digit int, h double, l double, back double, blk long, at int"
    rows = rows.mapInPandas(_at_probes, named)
    order = ["id", "probe", "level", "section", "h", "l", "back", "blk", "at"]
    parts = rows.repartitionByRange(*order).sortWithinPartitions(*order).select("id", "probe", "level", "section", "digit")
    parts = parts.mapInPandas(_between_blocks, "id long, probe int, level int, section long, part int, inside long, seen array<long>")
    group = ["id", "probe", "level", "section"]
    digits = parts.select(*group, "part", "inside", F.posexplode("seen").alias("digit", "c"))
    ahead = Window.unboundedPreceding, -1
    earlier = F.sum("c").over(Window.partitionBy(*group, "digit").orderBy("part").rowsBetween(*ahead))
    larger = F.sum("earlier").over(Window.partitionBy(*group, "part").orderBy(F.desc("digit")).rowsBetween(*ahead))
    pairs = F.col("c") * F.coalesce("larger", F.lit(0)) + F.when(F.col("digit") == 0, F.col("inside")).otherwise(0)
    digits = digits.withColumn("earlier", F.coalesce(earlier, F.lit(0))).withColumn("larger", larger)
    return digits.select("id", "probe", pairs.alias("pairs"))


def _probes() -> Column:
    """The double above the next slope (itself rounded), even steps through the bracket, steps that close in on the rank's place by proportion, and the seeds."""
    lo, hi, wide = F.col("lo"), F.col("hi"), F.col("hi") - F.col("lo")
    place = lo + wide * (F.col("k") - F.col("c_lo")) / (F.col("c_hi") - F.col("c_lo"))
    even = [lo + wide * (j / 16) for j in range(1, 16)]
    near = [place + sign * wide * 4.0**-j for j in range(2, 9) for sign in (-1, 1)]
    inside = F.filter(F.concat("seeds", F.array(*even, *near)), lambda p: (p > lo) & (p < hi))
    return F.array_sort(F.array_distinct(F.concat(inside, F.array("after"))))


def _narrowed(state: DataFrame) -> DataFrame:
    """The bracket after a round's counts. The next slope is the wanted one once the count just above it reaches the rank."""
    counted = F.arrays_zip(F.col("probes").alias("p"), F.col("counts").alias("c"))
    below = F.filter(counted, lambda v: v["c"] < F.col("k"))
    above = F.filter(counted, lambda v: v["c"] >= F.col("k"))
    at = F.element_at(F.col("counts"), F.array_position("probes", F.col("after")).cast("int"))
    step = state.withColumns({"below": F.try_element_at(below, F.lit(-1)), "above": F.try_element_at(above, F.lit(1)), "at": at})
    hit = F.col("at") >= F.col("k")
    again = hit & F.col("even") & F.col("first").isNull() & (F.col("at") == F.col("k"))
    step = step.withColumns({"hit": hit, "again": again})
    return step.select(
        "id", "last", "even", "seeds", "bound", "pairs",
        (F.col("k") + F.col("again").cast("bigint")).alias("k"),
        F.when(F.col("again"), F.col("after")).otherwise(F.coalesce("below.p", "lo")).alias("lo"),
        F.when(F.col("again"), F.col("at")).otherwise(F.coalesce("below.c", "c_lo")).alias("c_lo"),
        F.when(F.col("again"), F.col("bound")).otherwise(F.coalesce("above.p", "hi")).alias("hi"),
        F.when(F.col("again"), F.col("pairs")).otherwise(F.coalesce("above.c", "c_hi")).alias("c_hi"),
        F.when(F.col("hit"), F.coalesce("first", "next")).otherwise(F.col("first")).alias("first"),
        F.when(F.col("hit") & ~F.col("again"), F.col("next")).alias("second"),
    )


def median_slopes(
    points: DataFrame, *, keys: Sequence[str], x: str, y: str, rows: int = BLOCK_POINTS, paired: int = PAIRED_POINTS
) -> DataFrame:
    """Per key the median of the slopes between its points with different x (``slope``), exactly; an even number takes the mean of two.

    The sizes of the keys are counted first. A key of at most ``paired`` points goes through its pairs, so its work is bounded by
    half that number a point; larger keys are counted (``_counted``). Points without a finite x and y take no part; keys without two
    different x have no row, neither have keys that are null.
    """
    checkpoint_dir(points.sparkSession)
    names = [f"_key{i}" for i in range(len(keys))]
    given = points.select(*[F.col(k).alias(n) for k, n in zip(keys, names)], F.col(x).cast("double").alias("x"), F.col(y).cast("double").alias("y"))
    finite = (F.abs("x") < float("inf")) & (F.abs("y") < float("inf"))
    given = given.where(finite).dropna(subset=names).checkpoint()
    large = given.groupBy(*names).agg(F.count(F.lit(1)).alias("m")).where(F.col("m") > paired).select(*names)
    none_large = large.isEmpty()
    few = given if none_large else given.join(large, names, "left_anti")
    # Said to be nondeterministic, or the filter below would compute every median again.
    median = F.pandas_udf(_paired_medians, "double").asNondeterministic()
    listed = dealt(few, task_count(given, rows=LISTED_POINTS), *names).groupBy(*names).agg(F.collect_list(F.struct("x", "y")).alias("p"))
    found = listed.select(*names, median(F.col("p.x"), F.col("p.y")).alias("slope")).where("slope is not null")
    if not none_large:
        found = found.unionByName(_counted(given.join(large, names, "left_semi"), names, rows))
    return found.select(*[F.col(n).alias(k) for n, k in zip(names, keys)], "slope")


def _counted(points: DataFrame, names: Sequence[str], rows: int) -> DataFrame:
    """The medians of keys of any size, from finite points with the keys ``names``.

    Every round narrows all keys' brackets at once by the counts at some thirty slopes, so rounds grow with the logarithm of
    the number of points. Blocks of ``rows`` points count their own pairs; pairs between blocks come from ranges of sorted
    heights. No task holds a key and no pair is formed.
    """
    placed = dense_frames(points, keys=names, order=["x", "y"], frame="pos").checkpoint()
    tied = placed.groupBy(*names, "x").agg(F.count(F.lit(1)).alias("m"), F.min("y").alias("a"), F.max("y").alias("b"))
    half = F.expr("(m * (m - 1)) div 2")
    sizes = tied.groupBy(*names).agg(F.sum("m").alias("m"), F.sum(half).alias("same"), (F.max("b") - F.min("a")).alias("high"))
    sizes = sizes.withColumn("pairs", half - F.col("same")).where("pairs > 0").withColumn("id", F.monotonically_increasing_id())
    sizes = sizes.select(*names, "id", "pairs", "high", "m", (F.col("m") - 1).alias("top")).checkpoint()
    with_id = attach(placed, sizes, keys=names, frame="pos", last_frame="top").select("id", "pos", "x", "y", "m").checkpoint()

    # The steps from a point to its neighbour bound all slopes, those to the point half a key away foretell the median.
    def steps(gap: Column) -> DataFrame:
        ahead = with_id.select("id", (F.col("pos") - gap).alias("pos"), F.col("x").alias("x2"), F.col("y").alias("y2"))
        return with_id.join(ahead, ["id", "pos"]).where("x2 > x")

    least = steps(F.lit(1)).groupBy("id").agg(F.min(F.col("x2") - F.col("x")).alias("step"))
    shares = [j / 20 for j in range(1, 20)]
    seeds = steps(F.expr("m div 2")).groupBy("id").agg(F.percentile_approx((F.col("y2") - F.col("y")) / (F.col("x2") - F.col("x")), shares, 1000).alias("seeds"))
    bound = F.col("high") / F.col("step") * 1.000001 + 1e-300
    none = F.array().cast("array<double>")
    state = sizes.join(least, "id").join(seeds, "id", "left").select(
        "id", F.expr(f"top div {rows}").alias("last"), (F.col("pairs") % 2 == 0).alias("even"), F.coalesce("seeds", none).alias("seeds"), bound.alias("bound"), "pairs", F.expr("(pairs + 1) div 2").alias("k"),
        (-bound).alias("lo"), F.lit(0).cast("bigint").alias("c_lo"), bound.alias("hi"), F.col("pairs").alias("c_hi"),
        F.lit(None).cast("double").alias("first"), F.lit(None).cast("double").alias("second"),
    ).checkpoint()
    listed = F.sort_array(F.collect_list(F.struct("pos", "x", "y")))
    blocks = with_id.groupBy("id", F.expr(f"pos div {rows}").alias("blk")).agg(listed.alias("p"))
    blocks = blocks.select("id", "blk", F.col("p.x").alias("xs"), F.col("p.y").alias("ys")).checkpoint()

    solved, cut = [], not state.where("last > 0").isEmpty()
    while not state.isEmpty():
        following = F.least(F.col("hi"), F.coalesce("next", "hi"))
        asked = state.join(_next_slopes(state, blocks), "id", "left").withColumn("next", following)
        asked = asked.withColumn("after", F.col("next") + F.abs("next") * 2.0**-51 + 5e-324).withColumn("probes", _probes()).checkpoint()
        inside = _per_block(asked, blocks, "probes").select("id", "xs", "ys", "probes").mapInPandas(_within_blocks, "id long, counts array<long>")
        pairs = inside.select("id", F.posexplode("counts").alias("probe", "pairs"))
        pairs = pairs.unionByName(_between(asked, blocks)) if cut else pairs
        counts = pairs.groupBy("id", "probe").agg(F.sum("pairs").alias("pairs")).groupBy("id")
        counts = counts.agg(F.sort_array(F.collect_list(F.struct("probe", "pairs")))["pairs"].alias("counts"))
        after = _narrowed(asked.join(counts, "id")).checkpoint()
        solved.append(after.where("second is not null").select("id", "even", "first", "second"))
        state = after.where("second is null")
    found = solved[0] if solved else state.select("id", "even", "first", "second")
    for more in solved[1:]:
        found = found.unionByName(more)
    middle = F.when(F.col("even"), F.col("first") + (F.col("second") - F.col("first")) * 0.5).otherwise(F.col("first"))
    return sizes.join(found, "id").select(*names, middle.alias("slope"))
