"""Aggregates over frames, takes and parts."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import quat as Q
from ..session import checkpoint_dir
from .blocks import BLOCK_ROWS, running_steps, small
from .quantiles import exact_quantiles
from .slopes import median_slopes


def magnitude_bands(
    df: DataFrame,
    *,
    keys: Sequence[str],
    magnitude: str,
    valid: Column,
    median_max: float,
    median_min: float,
    floor_p95: float,
) -> DataFrame:
    """A1. Median and p95 of valid rows. Too low only when the median AND the p95 are low."""
    spread = exact_quantiles(df.where(valid), keys=keys, value=magnitude, probs={"median": 0.5, "p95": 0.95})
    return spread.withColumns(
        {
            "too_high": F.col("median") > median_max,
            "too_low": (F.col("median") < median_min) & (F.col("p95") < floor_p95),
        }
    )


def mask_discipline(df: DataFrame, *, keys: Sequence[str], valid: Column, components: Sequence[str]) -> DataFrame:
    """A2. Valid rows lacking a component, and invalid rows carrying one."""
    every, some = F.lit(True), F.lit(False)
    for c in components:
        every, some = every & F.col(c).isNotNull(), some | F.col(c).isNotNull()
    return df.groupBy(*keys).agg(
        F.count_if(valid & ~every).alias("valid_missing"), F.count_if(~valid & some).alias("invalid_present")
    )


def norm_and_coverage(df: DataFrame, *, keys: Sequence[str], norm: Column, rate: Column, valid: Column) -> DataFrame:
    """A3. Largest unit-norm deviation and rate over valid rows, coverage, and whether nothing is valid."""
    return df.groupBy(*keys).agg(
        F.max(F.when(valid, F.abs(norm - 1.0))).alias("norm_deviation"),
        F.max(F.when(valid, rate)).alias("max_rate"),
        F.avg(valid.cast("double")).alias("coverage"),
        (F.count_if(valid) == 0).alias("no_valid_row"),
    )


def time_axis(
    df: DataFrame,
    *,
    keys: Sequence[str],
    frame: str,
    time: str,
    nominal_s: float,
    tolerance_s: float,
    rows: int = BLOCK_ROWS,
) -> DataFrame:
    """A4. Strictly increasing times from row to row, and the median step against the nominal one."""
    step = lambda before, here: here - before
    stepped = running_steps(df, keys=keys, frame=frame, value=F.col(time), step=step, out="_d", total="_sum", rows=rows).drop("_sum")
    out = exact_quantiles(
        stepped, keys=keys, value="_d", probs={"median_step": 0.5},
        aggs=[F.coalesce(F.min(F.col("_d") > 0), F.lit(True)).alias("increasing")], sized_by=df,
    )
    return out.withColumn("rate_off", F.abs(F.col("median_step") - nominal_s) > tolerance_s)


def quasi_static(
    df: DataFrame,
    *,
    keys: Sequence[str],
    magnitude: str,
    rate: str,
    gravity: float,
    max_rate: float,
    tolerance: float,
    bound: float,
) -> DataFrame:
    """A17. Mean and population spread of slow rows near one gravity; rows above a bound."""
    m = F.col(magnitude)
    checked = m.isNotNull() & F.col(rate).isNotNull()
    still = checked & (F.col(rate) < max_rate) & (F.abs(m - gravity) < tolerance)
    return (
        df.groupBy(*keys)
        .agg(
            F.count_if(checked).alias("checked"),
            F.count_if(still).alias("still"),
            F.avg(F.when(still, m)).alias("mean"),
            F.stddev_pop(F.when(still, m)).alias("spread"),
            F.count_if(checked & (m > bound)).alias("breaches"),
        )
        .withColumn("gravity_error", F.abs(F.col("mean") - gravity))
    )


def joint_ranges(
    df: DataFrame,
    limits: DataFrame,
    *,
    keys: Sequence[str],
    name: str,
    value: str,
) -> DataFrame:
    """A18. Per key and coordinate: range, share outside its limits, and impossible spans.

    ``limits`` has one row per coordinate (low, high, span_limit); coordinates without a limit are
    not checked.
    """
    joined = df.join(small(limits), name)
    outside = (F.col(value) < F.col("low")) | (F.col(value) > F.col("high"))
    return (
        joined.groupBy(*keys, name)
        .agg(
            F.min(value).alias("min"),
            F.max(value).alias("max"),
            (F.max(value) - F.min(value)).alias("span"),
            F.count_if(outside).alias("rows_outside"),
            F.avg(outside.cast("double")).alias("share_outside"),
            F.first("span_limit").alias("span_limit"),
        )
        .withColumn("came_apart", F.coalesce(F.col("span") > F.col("span_limit"), F.lit(False)))
    )


def worst_coordinate(ranges: DataFrame, *, keys: Sequence[str], name: str) -> DataFrame:
    """A18, T3. Coordinate with the largest share outside (first by name on a tie), none at zero."""
    share = F.col("share_outside")
    return ranges.groupBy(*keys).agg(
        F.min_by(F.when(share > 0, F.col(name)), F.struct(-share, F.col(name))).alias("worst"),
        F.max(share).alias("worst_share"),
        F.count_if("came_apart").alias("failed"),
    )


def rows_outside(df: DataFrame, limits: DataFrame, *, keys: Sequence[str], frame: str, name: str, value: str) -> DataFrame:
    """A18. Frames where any coordinate is outside."""
    outside = (F.col(value) < F.col("low")) | (F.col(value) > F.col("high"))
    frames = df.join(small(limits), name).groupBy(*keys, frame).agg(F.max(outside).alias("any"))
    return frames.groupBy(*keys).agg(F.count_if("any").alias("frames_outside"), F.count(F.lit(1)).alias("frames"))


def absent_coordinates(df: DataFrame, limits: DataFrame, *, name: str) -> DataFrame:
    """A18. Limits that no row stands for."""
    return limits.join(df.select(name).distinct(), name, "left_anti").select(name)


def pool_over_trials(df: DataFrame, *, keys: Sequence[str], trial: str, value: str) -> DataFrame:
    """A19. Median over trials, the range they span, and how many trials had a value."""
    present = df.where(F.col(value).isNotNull())
    out = exact_quantiles(
        present, keys=keys, value=value, probs={"pooled": 0.5},
        aggs=[(F.max(value) - F.min(value)).alias("spread"), F.count_distinct(trial).alias("trials")],
    )
    return out


def composite_pairs(pairs: DataFrame, *, bridge: DataFrame) -> DataFrame:
    """A19. Add the span over a shared middle node where both of its parts are declared.

    ``pairs`` holds (a, b); ``bridge`` names the middle nodes, so each has a bounded set of pairs.
    """
    upper = pairs.join(bridge, pairs.b == bridge.node).select(pairs.a, F.col("node"))
    lower = pairs.select(F.col("a").alias("node"), F.col("b").alias("far"))
    spans = upper.join(lower, "node").select("a", F.col("far").alias("b"))
    return pairs.select("a", "b").unionByName(spans).distinct()


def rate_sensitivity(df: DataFrame, *, keys: Sequence[str], rate: str, uncertainty: float) -> DataFrame:
    """A21. Mean, p95 and maximum of squared rate times an uncertainty."""
    term = df.withColumn("_term", F.col(rate) * F.col(rate) * uncertainty)
    return exact_quantiles(
        term, keys=keys, value="_term", probs={"p95": 0.95},
        aggs=[F.avg("_term").alias("mean"), F.max("_term").alias("max")],
    )


def mean_direction(df: DataFrame, *, keys: Sequence[str], vector: str) -> DataFrame:
    """A23. Renormalised mean of the unit vectors (null at zero mean)."""
    u = df.withColumn("_u", Q.unit(F.col(vector)))
    mean = u.groupBy(*keys).agg(*[F.avg(F.col("_u")[c]).alias(c) for c in "xyz"])
    return mean.select(*keys, Q.unit(Q.vec(*[F.col(c) for c in "xyz"])).alias("direction"))


def robust_slopes(
    points: DataFrame,
    rows: DataFrame,
    *,
    keys: Sequence[str],
    x: str,
    y: str,
    row_x: str,
    row_y: str,
) -> DataFrame:
    """A24. Median of the pairwise slopes between segment points; least squares below two segments.

    Only one point per segment is compared, never the rows; the points are checkpointed. Two or more segments that all have the
    same x have a NULL slope.
    """
    names = list(keys)
    checkpoint_dir(points.sparkSession)
    points = points.select(*names, x, y).checkpoint()
    pairwise = median_slopes(points, keys=names, x=x, y=y).withColumnRenamed("slope", "_ts")
    counts = points.groupBy(*names).agg(F.count(F.lit(1)).alias("segments"))
    line = rows.groupBy(*names).agg(F.regr_slope(F.col(row_y), F.col(row_x)).alias("_ls"))
    return counts.join(line, names).join(pairwise, names, "left").select(
        *names, "segments", F.when(F.col("segments") >= 2, F.col("_ts")).otherwise(F.col("_ls")).alias("slope")
    )


def whole_body(df: DataFrame, *, keys: Sequence[str], mass: str, position: Sequence[str], velocity: Sequence[str]) -> DataFrame:
    """A28. Weighted centre and velocity, and the momentum about the centre, per group of parts."""
    m = F.col(mass)
    p, v = [F.col(c) for c in position], [F.col(c) for c in velocity]
    moment = Q.cross(Q.vec(*p), Q.vec(*v))
    sums = df.groupBy(*keys).agg(
        F.sum(m).alias("mass"),
        *[F.sum(m * c).alias(f"_p{i}") for i, c in enumerate(p)],
        *[F.sum(m * c).alias(f"_v{i}") for i, c in enumerate(v)],
        *[F.sum(m * moment[c]).alias(f"_h{i}") for i, c in enumerate("xyz")],
    )
    centre = [F.col(f"_p{i}") / F.col("mass") for i in range(3)]
    speed = [F.col(f"_v{i}") / F.col("mass") for i in range(3)]
    # sum m (p - c) x (v - u) = sum m p x v - M c x u
    own = Q.cross(Q.vec(*centre), Q.vec(*speed))
    return sums.select(
        *keys,
        "mass",
        *[c.alias(f"centre_{n}") for c, n in zip(centre, "xyz")],
        *[c.alias(f"velocity_{n}") for c, n in zip(speed, "xyz")],
        *[(F.col(f"_h{i}") - F.col("mass") * own[n]).alias(f"momentum_{n}") for i, n in enumerate("xyz")],
    )


def mass_properties(df: DataFrame, *, label: Sequence[str], position: Sequence[str], point_mass: float, cell: float) -> DataFrame:
    """A29. Mass, centroid and inertia about it of equal small cubes grouped by label."""
    x, y, z = (F.col(c) for c in position)
    n = F.col("points")
    sums = df.groupBy(*label).agg(
        F.count(F.lit(1)).alias("points"),
        *[F.avg(c).alias(f"centre_{a}") for c, a in zip((x, y, z), "xyz")],
        *[F.var_pop(c).alias(f"_v{a}") for c, a in zip((x, y, z), "xyz")],
        *[F.covar_pop(c, d).alias(f"_c{a}") for c, d, a in ((x, y, "xy"), (x, z, "xz"), (y, z, "yz"))],
    )
    cube = F.lit(point_mass * cell * cell / 6.0) * n
    return sums.select(
        *label,
        (n * point_mass).alias("mass"),
        *[F.col(f"centre_{a}") for a in "xyz"],
        *[(F.lit(point_mass) * n * (F.col(f"_v{a}") + F.col(f"_v{b}")) + cube).alias(f"inertia_{c}{c}")
          for a, b, c in (("y", "z", "x"), ("x", "z", "y"), ("x", "y", "z"))],
        *[(-F.lit(point_mass) * n * F.col(f"_c{a}")).alias(f"inertia_{a}") for a in ("xy", "xz", "yz")],
    )


def tree_closure(edges: DataFrame, *, depth: int) -> DataFrame:
    """(ancestor, node, depth) for every node and each of its ancestors, itself included.

    ``edges`` has one row per node with its parent (null at a root); ``depth`` is the declared
    height of the tree.
    """
    parents = edges.select(F.col("node").alias("_up"), F.col("parent").alias("_next"))
    step = edges.select(F.col("node").alias("ancestor"), "node", F.lit(0).alias("depth"))
    closure = step
    for _ in range(depth):
        step = (
            step.join(parents, step["ancestor"] == parents["_up"])
            .where(F.col("_next").isNotNull())
            .select(F.col("_next").alias("ancestor"), "node", (F.col("depth") + 1).alias("depth"))
        )
        closure = closure.unionByName(step)
    return closure


def roll_up(df: DataFrame, closure: DataFrame, *, keys: Sequence[str], node: str, values: Sequence[str]) -> DataFrame:
    """A30. Sum of a node's descendants (itself included), at every node.

    Rows are summed per node before the join, so the join sees one row per key and node.
    """
    per_node = df.groupBy(*keys, F.col(node).alias("node")).agg(*[F.sum(v).alias(v) for v in values])
    return (
        per_node.join(small(closure.select("ancestor", "node")), "node")
        .groupBy(*keys, F.col("ancestor").alias("node"))
        .agg(*[F.sum(v).alias(v) for v in values])
    )


def mass_from_force(df: DataFrame, *, keys: Sequence[str], left: str, right: str, gravity: float) -> DataFrame:
    """A31. Scale from the mean of two vertical forces."""
    return df.groupBy(*keys).agg((F.avg(F.col(left) + F.col(right)) / F.lit(abs(gravity))).alias("mass"))


def mean_heading(df: DataFrame, *, keys: Sequence[str], angle: str) -> DataFrame:
    """A32. Circular mean."""
    return df.groupBy(*keys).agg(F.atan2(F.avg(F.sin(angle)), F.avg(F.cos(angle))).alias("heading"))


def corpus_summary(takes: DataFrame, *, value: str, limit: float) -> DataFrame:
    """A34. Median, p99, maximum and the number of offenders over all takes, as one row."""
    out = exact_quantiles(
        takes.withColumn("_all", F.lit(1)), keys=["_all"], value=value, probs={"median": 0.5, "p99": 0.99},
        aggs=[F.max(value).alias("max"), F.count_if(F.col(value) > limit).alias("offenders"), F.count(F.lit(1)).alias("takes")],
    )
    return out.drop("_all")


def witnessed_items(texts: DataFrame, tokens: Sequence[str], *, bundle: str, text: str) -> DataFrame:
    """A35. Per bundle: how many required tokens some text of the bundle contains.

    ``tokens`` is a declaration of the caller; it is folded into one expression per text, so nothing is
    joined pairwise.
    """
    tokens = sorted(set(tokens))
    found = F.filter(F.array(*[F.lit(t) for t in tokens]), lambda t: F.contains(F.col(text), t))
    seen = texts.select(bundle, F.explode_outer(found).alias("item")).distinct()
    return seen.groupBy(bundle).agg(F.count("item").alias("witnessed")).withColumn(
        "coverage", F.col("witnessed") / F.lit(float(max(len(tokens), 1)))
    )


def largest_error(df: DataFrame, *, keys: Sequence[str], truth: str, found: str) -> DataFrame:
    """A36."""
    return df.groupBy(*keys).agg(F.max(F.abs(F.col(found) - F.col(truth))).alias("max_error"))


def centroid(df: DataFrame, *, keys: Sequence[str], position: Sequence[str], all_visible: bool) -> DataFrame:
    """A37. Mean of the visible members; with ``all_visible`` null once a carried member is hidden."""
    out = []
    for c in position:
        mean = F.avg(c)
        if all_visible:
            mean = F.when(F.count(c) == F.count(F.lit(1)), mean)
        out.append(mean.alias(c))
    return df.groupBy(*keys).agg(*out)


def agreement(df: DataFrame, *, keys: Sequence[str], a: str, b: str) -> DataFrame:
    """A38. Correlation, RMS difference and both medians; undefined below 3 rows or without spread."""
    both = df.where(F.col(a).isNotNull() & F.col(b).isNotNull())
    d = F.col(a) - F.col(b)
    spread = (F.count(F.lit(1)) >= 3) & (F.stddev_pop(a) > 0) & (F.stddev_pop(b) > 0)
    first = exact_quantiles(
        both, keys=keys, value=a, probs={"median_a": 0.5},
        aggs=[
            F.count(F.lit(1)).alias("n"), spread.alias("_defined"),
            F.when(spread, F.corr(a, b)).alias("pearson"), F.sqrt(F.avg(d * d)).alias("rms"),
        ],
    )
    second = exact_quantiles(both, keys=keys, value=b, probs={"median_b": 0.5})
    joined = first.join(second, list(keys))
    keep = {c: F.when(F.col("_defined"), F.col(c)) for c in ("pearson", "rms", "median_a", "median_b")}
    return joined.withColumns(keep).drop("_defined")


def missing_census(df: DataFrame, *, keys: Sequence[str], columns: Mapping[str, str]) -> DataFrame:
    """A39. Rows per key and input with a missing or NaN value, only where there are any."""
    counts = df.groupBy(*keys).agg(
        *[F.count_if(F.col(c).isNull() | F.isnan(F.col(c).cast("double"))).alias(f"_{n}") for n, c in columns.items()]
    )
    pairs = F.array(*[F.struct(F.lit(n).alias("input"), F.col(f"_{n}").alias("missing")) for n in columns])
    return counts.select(*keys, F.inline(pairs)).where("missing > 0")


def subject_summary(df: DataFrame, *, keys: Sequence[str], frames: str, skipped: Column, rate: str) -> DataFrame:
    """A40. Trials, skipped trials, frames and the distinct rates of each subject."""
    rates = df.select(*keys, rate).distinct().groupBy(*keys).agg(F.array_join(F.sort_array(F.collect_list(rate)), ",").alias("rates"))
    sums = df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("trials"),
        F.count_if(skipped).alias("skipped"),
        F.sum(F.when(~skipped, F.col(frames)).otherwise(0)).alias("frames"),
    )
    return sums.join(rates, list(keys))


def not_done(df: DataFrame, done: DataFrame, *, keys: Sequence[str]) -> DataFrame:
    """A40. Resume: what has no done marker yet."""
    return df.join(done.select(*keys), list(keys), "left_anti")


def inner_summary(df: DataFrame, *, keys: Sequence[str], value: str, keep: Column) -> DataFrame:
    """A41. Mean, p95 and RMS over the rows kept (valid, away from the edges)."""
    return exact_quantiles(
        df.where(keep), keys=keys, value=value, probs={"p95": 0.95},
        aggs=[F.avg(value).alias("mean"), F.sqrt(F.avg(F.col(value) * F.col(value))).alias("rms"), F.count(F.lit(1)).alias("rows")],
    )
