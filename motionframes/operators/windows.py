"""Neighbour, prefix and resampling operators over frames."""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import quat as Q
from .blocks import BLOCK_ROWS, attach, over_neighbours, running, running_steps
from .quantiles import exact_quantiles
from .runs import with_run_bounds

TWO_PI = 2.0 * math.pi


def flag_speed_outliers(
    df: DataFrame,
    *,
    keys: Sequence[str],
    frame: str,
    position: Sequence[str],
    dt_s: float,
    max_speed: float,
    out: str = "speed_outlier",
    rows: int = BLOCK_ROWS,
) -> DataFrame:
    """W1. Flag samples too fast against both neighbouring frames, or against the only one they have."""
    there = F.lit(True)
    for c in position:
        there = there & F.col(c).isNotNull()

    def neighbours(_, w):
        def fast(step):
            square = None
            for c in position:
                d = F.col(c) - step(F.col(c)).over(w)
                square = d * d if square is None else square + d * d
            return F.sqrt(square) / dt_s > max_speed

        return {
            "_back": fast(F.lag),
            "_ahead": fast(F.lead),
            "_hb": F.coalesce(F.lag(there).over(w), F.lit(False)),
            "_ha": F.coalesce(F.lead(there).over(w), F.lit(False)),
        }

    back, ahead = F.coalesce("_back", F.lit(False)), F.coalesce("_ahead", F.lit(False))
    verdict = F.when(F.col("_hb") & F.col("_ha"), back & ahead).otherwise(back | ahead) & there
    return (
        over_neighbours(df, keys=keys, frame=frame, before=1, after=1, stages=[neighbours], rows=rows)
        .withColumn(out, verdict)
        .drop("_back", "_ahead", "_hb", "_ha")
    )


def sign_continuous(
    df: DataFrame, *, keys: Sequence[str], frame: str, q: str, rows: int = BLOCK_ROWS
) -> DataFrame:
    """W7. Flip quaternions so that neighbours lie in one hemisphere (prefix parity of the flips).

    A dot product of exactly zero keeps the sign of the row before, however far back that is.
    """
    flip = lambda before, here: (Q.qdot(here, before) < 0).cast("bigint")
    turned = running_steps(df, keys=keys, frame=frame, value=F.col(q), step=flip, out="_flip", total="_n", rows=rows)
    sign = F.when(F.col("_n") % 2 == 1, F.lit(-1.0)).otherwise(F.lit(1.0))
    return turned.withColumn(q, Q.scale_quat(F.col(q), sign)).drop("_flip", "_n")


def _turns(step: Column) -> Column:
    """Whole turns to add after a step; a step of exactly half a turn is left as it is."""
    up = -F.ceil((step - math.pi) / TWO_PI)
    down = -F.floor((step + math.pi) / TWO_PI)
    return F.when(F.abs(step) < math.pi, F.lit(0).cast("bigint")).when(step > 0, up).otherwise(down)


def unwrap(
    df: DataFrame,
    *,
    keys: Sequence[str],
    frame: str,
    angle: str,
    out: str = "unwrapped",
    rows: int = BLOCK_ROWS,
) -> DataFrame:
    """W8. Continuous angle and the wrap counter: ``angle = unwrapped + 2 pi * counter``.

    A step goes from one row to the next, also over absent frames.
    """
    turn = lambda before, here: _turns(here - before)
    summed = running_steps(df, keys=keys, frame=frame, value=F.col(angle), step=turn, out="_turn", total="_k", rows=rows)
    return (
        summed.withColumn(out, F.col(angle) + F.col("_k") * TWO_PI)
        .withColumn("wrap_counter", -F.col("_k"))
        .withColumn("transition", F.coalesce(F.col("_turn") != 0, F.lit(False)))
        .drop("_turn", "_k")
    )


def differences(
    df: DataFrame, *, keys: Sequence[str], frame: str, value: str, dt_s: float, rows: int = BLOCK_ROWS
) -> DataFrame:
    """W9. Centred difference (one-sided at the ends and beside absent frames), backward difference, and the repeated gradient."""
    x = F.col(value)

    def gradient(c):
        def build(w):
            back, ahead = F.lag(c).over(w), F.lead(c).over(w)
            inner = (ahead - back) / (2.0 * dt_s)
            first = F.lag(F.lit(1)).over(w).isNull()
            last = F.lead(F.lit(1)).over(w).isNull()
            return F.when(first, (ahead - c) / dt_s).when(last, (c - back) / dt_s).otherwise(inner)

        return build

    stages = [
        lambda _, w: {"centred": gradient(x)(w), "backward": (x - F.lag(x).over(w)) / dt_s},
        lambda _, w: {"second": gradient(F.col("centred"))(w)},
    ]
    return over_neighbours(df, keys=keys, frame=frame, before=2, after=2, stages=stages, rows=rows)


def angular_rate(
    df: DataFrame,
    *,
    keys: Sequence[str],
    frame: str,
    q: str,
    dt_s: float,
    one_sided_ends: bool,
    out: str = "rate",
    rows: int = BLOCK_ROWS,
) -> DataFrame:
    """W10. Body rate by the log map over two frames; the ends, also beside absent frames, are null or one-sided."""

    def neighbours(_, w):
        return {"_qb": F.lag(q).over(w), "_qa": F.lead(q).over(w)}

    back, ahead, here = F.col("_qb"), F.col("_qa"), F.col(q)
    both = back.isNotNull() & ahead.isNotNull()
    earlier, later, per = back, ahead, F.lit(1.0 / dt_s)
    present = both
    if one_sided_ends:
        present = back.isNotNull() | ahead.isNotNull()
        earlier, later = F.coalesce(back, here), F.coalesce(ahead, here)
        per = F.when(both, 1.0 / dt_s).otherwise(2.0 / dt_s)
    return (
        over_neighbours(df, keys=keys, frame=frame, before=1, after=1, stages=[neighbours], rows=rows)
        .withColumns({"_qb": F.when(present, earlier), "_qa": F.when(present, later), "_per": per})
        .withColumn("_rel", Q.hold(Q.multiply(Q.conjugate(F.col("_qb")), F.col("_qa")), present))
        .withColumn("_rel", Q.hold(Q.shorter_arc(F.col("_rel")), present))
        .withColumn("_log", Q.hold(Q.log_unit(F.col("_rel")), present))
        .withColumn(out, Q.hold(Q.scale(F.col("_log"), F.col("_per")), present))
        .drop("_qb", "_qa", "_rel", "_log", "_per")
    )


def step_angle(
    df: DataFrame,
    *,
    keys: Sequence[str],
    frame: str,
    q: str,
    limit_deg: float,
    pad: int,
    rows: int = BLOCK_ROWS,
) -> DataFrame:
    """W11. Angle to the frame before (0 where there is none), and whether a step above the limit is near."""
    stages = [
        lambda _, w: {"step_deg": F.coalesce(Q.angle_deg(F.lag(q).over(w), F.col(q)), F.lit(0.0))},
        lambda w, _: {"glitch": F.max(F.col("step_deg") > limit_deg).over(w.rangeBetween(-pad, pad))},
    ]
    return over_neighbours(
        df, keys=keys, frame=frame, before=pad + 1, after=pad, stages=stages, rows=rows
    )


def integrate(
    df: DataFrame, *, keys: Sequence[str], frame: str, rate: Column, out: str, rows: int = BLOCK_ROWS
) -> DataFrame:
    """W12. Running sum from the first frame."""
    return running(df, keys=keys, frame=frame, scans={out: ("sum", rate)}, rows=rows)


def polynomial_weights(window: int, degree: int, derivative: int, dt_s: float) -> list[list[float]]:
    """Row p: weights over the window that give the fitted polynomial's derivative at position p."""
    at = np.arange(window, dtype=float)
    rows = []
    for p in range(window):
        basis = np.vander(at - p, degree + 1, increasing=True)
        fit = np.linalg.pinv(basis)
        rows.append((fit[derivative] * math.factorial(derivative) / dt_s**derivative).tolist())
    return rows


def polynomial_smooth(
    df: DataFrame,
    *,
    keys: Sequence[str],
    frame: str,
    value: str,
    window: int,
    degree: int,
    derivative: int,
    dt_s: float,
    out: str = "smooth",
    rows: int = BLOCK_ROWS,
) -> DataFrame:
    """W19. Local polynomial fit over an odd window inside each run of present values.

    Near a run's ends the first or last whole window is evaluated off its centre; runs shorter
    than the window give null.
    """
    half, span = window // 2, window - 1
    bounded = with_run_bounds(df, keys=keys, frame=frame, state=F.col(value).isNotNull(), rows=rows)
    first = F.greatest(F.col("run_start"), F.least(F.col(frame) - half, F.col("run_stop") - window))
    bounded = bounded.withColumn("_p", (F.col(frame) - first).cast("int"))

    def fitted(_, w):
        around = {k: (F.lag if k < 0 else F.lead)(value, abs(k)).over(w) for k in range(-span, span + 1) if k}
        around[0] = F.col(value)
        result = None
        for p, weights in enumerate(polynomial_weights(window, degree, derivative, dt_s)):
            total = None
            for j, weight in enumerate(weights):
                term = around[j - p] * F.lit(weight)
                total = term if total is None else total + term
            hit = F.col("_p") == p
            result = F.when(hit, total) if result is None else result.when(hit, total)
        long_enough = F.col(value).isNotNull() & (F.col("run_stop") - F.col("run_start") >= window)
        return {out: F.when(long_enough, result)}

    return over_neighbours(
        bounded, keys=keys, frame=frame, before=span, after=span, stages=[fitted], rows=rows
    ).drop("_p", "run_start", "run_stop")


def resampled_length(frames: Column, src_hz: float, dst_hz: float) -> Column:
    """W20. Rows on the target grid inside the recording, guarded against a float underflow."""
    if float(src_hz) == float(dst_hz):
        return frames.cast("bigint")
    return F.floor((frames - 1) / F.lit(float(src_hz)) * F.lit(float(dst_hz)) + F.lit(1e-9)) + 1


def resample(
    df: DataFrame,
    *,
    keys: Sequence[str],
    frame: str,
    src_hz: float,
    dst_hz: float,
    vectors: Sequence[str] = (),
    rotations: Sequence[str] = (),
    rows: int = BLOCK_ROWS,
) -> DataFrame:
    """W20. Uniform target grid: linear for numbers, spherical for rotations.

    Each source frame and its successor emit the target rows that fall between them, so the whole
    step is one windowed pass without a join; equal rates return the input. Nothing is made up between a
    frame and an absent one.
    """
    names = [*vectors, *rotations]
    if float(src_hz) == float(dst_hz):
        return df.select(*keys, frame, *names)

    def pair(_, w):
        return {f"_n_{c}": F.lead(c).over(w) for c in names} | {"_ends": F.lead(frame).over(w).isNull()}

    paired = over_neighbours(
        df.select(*keys, frame, *names), keys=keys, frame=frame, before=0, after=1, stages=[pair], rows=rows
    )
    ratio, guard = F.lit(float(dst_hz) / float(src_hz)), F.lit(1e-9)
    f = F.col(frame)
    # Target row g sits at source position g / ratio; source frame f owns positions [f, f + 1).
    lowest = F.ceil(f * ratio - guard)
    highest = F.when(F.col("_ends"), F.floor(f * ratio + guard)).otherwise(F.ceil((f + 1) * ratio - guard) - 1)
    grid = paired.where(highest >= lowest).withColumn("_g", F.explode(F.sequence(lowest, highest)))
    t = F.greatest(F.lit(0.0), F.col("_g") / ratio - f)
    grid = grid.withColumn("_t", F.when(F.col("_ends"), F.lit(0.0)).otherwise(t))
    out = {c: F.when(F.col("_ends"), F.col(c)).otherwise(F.col(c) + (F.col(f"_n_{c}") - F.col(c)) * F.col("_t")) for c in vectors}
    if rotations:
        grid = grid.withColumns({f"_n_{c}": F.coalesce(f"_n_{c}", c) for c in rotations})
        grid = Q.with_slerp(grid, {f"_s_{c}": (c, f"_n_{c}") for c in rotations}, "_t")
        out |= {c: F.col(f"_s_{c}") for c in rotations}
    return grid.select(*keys, F.col("_g").alias(frame), *[v.alias(c) for c, v in out.items()])


def thin(df: DataFrame, *, keys: Sequence[str], frame: str, about: int) -> DataFrame:
    """W21. Every k-th frame so that about ``about`` are left (k at least 1)."""
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"), F.max(frame).alias("_last"))
    joined = attach(df, counts, keys=keys, frame=frame, last_frame="_last")
    step = F.greatest(F.lit(1).cast("bigint"), F.rint(F.col("_n") / about).cast("bigint"))
    return joined.withColumn("step", step).where(F.col(frame) % F.col("step") == 0).drop("_n")


def evenly_spaced(df: DataFrame, *, keys: Sequence[str], frame: str, count: int) -> DataFrame:
    """W21. The distinct frames at ``count`` evenly spaced positions from the first to the last."""
    lasts = df.groupBy(*keys).agg(F.max(frame).alias("_l"))
    steps = F.sequence(F.lit(0), F.lit(count - 1))
    at = F.transform(steps, lambda i: F.floor(i * F.col("_l") / F.lit(max(count - 1, 1))).cast("bigint"))
    wanted = lasts.select(*keys, F.explode(F.array_distinct(at)).alias(frame))
    return df.join(wanted, [*keys, frame], "left_semi")


def lowest_share(
    df: DataFrame, *, keys: Sequence[str], frame: str, value: str, share: float, out: str = "static"
) -> DataFrame:
    """W22. Mark the rows strictly below the key's quantile of ``value``."""
    cut = exact_quantiles(df, keys=keys, value=value, probs={"_cut": share}, aggs=[F.max(frame).alias("_last")])
    joined = attach(df, cut, keys=keys, frame=frame, last_frame="_last")
    return joined.withColumn(out, F.col(value) < F.col("_cut")).drop("_cut")


def first_per_group(df: DataFrame, *, group: Sequence[str], order: Sequence[str], cap: int) -> DataFrame:
    """W23. The first ``cap`` (at least one) rows of each group in order.

    A partial top-``cap`` on hash buckets comes first, so no task ranks a whole group.
    """
    n = max(int(cap), 1)
    salted = df.withColumn("_salt", F.pmod(F.xxhash64(*order), F.lit(256)))
    partial = Window.partitionBy(*group, "_salt").orderBy(*order)
    final = Window.partitionBy(*group).orderBy(*order)
    return (
        salted.withColumn("_rn", F.row_number().over(partial))
        .where(F.col("_rn") <= n)
        .withColumn("_rn", F.row_number().over(final))
        .where(F.col("_rn") <= n)
        .drop("_rn", "_salt")
    )


def nested_caps(
    members: DataFrame, *, group: str, member: str, max_groups: int, max_members: int
) -> DataFrame:
    """W27. The first groups by name, then the first members of each by name."""
    groups = members.select(group).distinct().orderBy(group).limit(max_groups)
    kept = members.select(group, member).distinct().join(groups, group, "left_semi")
    return first_per_group(kept, group=[group], order=[member], cap=max_members)


def missing_names(wanted: DataFrame, kept: DataFrame, everything: DataFrame, *, on: Sequence[str]) -> DataFrame:
    """W27. Names asked for that do not exist (``unknown``) or fell to the caps (``dropped``)."""
    asked = wanted.select(*on).distinct()
    unknown = asked.join(everything.select(*on), list(on), "left_anti").withColumn("problem", F.lit("unknown"))
    known = asked.join(everything.select(*on), list(on), "left_semi")
    dropped = known.join(kept.select(*on), list(on), "left_anti").withColumn("problem", F.lit("dropped"))
    return unknown.unionByName(dropped)


def remove_linear_drift(
    df: DataFrame, *, keys: Sequence[str], frame: str, time: str, value: str, slopes: DataFrame, out: str
) -> DataFrame:
    """W26. ``value - slope * (time - first time)``; ``slopes`` holds the slope of each key."""
    firsts = df.groupBy(*keys).agg(F.min(time).alias("_t0"), F.max(frame).alias("_last"))
    per_key = firsts.join(slopes.select(*keys, "slope"), list(keys))
    joined = attach(df, per_key, keys=keys, frame=frame, last_frame="_last")
    return joined.withColumn(out, F.col(value) - F.col("slope") * (F.col(time) - F.col("_t0"))).drop("_t0")


def centre_on_median(
    df: DataFrame, *, keys: Sequence[str], frame: str, value: str, out: str
) -> DataFrame:
    """W26. The earlier form: minus the key's median."""
    mid = exact_quantiles(df, keys=keys, value=value, probs={"_m": 0.5}, aggs=[F.max(frame).alias("_last")])
    joined = attach(df, mid, keys=keys, frame=frame, last_frame="_last")
    return joined.withColumn(out, F.col(value) - F.col("_m")).drop("_m")
