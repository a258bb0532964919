"""Rotation statistics: mean, dispersion, mounting and comparison of two streams."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import quat as Q
from ..session import checkpoint_dir
from .blocks import BLOCK_ROWS, attach, small
from .quantiles import exact_quantiles
from .rigid import CELLS, rotation_of, transposed
from .windows import angular_rate, sign_continuous


def join_streams(
    frames: DataFrame, large: DataFrame, site_joint: DataFrame, *, keys: Sequence[str], site: str, joint: str
) -> DataFrame:
    """J1. Frames of two streams of one take, through a site to joint table.

    Meets on key, frame and joint, so a long take is spread over its frames.
    """
    return frames.join(small(site_joint), site).join(large, [*keys, joint])


def mean_rotation(df: DataFrame, *, keys: Sequence[str], matrix: str, carry: Sequence[Column] = ()) -> DataFrame:
    """A13. Chordal mean: the mean of the matrix cells, projected onto a rotation."""
    means = df.groupBy(*keys).agg(*[F.avg(F.col(matrix)[c]).alias(c) for c in CELLS], *carry)
    extra = [c for c in means.columns if c not in (*keys, *CELLS)]
    cells = transposed(F.struct(*CELLS))
    return means.select(*keys, rotation_of(cells).alias("mean"), *extra)


def offset_angle(means: DataFrame, *, keys: Sequence[str]) -> DataFrame:
    """A13. Angle of the mean rotation itself."""
    m = F.col("mean")
    trace = m["m00"] + m["m11"] + m["m22"]
    return means.select(*keys, F.degrees(F.acos(Q.clip((trace - 1.0) / 2.0, -1.0, 1.0))).alias("offset_deg"))


def dispersion(
    df: DataFrame, *, keys: Sequence[str], frame: str, matrix: str, minimum: int = 2, rows: int = BLOCK_ROWS
) -> DataFrame:
    """A14. Median geodesic angle about the group mean, for groups of at least ``minimum`` rows."""
    carry = [F.max(frame).alias("_last"), F.count(F.lit(1)).alias("n")]
    means = mean_rotation(df, keys=keys, matrix=matrix, carry=carry).where(F.col("n") >= minimum)
    both = attach(df, means, keys=keys, frame=frame, last_frame="_last", rows=rows)
    both = both.withColumn("_angle", Q.matrix_angle_deg(F.col("mean"), F.col(matrix)))
    return exact_quantiles(both, keys=keys, value="_angle", probs={"dispersion": 0.5}, aggs=[F.count(F.lit(1)).alias("n")], sized_by=df)


def dispersion_findings(spread: DataFrame, *, tolerant: Column, fail_deg: float, warn_deg: float) -> DataFrame:
    """A14, Q5. FAIL above the tight band for strict modes, WARN above the wide one for tolerant modes."""
    severity = F.when(~tolerant & (F.col("dispersion") > fail_deg), "FAIL").when(
        tolerant & (F.col("dispersion") > warn_deg), "WARN"
    )
    return spread.withColumn("severity", severity).where(F.col("severity").isNotNull())


def mounting_rotation(
    df: DataFrame, *, keys: Sequence[str], a: str, b: str, min_rate: float, carry: Sequence[Column] = ()
) -> DataFrame:
    """A15. Constant rotation M with ``b_row = a_row M`` from the rows where ``a`` turns fast enough.

    Keys with fewer than three such rows are left out.
    """
    # A condition inside the sums, not a filter: a pushed-down filter would repeat the whole
    # derivation of the rates.
    usable = F.col("_use")
    marked = df.withColumn("_use", F.coalesce(Q.norm(F.col(a)) > min_rate, F.lit(False)) & F.col(b).isNotNull())
    sums = marked.groupBy(*keys).agg(
        *[F.sum(F.when(usable, F.col(a)[i] * F.col(b)[j])).alias(f"h{i}{j}") for i in "xyz" for j in "xyz"],
        F.count_if(usable).alias("used"),
        *carry,
    )
    extra = [c for c in sums.columns if c not in (*keys, "used") and not c.startswith("h")]
    found = sums.where(F.col("used") >= 3).withColumn(
        "_r", rotation_of([F.col(f"h{i}{j}") for i in "xyz" for j in "xyz"])
    )
    m = F.struct(*[F.col("_r")[f"m{j}{i}"].alias(f"m{i}{j}") for i in range(3) for j in range(3)])
    return found.select(*keys, m.alias("mounting"), "used", *extra)


def compare_orientation(
    df: DataFrame,
    *,
    keys: Sequence[str],
    frame: str,
    a: str,
    b: str,
    dt_s: float,
    min_rate: float,
    rows: int = BLOCK_ROWS,
) -> DataFrame:
    """A16, J19. Error of stream ``a`` against ``b`` after removing a constant mounting and world offset."""
    here = F.col(frame) >= 0
    rated = angular_rate(df, keys=keys, frame=frame, q=a, dt_s=dt_s, one_sided_ends=False, out="_ra", rows=rows)
    rated = angular_rate(rated, keys=keys, frame=frame, q=b, dt_s=dt_s, one_sided_ends=False, out="_rb", rows=rows)
    carry = [F.corr(Q.norm(F.col("_ra")), Q.norm(F.col("_rb"))).alias("_corr"), F.max(frame).alias("_last")]
    mounts = mounting_rotation(rated, keys=keys, a="_ra", b="_rb", min_rate=min_rate, carry=carry)
    mounts = Q.with_quaternion(mounts, "_m", "mounting").select(*keys, "_m", "_corr", "_last")
    both = df.where(F.col(a).isNotNull() & F.col(b).isNotNull()).select(*keys, frame, a, b)
    both = attach(both, mounts, keys=keys, frame=frame, last_frame="_last", rows=rows)
    both = both.withColumn("_p", Q.hold(Q.multiply(F.col(a), F.col("_m")), here))
    both = both.withColumn("_w", Q.hold(Q.multiply(F.col(b), Q.conjugate(F.col("_p"))), here))
    # Used three times below and two windowed passes deep: written once in the checkpoint folder.
    checkpoint_dir(df.sparkSession)
    both = both.checkpoint()
    steady = sign_continuous(both, keys=keys, frame=frame, q="_w", rows=rows)
    mean = steady.groupBy(*keys).agg(*[F.avg(F.col("_w")[c]).alias(c) for c in "wxyz"], F.max(frame).alias("_last"), F.first("_corr").alias("_corr"))
    mean = mean.select(*keys, Q.normalise(Q.quat(*[F.col(c) for c in "wxyz"])).alias("_o"), "_last", F.col("_corr").alias("rate_correlation"))
    errors = attach(both.drop("_corr"), mean, keys=keys, frame=frame, last_frame="_last", rows=rows)
    errors = errors.withColumn("_c", Q.hold(Q.multiply(F.col("_o"), F.col("_p")), here))
    errors = errors.withColumn("_error", Q.angle_deg(F.col("_c"), F.col(b)))
    out = exact_quantiles(
        errors, keys=keys, value="_error", probs={"median_deg": 0.5, "p95_deg": 0.95},
        aggs=[F.max("_error").alias("max_deg"), F.count(F.lit(1)).alias("frames"), F.first("rate_correlation").alias("rate_correlation")],
        sized_by=df,
    )
    return out


def compose_chain(
    df: DataFrame, closure: DataFrame, *, keys: Sequence[str], node: str, q: str
) -> DataFrame:
    """F14. Rotation from the root at every node: the ordered product of its ancestors' rotations.

    A node has at most as many ancestors as the tree is high, so each product list stays short.
    """
    steps = closure.select(F.col("ancestor").alias(node), F.col("node").alias("_node"), F.col("depth").alias("_up"))
    gathered = (
        df.select(*keys, node, q)
        .join(small(steps), node)
        .groupBy(*keys, F.col("_node").alias(node))
        .agg(F.array_sort(F.collect_list(F.struct((-F.col("_up")).alias("at"), F.col(q).alias("q")))).alias("_list"))
    )
    one = Q.quat(F.lit(1.0), F.lit(0.0), F.lit(0.0), F.lit(0.0))
    product = F.aggregate("_list", one, lambda acc, step: Q.multiply(acc, step["q"]))
    return gathered.select(*keys, node, product.alias(q))


def parent_relative(df: DataFrame, edges: DataFrame, *, keys: Sequence[str], node: str, q: str) -> DataFrame:
    """F18. Rotation relative to the parent node; a root keeps its own."""
    child = df.join(small(edges.select(F.col("node").alias(node), F.col("parent").alias("_parent"))), node)
    above = df.select(*keys, F.col(node).alias("_parent"), F.col(q).alias("_up"))
    joined = child.join(above, [*keys, "_parent"], "left")
    relative = Q.multiply(Q.conjugate(F.col("_up")), F.col(q))
    return joined.select(*keys, node, F.when(F.col("_up").isNull(), F.col(q)).otherwise(relative).alias(q))
