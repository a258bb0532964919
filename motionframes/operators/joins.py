"""As-of, interval, reconciliation and lookup joins."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .blocks import BLOCK_ROWS, HOT_ROWS, block_of, dense_frames, running, small
from .quantiles import exact_quantiles


def nearest_in_time(
    left: DataFrame,
    right: DataFrame,
    *,
    keys: Sequence[str],
    time: str,
    id_: str,
    values: Sequence[str],
    tolerance: DataFrame,
    rows: int = BLOCK_ROWS,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """J2. Each left row with the right row nearest in time (the earlier on a tie), or nulls.

    ``time`` is an integer clock (a left row without it has nulls); ``id_`` orders rows of one side at one time. ``tolerance`` has one
    ``tolerance`` per key. Both sides are laid on one time line, numbered along it and read backwards
    and forwards in blocks of ``rows`` rows, so a key is split wherever its rows are dense.
    """
    right_row = F.struct(F.col(time).alias("at"), *values)
    sides = left.select(*keys, time, id_, F.lit(1).alias("_side"), F.lit(None).cast(
        right.select(right_row.alias("r")).schema["r"].dataType).alias("_r"))
    sides = sides.unionByName(right.where(F.col(time).isNotNull()).select(*keys, time, id_, F.lit(0).alias("_side"), right_row.alias("_r")))
    sides = dense_frames(sides, keys=keys, order=[time, "_side", id_], frame="_at", hot_rows=hot_rows)
    scans = {"_before": ("last", F.col("_r")), "_after": ("next", F.col("_r"))}
    scanned = running(sides, keys=keys, frame="_at", rows=rows, scans=scans).where("_side = 1")
    back = F.col(time) - F.col("_before.at")
    ahead = F.col("_after.at") - F.col(time)
    nearest = F.when(F.col("_after").isNull() | (back <= ahead), F.col("_before")).otherwise(F.col("_after"))
    picked = scanned.withColumn("_pick", nearest).join(tolerance, list(keys), "left")
    within = F.abs(F.col(time) - F.col("_pick.at")) <= F.col("tolerance")
    return picked.select(
        *keys, time, id_, *[F.when(within, F.col("_pick")[v]).alias(v) for v in ("at", *values)]
    )


def half_median_step(
    df: DataFrame, *, keys: Sequence[str], time: str, id_: str, rows: int = BLOCK_ROWS, hot_rows: int = HOT_ROWS
) -> DataFrame:
    """J2. Half of the median time step of each key, rows numbered by time and ``id_``."""
    line = dense_frames(df, keys=keys, order=[time, id_], frame="_at", hot_rows=hot_rows)
    stepped = running(line, keys=keys, frame="_at", rows=rows, scans={"_b": ("previous", F.col(time))})
    stepped = stepped.withColumn("_step", F.col(time) - F.col("_b"))
    out = exact_quantiles(stepped, keys=keys, value="_step", probs={"_m": 0.5}, sized_by=df)
    return out.select(*keys, (F.col("_m") / 2).alias("tolerance"))


def misaligned(
    expected: DataFrame, actual: DataFrame, *, keys: Sequence[str], time: str, rate_hz: float, tolerance: float
) -> DataFrame:
    """J3. Rows whose nearest grid row is missing or disagrees in time.

    ``actual`` is indexed by ``frame`` at ``rate_hz``.
    """
    at = expected.withColumn("frame", F.rint(F.col(time) * rate_hz).cast("bigint"))
    grid = actual.select(*keys, "frame", F.col(time).alias("_grid"))
    off = F.abs(F.col(time) - F.col("_grid"))
    joined = at.join(grid, [*keys, "frame"], "left").withColumn("off_s", off)
    return joined.where(F.col("_grid").isNull() | (off > tolerance)).drop("_grid")


def missing_and_orphans(index: DataFrame, storage: DataFrame, *, on: Sequence[str]) -> DataFrame:
    """J4, J5. What the index names and storage lacks, and the reverse."""
    missing = index.select(*on).distinct().join(storage, list(on), "left_anti").withColumn("problem", F.lit("missing"))
    orphan = storage.select(*on).distinct().join(index, list(on), "left_anti").withColumn("problem", F.lit("orphan"))
    return missing.unionByName(orphan)


def within_intervals(
    samples: DataFrame,
    intervals: DataFrame,
    *,
    keys: Sequence[str],
    time: str,
    start: str,
    stop: str,
    rows: int = 1024,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """J6. Samples with every half-open interval ``[start, stop)`` that holds them.

    Samples, starts and stops lie on one line per key and are numbered along it, starts and stops
    before samples of their time. An interval then holds the samples between its two numbers. Both
    sides meet on stretches of ``rows`` numbers, so the work follows the rows on the line however
    dense they are: an interval is copied once per stretch it covers and compared with samples it
    doesn't hold in its first and last stretch only. Rows without a key or time and intervals that
    don't advance hold nothing; repeated intervals count each. Interval columns must be comparable.
    """
    keys = list(keys)
    spans = intervals.where(F.col(start) < F.col(stop)).groupBy(*intervals.columns).agg(F.count(F.lit(1)).alias("_copies"))
    span = F.struct(*[c for c in spans.columns if c not in keys]).alias("_span")
    sample = F.struct(F.lit(1).alias("_one"), *[c for c in samples.columns if c not in keys]).alias("_sample")
    edges = spans.select(*keys, span, F.explode(F.array(start, stop)).alias("_t"), F.lit(0).alias("_kind"))
    points = samples.select(*keys, sample, F.col(time).alias("_t"), F.lit(1).alias("_kind"))
    line = edges.unionByName(points, allowMissingColumns=True).dropna(subset=[*keys, "_t"])
    # One column for both, so that the two readers of the line ask for the same and share its shuffle.
    line = line.select(*keys, "_t", "_kind", F.array(F.struct("_sample", "_span")).alias("_row"))
    line = dense_frames(line, keys=keys, order=["_t", "_kind"], frame="_at", hot_rows=hot_rows)
    ends = line.where("_kind = 0").select(*keys, F.col("_row")[0]["_span"].alias("_span"), "_at").groupBy(*keys, "_span").agg(F.min("_at").alias("_from"), F.max("_at").alias("_to"))
    stretches = F.explode(F.sequence(block_of("_from", rows), block_of("_to", rows))).alias("_blk")
    held = (
        line.where("_kind = 1").withColumn("_blk", block_of("_at", rows)).select(*keys, "_blk", "_at", F.col("_row")[0]["_sample"].alias("_sample"))
        .join(ends.select("*", stretches), [*keys, "_blk"])
        .where("_at > _from and _at < _to")
        .withColumn("_copy", F.explode(F.expr("sequence(1L, _span._copies)")))
    )
    return held.select(*keys, "_sample.*", "_span.*").drop("_one", "_copies")


def reconcile(listed: DataFrame, destination: DataFrame, origin: DataFrame, *, name: str, digest: str, verify_only: bool) -> DataFrame:
    """J10. What staging would find for every listed name: present, conflict, missing (when only
    verifying), copied, unavailable or corrupt."""
    there = destination.select(name, F.col(digest).alias("_there"))
    have = origin.select(name, F.col(digest).alias("_from"))
    joined = listed.join(there, name, "left").join(have, name, "left")
    status = F.when(F.col("_there") == F.col(digest), "present").when(F.col("_there").isNotNull(), "conflict")
    if verify_only:
        status = status.otherwise("missing")
    else:
        status = (
            status.when(F.col("_from").isNull(), "unavailable").when(F.col("_from") == F.col(digest), "copied").otherwise("corrupt")
        )
    return joined.select(name, status.alias("status"))


def staging_exit(statuses: DataFrame, *, verify_only: bool, refused: int = 3, incomplete: int = 1) -> DataFrame:
    """J10. The exit code and counts. A conflict refuses the whole run unless it only verifies."""
    count = lambda s: F.count_if(F.col("status") == s)
    sums = statuses.agg(*[count(s).alias(s) for s in ("present", "copied", "missing", "conflict", "unavailable", "corrupt")])
    open_ = sum(F.col(s) for s in ("missing", "conflict", "unavailable", "corrupt"))
    code = F.when(open_ > 0, incomplete).otherwise(0)
    if not verify_only:
        code = F.when(F.col("conflict") > 0, refused).otherwise(code)
    return sums.withColumn("exit_code", code)


def resolve(df: DataFrame, profiles: DataFrame, *, on: str, status: str) -> tuple[DataFrame, DataFrame]:
    """J14. Rows with their profile, and the rejected keys: unknown, or a profile still pending."""
    joined = df.join(small(profiles.withColumn("_known", F.lit(True))), on, "left")
    pending = F.col(status) == "pending"
    good = joined.where(F.col("_known") & ~pending).drop("_known")
    reason = F.when(F.col("_known").isNull(), "unknown").when(pending, "pending")
    bad = joined.withColumn("reason", reason).where(F.col("reason").isNotNull()).select(on, "reason").distinct()
    return good, bad


def group_key(study: Column, subject: Column) -> Column:
    """J15. Study without its variant suffix, and the subject."""
    return F.concat_ws("/", F.regexp_replace(study, r"[_-](no|with)[_-]?[A-Za-z]+$", ""), subject)


def leaking_groups(df: DataFrame, *, key: str, split: str) -> DataFrame:
    """J15. Groups that occur in more than one split."""
    return df.groupBy(key).agg(F.count_distinct(split).alias("splits")).where("splits > 1")


def source_references(leaves: DataFrame, *, take: str) -> DataFrame:
    """J16. Path and digest leaves with a common parent, once per (path, sha): their fields and takes.

    ``leaves`` has one row per JSON leaf (take, path, value).
    """
    parent = F.regexp_replace("path", r"\.?[^.]*$", "")
    leaf = F.element_at(F.split("path", r"\."), -1)
    pairs = (
        leaves.where(leaf.isin("path", "sha256"))
        .groupBy(take, parent.alias("field"))
        .agg(
            F.max(F.when(leaf == "path", F.col("value"))).alias("source_path"),
            F.max(F.when(leaf == "sha256", F.col("value"))).alias("sha256"),
        )
        .where(F.col("source_path").isNotNull())
    )
    fields = F.array_join(F.sort_array(F.collect_set("field")), ",")
    return pairs.groupBy("source_path", "sha256").agg(fields.alias("fields"), F.count_distinct(take).alias("takes"))


def files_by_stage(files: DataFrame, selection: DataFrame, *, owner: Column) -> DataFrame:
    """J17. The stages that read each file: those that selected its owner, and all for a file without one.

    Each file keeps one row. The stages of all owners are the row that files without an owner meet.
    """
    named = F.array_join(F.sort_array(F.collect_set("stage")), ",").alias("stages")
    per_owner = selection.where("owner is not null").groupBy("owner").agg(named)
    everyone = selection.agg(named).select(F.lit(None).cast("string").alias("owner"), "stages")
    stages = small(per_owner.unionByName(everyone).withColumnRenamed("owner", "_of"))
    owned = files.withColumn("_owner", owner)
    return owned.join(stages, F.col("_owner").eqNullSafe(F.col("_of"))).drop("_owner", "_of")


def correspondence(declared: DataFrame, targets: Sequence[tuple[str, str, str]], *, skeleton: str) -> DataFrame:
    """J20. For every skeleton and target joint: measured when its own joint is declared, derived when
    its fallback is, else absent.

    ``targets`` (target, joint, fallback) is a declaration of the caller; each skeleton appears once per target.
    """
    cells = [F.struct(*[F.lit(v).alias(n) for n, v in zip(("target", "joint", "fallback"), t)]) for t in targets]
    wanted = declared.select(skeleton).distinct().select(skeleton, F.inline(F.array(*cells)))
    own = declared.select(skeleton, F.col("joint"), F.lit(True).alias("_own")).distinct()
    fall = declared.select(skeleton, F.col("joint").alias("fallback"), F.lit(True).alias("_fall")).distinct()
    joined = wanted.join(own, [skeleton, "joint"], "left").join(fall, [skeleton, "fallback"], "left")
    provenance = F.when(F.col("_own"), "measured").when(F.col("_fall"), "derived").otherwise("absent")
    return joined.select(skeleton, "target", provenance.alias("provenance"))


def restrict_to_driven(table: DataFrame, driven: DataFrame, *, body: str, provenance: str) -> DataFrame:
    """P12. Rows whose driving body is not instrumented become absent."""
    joined = table.join(small(driven.select(F.col("body").alias(body), F.lit(True).alias("_d")).distinct()), body, "left")
    kept = F.when(F.col("_d"), F.col(provenance)).otherwise(F.lit("absent"))
    return joined.withColumn(provenance, kept).drop("_d")
