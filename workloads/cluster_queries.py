"""Marker clusters and two-stream rotation statistics."""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import functions as F

from motionframes.functions import quat as Q
from motionframes.operators import rigid, rotations, stats

from .base import MARKERS, POINTS, SITES, STREAMS, large_frames, long, points, query, r6, site_joint, small_frames
from .function_queries import conj, mat, mul, q_

POS = ["x", "y", "z"]
CLEAN = f"{POINTS}, c AS (SELECT take, frame, marker, vec_id, NULLIF(x, 0) AS x, NULLIF(y, 0) AS y, NULLIF(z, 0) AS z FROM p)"
PAIRS = """pr AS (SELECT a.take, a.frame, a.marker AS a, b.marker AS b, sqrt((a.x-b.x)*(a.x-b.x) + (a.y-b.y)*(a.y-b.y) + (a.z-b.z)*(a.z-b.z)) AS d
  FROM c a JOIN c b ON a.take = b.take AND a.frame = b.frame AND a.marker < b.marker)"""
WHOLE = "w AS (SELECT take, frame FROM c GROUP BY take, frame HAVING count(x) = 4)"
REFERENCE = f"{CLEAN}, {PAIRS}, {WHOLE}, ref AS (SELECT take, a, b, quantile_cont(d, 0.5) AS r FROM pr JOIN w USING (take, frame) GROUP BY take, a, b)"


def cleaned(spark, folder):
    return rigid.without_sentinel(points(spark, folder), position=POS)


def wide(spark, folder):
    return rigid.wide_markers(
        cleaned(spark, folder), keys=["take", "frame"], marker="marker", markers=MARKERS, position=POS
    )


@query(
    "p1_sentinel",
    f"WITH {POINTS} SELECT take, frame, marker, x = 0 AND y = 0 AND z = 0 AS sentinel, CASE WHEN NOT (x = 0 AND y = 0 AND z = 0) THEN round(x, 6) + 0.0 END AS x FROM p",
)
def p1_sentinel(spark, folder):
    return cleaned(spark, folder).select("take", "frame", "marker", "sentinel", r6("x").alias("x"))


@query("j13_pair_distances", f"WITH {CLEAN}, {PAIRS} SELECT take, frame, a, b, round(d, 6) + 0.0 AS distance FROM pr")
def j13_pair_distances(spark, folder):
    return rigid.pair_distances(wide(spark, folder), keys=["take", "frame"], markers=MARKERS).withColumn(
        "distance", r6("distance")
    )


@query("a9_reference_distances", f"WITH {REFERENCE} SELECT take, a, b, round(r, 6) + 0.0 AS reference FROM ref")
def a9_reference_distances(spark, folder):
    return rigid.reference_distances(wide(spark, folder), keys=["take"], markers=MARKERS).withColumn(
        "reference", r6("reference")
    )


@query(
    "a10_rigid_violations",
    f"""WITH {REFERENCE}, both_ways AS (SELECT take, frame, a AS m, abs(d - r) AS dev FROM pr JOIN ref USING (take, a, b)
      UNION ALL SELECT take, frame, b, abs(d - r) FROM pr JOIN ref USING (take, a, b))
    SELECT take, frame, m AS marker, count(dev) > 0 AND count(*) FILTER (dev > 0.05) * 2 > count(dev) AS rigid_violation FROM both_ways GROUP BY ALL""",
)
def a10_rigid_violations(spark, folder):
    w = wide(spark, folder)
    ref = rigid.reference_distances(w, keys=["take"], markers=MARKERS)
    return rigid.flag_rigid(w, ref, keys=["take"], frame="frame", markers=MARKERS, tolerance=0.05)


@query(
    "a20_segment_lengths",
    f"WITH {CLEAN}, {PAIRS} SELECT take, a, b, round(quantile_cont(d, 0.5), 6) + 0.0 AS length FROM pr WHERE (a, b) IN (('m0', 'm1'), ('m1', 'm2')) GROUP BY ALL",
)
def a20_segment_lengths(spark, folder):
    out = rigid.segment_lengths(wide(spark, folder), keys=["take"], pairs=[("m0", "m1"), ("m1", "m2")])
    return out.withColumn("length", r6("length"))


EDGES = (0.1, 0.15, 0.2, 0.25, 0.3, 0.35)
EDGE_ROWS = ", ".join(f"({i + 1}, {e})" for i, e in enumerate(EDGES))


@query(
    "a22_edge_deviation",
    f"""WITH {CLEAN}, {PAIRS}, l AS (SELECT take, a, b, quantile_cont(d, 0.5) AS d FROM pr GROUP BY ALL),
    k AS (SELECT take, d, row_number() OVER (PARTITION BY take ORDER BY d) AS n FROM l), e(n, e) AS (VALUES {EDGE_ROWS})
    SELECT take, round(max(abs(d - e)), 6) + 0.0 AS deviation, max(abs(d - e)) <= 0.1 AS within FROM k JOIN e USING (n) GROUP BY take""",
)
def a22_edge_deviation(spark, folder):
    lengths = rigid.segment_lengths(wide(spark, folder), keys=["take"], pairs=list(combinations(MARKERS, 2)))
    out = rigid.edge_deviation(lengths, keys=["take"], reference=EDGES, tolerance=0.1)
    return out.withColumn("deviation", r6("deviation"))


@query(
    "a37_visible_centroid",
    f"""WITH {CLEAN} SELECT take, frame, round(avg(x), 6) + 0.0 AS x, round(avg(y), 6) + 0.0 AS y, round(avg(z), 6) + 0.0 AS z,
    CASE WHEN count(x) = count(*) THEN round(avg(x), 6) + 0.0 END AS strict_x FROM c GROUP BY take, frame""",
)
def a37_visible_centroid(spark, folder):
    c = cleaned(spark, folder)
    loose = stats.centroid(c, keys=["take", "frame"], position=POS, all_visible=False)
    strict = stats.centroid(c, keys=["take", "frame"], position=["x"], all_visible=True)
    joined = loose.join(strict.withColumnRenamed("x", "strict_x"), ["take", "frame"])
    return joined.select("take", "frame", *[r6(a).alias(a) for a in (*POS, "strict_x")])


STEPS = """n AS (SELECT *, lag(x) OVER o AS bx, lag(y) OVER o AS b_y, lag(z) OVER o AS bz, lead(x) OVER o AS ax, lead(y) OVER o AS ay, lead(z) OVER o AS az
  FROM c WINDOW o AS (PARTITION BY take, marker ORDER BY frame)),
sp AS (SELECT *, sqrt((x-bx)*(x-bx) + (y-b_y)*(y-b_y) + (z-bz)*(z-bz)) > 0.3 AS back, sqrt((x-ax)*(x-ax) + (y-ay)*(y-ay) + (z-az)*(z-az)) > 0.3 AS ahead FROM n),
fl AS (SELECT *, x IS NOT NULL AND CASE WHEN bx IS NOT NULL AND ax IS NOT NULL THEN coalesce(back, false) AND coalesce(ahead, false)
  ELSE coalesce(back, false) OR coalesce(ahead, false) END AS fast FROM sp)"""
CONDITION = f"""{CLEAN.replace('c AS (', 'c AS (')}, {STEPS},
c2 AS (SELECT take, frame, marker, CASE WHEN NOT fast THEN x END AS x, CASE WHEN NOT fast THEN y END AS y, CASE WHEN NOT fast THEN z END AS z FROM fl),
{PAIRS.replace('FROM c a JOIN c b', 'FROM c2 a JOIN c2 b')}, {WHOLE.replace('FROM c ', 'FROM c2 ')},
ref AS (SELECT take, a, b, quantile_cont(d, 0.5) AS r FROM pr JOIN w USING (take, frame) GROUP BY take, a, b),
bw AS (SELECT take, frame, a AS m, abs(d - r) AS dev FROM pr JOIN ref USING (take, a, b) UNION ALL SELECT take, frame, b, abs(d - r) FROM pr JOIN ref USING (take, a, b)),
rv AS (SELECT take, frame, m AS marker, count(dev) > 0 AND count(*) FILTER (dev > 0.1) * 2 > count(dev) AS bad FROM bw GROUP BY ALL)"""


@query(
    "q14_condition_cluster",
    f"""WITH {CONDITION} SELECT take, frame, marker, fl.x IS NULL AS sentinel, fast AS speed_outlier, coalesce(bad, false) AS rigid_violation,
    CASE WHEN NOT fast AND NOT coalesce(bad, false) THEN round(fl.x, 6) + 0.0 END AS x FROM fl LEFT JOIN rv USING (take, frame, marker)""",
)
def q14_condition_cluster(spark, folder):
    out = rigid.condition_cluster(
        points(spark, folder), keys=["take"], frame="frame", marker="marker", markers=MARKERS, position=POS,
        dt_s=1.0, max_speed=0.3, tolerance=0.1,
    )
    return out.select("take", "frame", "marker", "sentinel", "speed_outlier", "rigid_violation", r6("x").alias("x"))


@query("a11_mean_shape")
def a11_mean_shape(spark, folder):
    shape = rigid.mean_shape(wide(spark, folder), keys=["take"], frame="frame", markers=MARKERS)
    return shape.select("take", *[r6(F.col(m)[a]).alias(f"{m}_{a}") for m in MARKERS for a in "xyz"])


@query("a12_rigid_poses")
def a12_rigid_poses(spark, folder):
    w = wide(spark, folder)
    shape = rigid.mean_shape(w, keys=["take"], frame="frame", markers=MARKERS)
    poses = rigid.solve_poses(w, shape, keys=["take"], frame="frame", markers=MARKERS)
    q = F.col("q")
    return Q.with_quaternion(poses, "q", "rotation").select(
        "take", "frame", *[r6(q[c], 5).alias(f"q{c}") for c in "wxyz"], r6("residual").alias("residual"), "n_visible"
    )


@query("q15_reconstruct_markers")
def q15_reconstruct_markers(spark, folder):
    w = wide(spark, folder)
    shape = rigid.mean_shape(w, keys=["take"], frame="frame", markers=MARKERS)
    poses = rigid.solve_poses(w, shape, keys=["take"], frame="frame", markers=MARKERS)
    out = rigid.reconstruct(w, shape, poses, keys=["take"], frame="frame", markers=MARKERS, max_residual=0.1)
    return out.select(
        "take", "frame", "marker", "reconstructed", "high_residual", *[r6(F.col("position")[a]).alias(a) for a in "xyz"]
    )


@query(
    "j18_nearest_label",
    f"""WITH {POINTS}, v AS (SELECT DISTINCT marker AS label, x, y, z FROM p WHERE vec_id % 5 = 0),
    d AS (SELECT p.vec_id, v.label, sqrt((p.x-v.x)*(p.x-v.x) + (p.y-v.y)*(p.y-v.y) + (p.z-v.z)*(p.z-v.z)) AS d FROM p, v)
    SELECT vec_id, label, round(d, 6) + 0.0 AS distance FROM (SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY d, label) AS k FROM d) WHERE k = 1""",
)
def j18_nearest_label(spark, folder):
    p = points(spark, folder)
    v = p.where(F.col("vec_id") % 5 == 0).select(F.col("marker").alias("label"), *POS)
    out = rigid.nearest_labelled(p, v, id_="vec_id", position=POS, label="label", cell=0.1)
    return out.withColumn("distance", r6("distance"))


def relabels(spark, folder):
    """Rotation of each site relative to its joint, on valid frames."""
    both = rotations.join_streams(
        small_frames(spark, folder), large_frames(spark, folder), site_joint(spark), keys=["take", "frame"], site="site", joint="joint"
    )
    valid = both.where("valid")
    relative = Q.hold(Q.multiply(Q.conjugate(F.col("g")), F.col("q")), F.col("frame") >= 0)
    related = valid.withColumn("r", relative)
    return related.withColumn("m", Q.hold(Q.to_matrix(F.col("r")), F.col("frame") >= 0))


RELATIVE = f"{STREAMS}, rl AS (SELECT take, site, frame, {', '.join(f'{c} AS {a}' for c, a in zip(mul(conj(q_('g')), q_('s')), 'wxyz'))} FROM st WHERE valid)"


@query("j1_site_joint_join", f"WITH {RELATIVE} SELECT take::BIGINT AS take, site, frame, {', '.join(f'round({a}, 6) + 0.0 AS {a}' for a in 'wxyz')} FROM rl")
def j1_site_joint_join(spark, folder):
    return relabels(spark, folder).select(
        long("take").alias("take"), "site", "frame", *[r6(F.col("r")[c]).alias(c) for c in "wxyz"]
    )


@query(
    "a13_mean_matrix",
    f"WITH {RELATIVE} SELECT take::BIGINT AS take, site, {', '.join(f'round(avg({c}), 6) + 0.0 AS m{i // 3}{i % 3}' for i, c in enumerate(mat(q_())))} FROM rl GROUP BY take, site",
)
def a13_mean_matrix(spark, folder):
    m = F.col("m")
    return relabels(spark, folder).groupBy(long("take").alias("take"), "site").agg(
        *[r6(F.avg(m[c])).alias(c) for c in rigid.CELLS]
    )


@query("a13_mean_rotation")
def a13_mean_rotation(spark, folder):
    means = rotations.mean_rotation(relabels(spark, folder), keys=["take", "site"], matrix="m")
    return rotations.offset_angle(means, keys=["take", "site"]).withColumn("offset_deg", r6("offset_deg", 4))


@query("a14_dispersion")
def a14_dispersion(spark, folder):
    out = rotations.dispersion(relabels(spark, folder), keys=["take", "site"], frame="frame", matrix="m")
    return out.withColumn("dispersion", r6("dispersion", 4))


@query("q5_axis_findings")
def q5_axis_findings(spark, folder):
    spread = rotations.dispersion(relabels(spark, folder), keys=["take", "site"], frame="frame", matrix="m")
    tolerant = F.col("site") == SITES[0][0]
    found = rotations.dispersion_findings(spread, tolerant=tolerant, fail_deg=1.0, warn_deg=75.0)
    return found.select("take", "site", "severity", r6("dispersion", 4).alias("dispersion"))


def two_streams(spark, folder):
    """Each site's rotation and its joint's, by take, site and frame."""
    small = small_frames(spark, folder).select("take", "site", "frame", F.col("q").alias("a"))
    large = large_frames(spark, folder).join(site_joint(spark), "joint").select("take", "site", "frame", F.col("g").alias("b"))
    return small.join(large, ["take", "site", "frame"])


@query("a15_mounting_rotation")
def a15_mounting_rotation(spark, folder):
    vectors = two_streams(spark, folder).withColumns(
        {
            "va": Q.hold(Q.log_unit(Q.shorter_arc(F.col("a"))), F.col("frame") >= 0),
            "vb": Q.hold(Q.log_unit(Q.shorter_arc(F.col("b"))), F.col("frame") >= 0),
        }
    )
    out = rotations.mounting_rotation(vectors, keys=["take", "site"], a="va", b="vb", min_rate=0.2)
    return out.select("take", "site", "used", *[r6(F.col("mounting")[c], 5).alias(c) for c in rigid.CELLS])


@query("a16_compare_orientation")
def a16_compare_orientation(spark, folder):
    out = rotations.compare_orientation(
        two_streams(spark, folder), keys=["take", "site"], frame="frame", a="a", b="b", dt_s=0.01, min_rate=1.0
    )
    numbers = ("median_deg", "p95_deg", "max_deg", "rate_correlation")
    return out.select("take", "site", "frames", *[r6(c, 4).alias(c) for c in numbers])


@query("j19_two_stream_gaps")
def j19_two_stream_gaps(spark, folder):
    """The comparison on the frames both streams have, gaps left on the frame axis."""
    gappy = two_streams(spark, folder).withColumn("a", F.when(F.col("frame") % 10 != 3, F.col("a")))
    out = rotations.compare_orientation(gappy, keys=["take", "site"], frame="frame", a="a", b="b", dt_s=0.01, min_rate=1.0)
    return out.select("take", "site", "frames", r6("median_deg", 4).alias("median_deg"), r6("max_deg", 4).alias("max_deg"))
