"""Aggregates over frames and takes (A1-A4, A17-A19, A21, A23, A28-A32, A34-A36, A38-A41) and top rows."""

from __future__ import annotations

from pyspark.sql import functions as F

from motionframes.functions import quat as Q
from motionframes.operators import sets, stats, windows
from motionframes.operators.blocks import attach
from motionframes.operators.runs import edge_status

from .base import GAPPY_SQL, POINTS, QUATS, SERIES, STREAMS, gappy, large_frames, long, points, quats, query, r6, series, site_joint, small_frames, table
from .window_queries import STEP, TURNS, stepped, wrapped


@query(
    "a1_magnitude_bands",
    f"""WITH {GAPPY_SQL}, m AS (SELECT take, site, quantile_cont(x, 0.5) AS median, quantile_cont(x, 0.95) AS p95 FROM g WHERE ok GROUP BY ALL)
    SELECT take, site, round(median, 6) + 0.0 AS median, round(p95, 6) + 0.0 AS p95, median > 80.0 AS too_high, median < 20.0 AND p95 < 60.0 AS too_low FROM m""",
)
def a1_magnitude_bands(spark, folder):
    out = stats.magnitude_bands(
        gappy(spark, folder), keys=["take", "site"], magnitude="x", valid=F.col("ok"), median_max=80.0, median_min=20.0, floor_p95=60.0
    )
    return out.withColumns({c: r6(c) for c in ("median", "p95")})


# Fixed test pattern: a mask that disagrees with the values on some rows.
BAD_MASK = "(ok AND event_id % 50 <> 3) OR (NOT ok AND event_id % 70 = 7)"


@query(
    "a2_mask_discipline",
    f"""WITH {GAPPY_SQL} SELECT take, count(*) FILTER (NOT ({BAD_MASK}) AND x IS NOT NULL) AS invalid_present,
    count(*) FILTER (({BAD_MASK}) AND x IS NULL) AS valid_missing FROM g GROUP BY take""",
)
def a2_mask_discipline(spark, folder):
    return stats.mask_discipline(gappy(spark, folder), keys=["take"], valid=F.expr(BAD_MASK), components=["x"])


@query(
    "a3_norm_and_coverage",
    f"""WITH {STREAMS} SELECT take::BIGINT AS take, site, round(max(CASE WHEN valid THEN abs(sqrt(sw*sw + sx*sx + sy*sy + sz*sz) - 1) END), 6) + 0.0 AS norm_deviation,
    round(max(CASE WHEN valid THEN sqrt(sx*sx + sy*sy + sz*sz) END), 6) + 0.0 AS max_rate, round(avg(valid::INT), 6) + 0.0 AS coverage,
    count(*) FILTER (valid) = 0 AS no_valid_row FROM st GROUP BY take, site""",
)
def a3_norm_and_coverage(spark, folder):
    q = F.col("q")
    out = stats.norm_and_coverage(
        small_frames(spark, folder), keys=["take", "site"], norm=F.sqrt(Q.qdot(q, q)), rate=Q.norm(q), valid=F.col("valid")
    )
    out = out.withColumns({c: r6(c) for c in ("norm_deviation", "max_rate", "coverage")})
    return out.withColumn("take", long("take"))


@query(
    "a4_time_axis",
    f"""WITH {SERIES}, d AS (SELECT take, t_s - lag(t_s) OVER (PARTITION BY take ORDER BY frame) AS d FROM s)
    SELECT take, round(quantile_cont(d, 0.5), 6) + 0.0 AS median_step, coalesce(bool_and(d > 0), true) AS increasing,
      abs(quantile_cont(d, 0.5) - 36000.0) > 9000.0 AS rate_off FROM d GROUP BY take""",
)
def a4_time_axis(spark, folder):
    out = stats.time_axis(
        series(spark, folder), keys=["take"], frame="frame", time="t_s", nominal_s=36000.0, tolerance_s=9000.0
    )
    return out.withColumn("median_step", r6("median_step"))


@query(
    "a17_quasi_static",
    f"""WITH {SERIES}, f AS (SELECT *, event_id % 30 < 12 AND abs(x - 40.0) < 25.0 AS still FROM s)
    SELECT take, count(*) AS checked, count(*) FILTER (still) AS still, round(avg(x) FILTER (still), 6) + 0.0 AS mean,
     round(stddev_pop(x) FILTER (still), 6) + 0.0 AS spread, count(*) FILTER (x > 200.0) AS breaches,
     round(abs(avg(x) FILTER (still) - 40.0), 6) + 0.0 AS gravity_error FROM f GROUP BY take""",
)
def a17_quasi_static(spark, folder):
    s = series(spark, folder).withColumn("rate", (F.col("event_id") % 30).cast("double"))
    out = stats.quasi_static(
        s, keys=["take"], magnitude="x", rate="rate", gravity=40.0, max_rate=12.0, tolerance=25.0, bound=200.0
    )
    return out.withColumns({c: r6(c) for c in ("mean", "spread", "gravity_error")})


# Declared limits per coordinate: name, low, high, span limit (null: none).
LIMITS = (("click", 1.0, 120.0, 300.0), ("view", 0.5, 90.0, None), ("error", 2.0, 150.0, 250.0), ("jump", 0.0, 1.0, 1.0))
LIMIT_ROWS = ", ".join(f"('{n}', {a}, {b}, {'NULL' if c is None else c})" for n, a, b, c in LIMITS)
LIMIT_SQL = f"lim(site, low, high, span_limit) AS (VALUES {LIMIT_ROWS})"
RANGES = f"""{SERIES}, {LIMIT_SQL}, rg AS (SELECT take, site, min(x) AS mn, max(x) AS mx, count(*) FILTER (x < low OR x > high) AS n_out,
  avg((x < low OR x > high)::INT) AS share, any_value(span_limit) AS span_limit FROM s JOIN lim USING (site) GROUP BY take, site)"""


def limits(spark):
    return spark.createDataFrame(list(LIMITS), "site string, low double, high double, span_limit double")


@query(
    "a18_joint_ranges",
    f"""WITH {RANGES} SELECT take, site, mn AS min, mx AS max, round(mx - mn, 6) + 0.0 AS span, n_out AS rows_outside, round(share, 6) + 0.0 AS share_outside,
    coalesce(mx - mn > span_limit, false) AS came_apart FROM rg""",
)
def a18_joint_ranges(spark, folder):
    out = stats.joint_ranges(series(spark, folder), limits(spark), keys=["take"], name="site", value="x")
    return out.withColumns({"span": r6("span"), "share_outside": r6("share_outside")}).drop("span_limit")


@query(
    "a18_rows_outside",
    f"""WITH {SERIES}, {LIMIT_SQL}, f AS (SELECT take, frame, bool_or(x < low OR x > high) AS any_out FROM s JOIN lim USING (site) GROUP BY take, frame)
    SELECT take, count(*) FILTER (any_out) AS frames_outside, count(*) AS frames FROM f GROUP BY take""",
)
def a18_rows_outside(spark, folder):
    return stats.rows_outside(series(spark, folder), limits(spark), keys=["take"], frame="frame", name="site", value="x")


@query("a18_absent_coordinates", f"WITH {LIMIT_SQL} SELECT site FROM lim WHERE site NOT IN (SELECT event_type FROM events)")
def a18_absent_coordinates(spark, folder):
    return stats.absent_coordinates(table(spark, folder, "events").withColumnRenamed("event_type", "site"), limits(spark), name="site")


@query(
    "t3_worst_coordinate",
    f"""WITH {RANGES} SELECT take, (SELECT site FROM rg b WHERE b.take = a.take AND share > 0 ORDER BY share DESC, site LIMIT 1) AS worst,
    round(max(share), 6) + 0.0 AS worst_share, count(*) FILTER (mx - mn > span_limit) AS failed FROM rg a GROUP BY take""",
)
def t3_worst_coordinate(spark, folder):
    ranges = stats.joint_ranges(series(spark, folder), limits(spark), keys=["take"], name="site", value="x")
    return stats.worst_coordinate(ranges, keys=["take"], name="site").withColumn("worst_share", r6("worst_share"))


@query(
    "a19_pool_over_trials",
    """SELECT l_partkey AS segment, round(quantile_cont(l_extendedprice, 0.5), 6) + 0.0 AS pooled,
    round(max(l_extendedprice) - min(l_extendedprice), 6) + 0.0 AS spread, count(DISTINCT l_orderkey) AS trials FROM lineitem GROUP BY l_partkey""",
)
def a19_pool_over_trials(spark, folder):
    lengths = table(spark, folder, "lineitem").select(
        F.col("l_partkey").alias("segment"), F.col("l_orderkey").alias("trial"), F.col("l_extendedprice").alias("length")
    )
    out = stats.pool_over_trials(lengths, keys=["segment"], trial="trial", value="length")
    return out.withColumns({c: r6(c) for c in ("pooled", "spread")})


@query(
    "a19_composite_pairs",
    """WITH p AS (SELECT DISTINCT 'n' || n_regionkey AS a, 'n' || (n_nationkey % 7) AS b FROM nation), mid(node) AS (VALUES ('n1'), ('n4'))
    SELECT a, b FROM p UNION SELECT u.a, l.b FROM p u JOIN mid ON u.b = node JOIN p l ON l.a = node""",
)
def a19_composite_pairs(spark, folder):
    n = table(spark, folder, "nation")
    pairs = n.select(
        F.concat(F.lit("n"), F.col("n_regionkey").cast("string")).alias("a"),
        F.concat(F.lit("n"), (F.col("n_nationkey") % 7).cast("string")).alias("b"),
    ).distinct()
    bridge = spark.createDataFrame([("n1",), ("n4",)], "node string")
    return stats.composite_pairs(pairs, bridge=bridge)


@query(
    "a21_rate_sensitivity",
    f"""WITH {SERIES} SELECT take, round(avg(x*x*0.002), 6) + 0.0 AS mean, round(quantile_cont(x*x*0.002, 0.95), 6) + 0.0 AS p95,
    round(max(x*x*0.002), 6) + 0.0 AS max FROM s GROUP BY take""",
)
def a21_rate_sensitivity(spark, folder):
    out = stats.rate_sensitivity(series(spark, folder), keys=["take"], rate="x", uncertainty=0.002)
    return out.withColumns({c: r6(c) for c in ("mean", "p95", "max")})


MEAN_DIRECTION = f"""{QUATS}, un AS (SELECT take, vx/n AS x, vy/n AS y, vz/n AS z FROM (SELECT *, sqrt(vx*vx+vy*vy+vz*vz) AS n FROM q)),
m AS (SELECT take, avg(x) AS mx, avg(y) AS my, avg(z) AS mz FROM un GROUP BY take),
dr AS (SELECT take, mx/l AS dx, my/l AS dy, mz/l AS dz FROM (SELECT *, sqrt(mx*mx+my*my+mz*mz) AS l FROM m))"""


@query(
    "a23_mean_direction",
    f"""WITH {MEAN_DIRECTION} SELECT d.take::BIGINT AS take, round(any_value(dx), 6) + 0.0 AS x, round(any_value(dy), 6) + 0.0 AS y,
    round(any_value(dz), 6) + 0.0 AS z, round(avg((x*dx + y*dy + z*dz > 0)::INT), 6) + 0.0 AS agree FROM un JOIN dr d USING (take) GROUP BY d.take""",
)
def a23_mean_direction(spark, folder):
    rows = quats(spark, folder)
    mean = stats.mean_direction(rows, keys=["take"], vector="v")
    d = F.col("direction")
    lasts = rows.groupBy("take").agg(F.max("frame").alias("last"))
    both = attach(rows, mean.join(lasts, "take"), keys=["take"], frame="frame", last_frame="last")
    agree = both.groupBy("take").agg(
        F.avg((Q.dot(F.col("v"), d) > 0).cast("double")).alias("agree"), F.first("direction").alias("direction")
    )
    return agree.select(long("take").alias("take"), *[r6(d[c]).alias(c) for c in "xyz"], r6("agree").alias("agree"))


@query(
    "a28_whole_body",
    f"""WITH {QUATS}, b AS (SELECT frame % 20 AS frame, take + 1.0 AS m, vx, vy, vz, ux, uy, uz FROM q),
    c AS (SELECT frame, sum(m) AS mass, sum(m*vx)/sum(m) AS cx, sum(m*vy)/sum(m) AS cy, sum(m*vz)/sum(m) AS cz,
      sum(m*ux)/sum(m) AS wx, sum(m*uy)/sum(m) AS wy, sum(m*uz)/sum(m) AS wz FROM b GROUP BY frame)
    SELECT frame, round(any_value(mass), 6) + 0.0 AS mass, round(any_value(cx), 6) + 0.0 AS centre_x, round(any_value(wx), 6) + 0.0 AS velocity_x,
      round(sum(m*((vy-cy)*(uz-wz) - (vz-cz)*(uy-wy))), 6) + 0.0 AS momentum_x, round(sum(m*((vz-cz)*(ux-wx) - (vx-cx)*(uz-wz))), 6) + 0.0 AS momentum_y,
      round(sum(m*((vx-cx)*(uy-wy) - (vy-cy)*(ux-wx))), 6) + 0.0 AS momentum_z FROM b JOIN c USING (frame) GROUP BY frame""",
)
def a28_whole_body(spark, folder):
    parts = quats(spark, folder).select(
        (F.col("frame") % 20).alias("frame"), (F.col("take") + 1.0).alias("m"), *[F.col("v")[c].alias(f"p{c}") for c in "xyz"],
        *[F.col("u")[c].alias(f"w{c}") for c in "xyz"],
    )
    out = stats.whole_body(parts, keys=["frame"], mass="m", position=["px", "py", "pz"], velocity=["wx", "wy", "wz"])
    names = ("mass", "centre_x", "velocity_x", "momentum_x", "momentum_y", "momentum_z")
    return out.select("frame", *[r6(c).alias(c) for c in names])


@query(
    "a29_mass_properties",
    f"""WITH {POINTS}, c AS (SELECT marker, avg(x) AS cx, avg(y) AS cy, avg(z) AS cz, count(*) AS n FROM p GROUP BY marker)
    SELECT marker, any_value(n) AS points, round(any_value(n) * 0.5, 6) + 0.0 AS mass, round(any_value(cx), 6) + 0.0 AS centre_x,
      round(0.5 * sum((y-cy)*(y-cy) + (z-cz)*(z-cz)) + any_value(n) * 0.5 * 0.0004 / 6, 6) + 0.0 AS inertia_xx,
      round(-0.5 * sum((x-cx)*(y-cy)), 6) + 0.0 AS inertia_xy FROM p JOIN c USING (marker) GROUP BY marker""",
)
def a29_mass_properties(spark, folder):
    out = stats.mass_properties(points(spark, folder), label=["marker"], position=["x", "y", "z"], point_mass=0.5, cell=0.02)
    n = (F.col("mass") / 0.5).cast("bigint").alias("points")
    return out.select("marker", n, *[r6(c).alias(c) for c in ("mass", "centre_x", "inertia_xx", "inertia_xy")])


@query(
    "a30_hierarchy_roll_up",
    """WITH leaf AS (SELECT o_orderpriority AS k, c_nationkey AS n, sum(o_totalprice) AS v, count(*) AS c FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY ALL)
    SELECT k, 'n' || n AS node, round(v, 2) + 0.0 AS total, c AS rows FROM leaf
    UNION ALL SELECT k, 'r' || n_regionkey, round(sum(v), 2) + 0.0, sum(c)::BIGINT FROM leaf JOIN nation ON n = n_nationkey GROUP BY ALL
    UNION ALL SELECT k, 'world', round(sum(v), 2) + 0.0, sum(c)::BIGINT FROM leaf GROUP BY ALL""",
)
def a30_hierarchy_roll_up(spark, folder):
    nation, region = table(spark, folder, "nation"), table(spark, folder, "region")
    name = lambda p, c: F.concat(F.lit(p), F.col(c).cast("string"))
    edges = (
        nation.select(name("n", "n_nationkey").alias("node"), name("r", "n_regionkey").alias("parent"))
        .unionByName(region.select(name("r", "r_regionkey").alias("node"), F.lit("world").alias("parent")))
        .unionByName(region.limit(1).select(F.lit("world").alias("node"), F.lit(None).cast("string").alias("parent")))
    )
    loads = table(spark, folder, "orders").join(table(spark, folder, "customer"), F.col("o_custkey") == F.col("c_custkey"))
    loads = loads.select(
        F.col("o_orderpriority").alias("k"), name("n", "c_nationkey").alias("node"), F.col("o_totalprice").alias("total"), F.lit(1).alias("rows")
    )
    out = stats.roll_up(loads, stats.tree_closure(edges, depth=2), keys=["k"], node="node", values=["total", "rows"])
    return out.withColumn("total", r6("total", 2))


@query(
    "a31_mass_from_force",
    """SELECT l_suppkey AS take, round(avg(l_quantity + l_discount) / 9.81, 6) + 0.0 AS mass FROM lineitem GROUP BY l_suppkey""",
)
def a31_mass_from_force(spark, folder):
    loads = table(spark, folder, "lineitem").withColumnRenamed("l_suppkey", "take")
    out = stats.mass_from_force(loads, keys=["take"], left="l_quantity", right="l_discount", gravity=-9.81)
    return out.withColumn("mass", r6("mass"))


@query(
    "a31_force_by_side",
    """SELECT l_suppkey AS take, l_returnflag AS side, round(quantile_cont(l_quantity, 0.5), 6) + 0.0 AS median,
     round(quantile_cont(l_quantity, 0.99), 6) + 0.0 AS p99, count(*) AS rows FROM lineitem WHERE l_linestatus = 'F' GROUP BY ALL""",
)
def a31_force_by_side(spark, folder):
    loads = table(spark, folder, "lineitem").where("l_linestatus = 'F'").withColumnsRenamed({"l_suppkey": "take", "l_returnflag": "side"})
    out = stats.exact_quantiles(
        loads, keys=["take", "side"], value="l_quantity", probs={"median": 0.5, "p99": 0.99}, aggs=[F.count(F.lit(1)).alias("rows")]
    )
    return out.withColumns({c: r6(c) for c in ("median", "p99")})


@query(
    "a32_mean_heading",
    f"WITH {TURNS} SELECT take, round(atan2(avg(sin(angle)), avg(cos(angle))), 6) + 0.0 AS heading FROM a GROUP BY take",
)
def a32_mean_heading(spark, folder):
    return stats.mean_heading(wrapped(spark, folder), keys=["take"], angle="angle").withColumn("heading", r6("heading"))


@query(
    "a34_corpus_summary",
    f"""WITH {STEP}, t AS (SELECT take, max(step) AS worst FROM st GROUP BY take) SELECT round(quantile_cont(worst, 0.5), 4) + 0.0 AS median,
    round(quantile_cont(worst, 0.99), 4) + 0.0 AS p99, round(max(worst), 4) + 0.0 AS max, count(*) FILTER (worst > 179.0) AS offenders, count(*) AS takes FROM t""",
)
def a34_corpus_summary(spark, folder):
    takes = stepped(spark, folder).groupBy("take").agg(F.max("step_deg").alias("worst"))
    out = stats.corpus_summary(takes, value="worst", limit=179.0)
    return out.withColumns({c: r6(c, 4) for c in ("median", "p99", "max")})


TOKENS = ("the", "licen", "que", "©", "password", "zzzz")
TOKEN_ROWS = ", ".join(f"('{t}')" for t in TOKENS)


@query(
    "a35_witnessed_items",
    f"""WITH t(token) AS (VALUES {TOKEN_ROWS}), b AS (SELECT DISTINCT source FROM documents)
    SELECT b.source, count(*) FILTER (EXISTS (SELECT 1 FROM documents d WHERE d.source = b.source AND contains(d.text, t.token))) AS witnessed,
      round(count(*) FILTER (EXISTS (SELECT 1 FROM documents d WHERE d.source = b.source AND contains(d.text, t.token))) / 6.0, 6) + 0.0 AS coverage
    FROM b, t GROUP BY b.source""",
)
def a35_witnessed_items(spark, folder):
    out = stats.witnessed_items(table(spark, folder, "documents"), TOKENS, bundle="source", text="text")
    return out.withColumn("coverage", r6("coverage"))


@query(
    "a36_largest_error",
    f"""WITH {SERIES}, d AS (SELECT *, x - lag(x, 1, 0.0) OVER (PARTITION BY take ORDER BY frame) AS v FROM s),
    r AS (SELECT *, sum(v) OVER (PARTITION BY take ORDER BY frame) AS back FROM d) SELECT take, round(max(abs(back - x)), 6) + 0.0 AS max_error FROM r GROUP BY take""",
)
def a36_largest_error(spark, folder):
    """Differences summed up again, against the values they came from."""
    diffs = windows.differences(series(spark, folder), keys=["take"], frame="frame", value="x", dt_s=1.0)
    back = windows.integrate(diffs, keys=["take"], frame="frame", rate=F.coalesce("backward", "x"), out="back")
    return stats.largest_error(back, keys=["take"], truth="x", found="back").withColumn("max_error", r6("max_error"))


@query(
    "a38_agreement",
    f"""WITH {STREAMS}, n AS (SELECT take, site, CASE WHEN valid THEN sqrt(sx*sx + sy*sy + sz*sz) END AS a, sqrt(gx*gx + gy*gy + gz*gz) AS b FROM st),
    k AS (SELECT take, site, count(*) AS n, corr(a, b) AS r, sqrt(avg((a-b)*(a-b))) AS rms, quantile_cont(a, 0.5) AS ma, quantile_cont(b, 0.5) AS mb,
      count(*) >= 3 AND stddev_pop(a) > 0 AND stddev_pop(b) > 0 AS ok FROM n WHERE a IS NOT NULL GROUP BY ALL)
    SELECT take::BIGINT AS take, site, n, CASE WHEN ok THEN round(r, 6) + 0.0 END AS pearson, CASE WHEN ok THEN round(rms, 6) + 0.0 END AS rms,
      CASE WHEN ok THEN round(ma, 6) + 0.0 END AS median_a, CASE WHEN ok THEN round(mb, 6) + 0.0 END AS median_b FROM k""",
)
def a38_agreement(spark, folder):
    small = small_frames(spark, folder).withColumn("a", F.when(F.col("valid"), Q.norm(F.col("q"))))
    large = large_frames(spark, folder).join(site_joint(spark), "joint").withColumn("b", Q.norm(F.col("g")))
    both = small.select("take", "frame", "site", "a").join(large.select("take", "frame", "site", "b"), ["take", "frame", "site"])
    out = stats.agreement(both, keys=["take", "site"], a="a", b="b")
    return out.select(long("take").alias("take"), "site", "n", *[r6(c).alias(c) for c in ("pearson", "rms", "median_a", "median_b")])


@query(
    "a39_missing_census",
    f"""WITH {GAPPY_SQL}, c AS (SELECT take, count(*) FILTER (x IS NULL) AS v, count(*) FILTER (event_id % 40 = 1) AS t FROM g GROUP BY take)
    SELECT take, 'value' AS input, v AS missing FROM c WHERE v > 0 UNION ALL SELECT take, 'time', t FROM c WHERE t > 0""",
)
def a39_missing_census(spark, folder):
    g = gappy(spark, folder).withColumn("t", F.when(F.col("event_id") % 40 == 1, F.lit(float("nan"))).otherwise(F.col("t_s")))
    return stats.missing_census(g, keys=["take"], columns={"value": "x", "time": "t"})


@query(
    "a40_subject_summary",
    """WITH t AS (SELECT o_custkey AS subject, o_orderkey, count(l_orderkey) AS frames, (o_orderkey % 4 * 50 + 50) AS rate, o_orderstatus = 'P' AS skipped
      FROM orders LEFT JOIN lineitem ON o_orderkey = l_orderkey GROUP BY ALL)
    SELECT subject, count(*) AS trials, count(*) FILTER (skipped) AS skipped, coalesce(sum(frames) FILTER (NOT skipped), 0)::BIGINT AS frames,
      (SELECT string_agg(r, ',' ORDER BY r) FROM (SELECT DISTINCT rate AS r FROM t u WHERE u.subject = t.subject)) AS rates FROM t GROUP BY subject""",
)
def a40_subject_summary(spark, folder):
    trials = (
        table(spark, folder, "orders")
        .join(table(spark, folder, "lineitem").groupBy("l_orderkey").agg(F.count(F.lit(1)).alias("n")), F.col("o_orderkey") == F.col("l_orderkey"), "left")
        .select(
            F.col("o_custkey").alias("subject"),
            F.coalesce("n", F.lit(0)).alias("frames"),
            (F.col("o_orderkey") % 4 * 50 + 50).alias("rate"),
            (F.col("o_orderstatus") == "P").alias("skipped_"),
        )
    )
    return stats.subject_summary(trials, keys=["subject"], frames="frames", skipped=F.col("skipped_"), rate="rate")


@query(
    "a40_resume",
    "SELECT o_orderkey, o_custkey FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem WHERE l_linestatus = 'O')",
)
def a40_resume(spark, folder):
    done = table(spark, folder, "lineitem").where("l_linestatus = 'O'").select(F.col("l_orderkey").alias("o_orderkey"))
    return stats.not_done(table(spark, folder, "orders").select("o_orderkey", "o_custkey"), done, keys=["o_orderkey"])


@query(
    "a41_inner_summary",
    f"""WITH {SERIES}, n AS (SELECT take, max(frame) AS l FROM s GROUP BY take)
    SELECT take, round(avg(x), 6) + 0.0 AS mean, round(quantile_cont(x, 0.95), 6) + 0.0 AS p95, round(sqrt(avg(x*x)), 6) + 0.0 AS rms, count(*) AS rows
    FROM s JOIN n USING (take) WHERE frame >= 3 AND frame <= l - 3 AND site <> 'error' GROUP BY take""",
)
def a41_inner_summary(spark, folder):
    """Rows at least three frames away from both ends, and valid."""
    trimmed = edge_status(series(spark, folder), keys=["take"], frame="frame", solved=F.lit(True), trim=3)
    out = stats.inner_summary(trimmed, keys=["take"], value="x", keep=F.col("inside") & (F.col("site") != "error"))
    return out.withColumns({c: r6(c) for c in ("mean", "p95", "rms")})


@query("t2_first_ok_takes", "SELECT o_orderkey, o_custkey FROM orders WHERE o_orderstatus = 'O' ORDER BY o_orderkey LIMIT 25")
def t2_first_ok_takes(spark, folder):
    orders = table(spark, folder, "orders").where("o_orderstatus = 'O'").select("o_orderkey", "o_custkey")
    return sets.first_rows(orders, order=["o_orderkey"], count=25)
