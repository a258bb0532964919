"""Runs, neighbours, prefixes, gap fills and resampling (W1-W23, W26, W27) with the flagship query."""

from __future__ import annotations

import math

from pyspark.sql import functions as F

from motionframes.functions import quat as Q
from motionframes.operators import gaps, runs, stats, windows
from motionframes.operators.quantiles import exact_quantiles

from .base import GAPPY_SQL, QUATS, SERIES, gappy, long, quats, query, r6, series, table

# Runs of a flag over a numbered series in SQL: usable with any CTE that has take, frame and a flag.
RUNS = """
r0 AS (SELECT *, CASE WHEN lag({flag}) OVER w IS NOT DISTINCT FROM {flag} AND frame > 0 THEN 0 ELSE 1 END AS brk
       FROM {src} WINDOW w AS (PARTITION BY take ORDER BY frame)),
r1 AS (SELECT *, sum(brk) OVER (PARTITION BY take ORDER BY frame) AS run FROM r0),
r AS (SELECT take, {flag} AS state, run, min(frame) AS start, max(frame) + 1 AS stop, count(*) AS length
      FROM r1 GROUP BY take, {flag}, run)"""


def raw_takes(spark, folder):
    """The take of every event: a cheap size check for what is derived from the series."""
    return table(spark, folder, "events").select(F.col("user_id").alias("take"))


@query(
    "flagship_usable_runs",
    f"WITH {SERIES}, u AS (SELECT *, site <> 'error' AS ok FROM s), {RUNS.format(flag='ok', src='u')}, "
    """best AS (SELECT take, start, stop, length, row_number() OVER (PARTITION BY take ORDER BY length DESC, start) AS k
       FROM r WHERE state)
    SELECT b.take, b.start, b.stop, b.length, b.length / t.n AS coverage, x.median, x.p95
    FROM best b JOIN (SELECT take, count(*) AS n FROM s GROUP BY take) t USING (take)
    JOIN (SELECT b.take, round(quantile_cont(u.x, 0.5), 6) + 0.0 AS median, round(quantile_cont(u.x, 0.95), 6) + 0.0 AS p95
          FROM best b JOIN u ON b.take = u.take AND u.frame >= b.start AND u.frame < b.stop WHERE b.k = 1 GROUP BY b.take) x
      USING (take) WHERE b.k = 1""".replace("b.length / t.n AS coverage", "round(b.length / t.n, 6) + 0.0 AS coverage"),
)
def flagship_usable_runs(spark, folder):
    usable = series(spark, folder).withColumn("ok", F.col("site") != "error")
    best = runs.longest_span(usable, keys=["take"], frame="frame", solved=F.col("ok")).where("length > 0")
    inside = runs.within_spans(usable, best, keys=["take"], frame="frame")
    spread = exact_quantiles(inside, keys=["take"], value="x", probs={"median": 0.5, "p95": 0.95}, sized_by=raw_takes(spark, folder))
    return best.join(spread, "take").select(
        "take", "start", "stop", "length", r6("coverage").alias("coverage"), r6("median").alias("median"), r6("p95").alias("p95")
    )


@query(
    "w1_speed_outliers",
    f"""WITH {GAPPY_SQL}, n AS (SELECT *, lag(x) OVER w AS xb, lead(x) OVER w AS xa FROM g WINDOW w AS (PARTITION BY take ORDER BY frame))
    SELECT take, frame, CASE WHEN x IS NULL THEN false
      WHEN xb IS NOT NULL AND xa IS NOT NULL THEN abs(x - xb) > 150.0 AND abs(xa - x) > 150.0
      ELSE coalesce(abs(x - xb) > 150.0, false) OR coalesce(abs(xa - x) > 150.0, false) END AS speed_outlier FROM n""",
)
def w1_speed_outliers(spark, folder):
    out = windows.flag_speed_outliers(
        gappy(spark, folder), keys=["take"], frame="frame", position=["x"], dt_s=1.0, max_speed=150.0
    )
    return out.select("take", "frame", "speed_outlier")


@query(
    "w2_runs",
    f"WITH {GAPPY_SQL}, {RUNS.format(flag='ok', src='g')} SELECT take, state, start, stop, length FROM r",
)
def w2_runs(spark, folder):
    return runs.runs(gappy(spark, folder), keys=["take"], frame="frame", state=F.col("ok"))


@query(
    "w2_gap_runs",
    f"WITH {GAPPY_SQL}, {RUNS.format(flag='ok', src='g')} SELECT take, start, stop, length FROM r WHERE NOT state",
)
def w2_gap_runs(spark, folder):
    return runs.gap_runs(gappy(spark, folder), keys=["take"], frame="frame", solved=F.col("ok"))


@query(
    "w3_longest_span",
    f"""WITH {GAPPY_SQL}, {RUNS.format(flag='ok', src='g')},
    b AS (SELECT *, row_number() OVER (PARTITION BY take ORDER BY length DESC, start) AS k FROM r WHERE state), n AS (SELECT take, count(*) AS n FROM g GROUP BY take)
    SELECT n.take, coalesce(start, 0) AS start, coalesce(stop, 0) AS stop, coalesce(length, 0) AS length, round(coalesce(length, 0) / n, 6) + 0.0 AS coverage
    FROM n LEFT JOIN b ON b.take = n.take AND b.k = 1""",
)
def w3_longest_span(spark, folder):
    out = runs.longest_span(gappy(spark, folder), keys=["take"], frame="frame", solved=F.col("ok"))
    return out.withColumn("coverage", r6("coverage"))


CONTACT = f"{SERIES}, c AS (SELECT *, site IN ('click', 'view') AS contact FROM s)"
SEGMENTS = f"""{CONTACT}, e AS (SELECT *, CASE WHEN contact AND NOT lag(contact) OVER w THEN 1 ELSE 0 END AS rise
      FROM c WINDOW w AS (PARTITION BY take ORDER BY frame)),
seg AS (SELECT *, sum(rise) OVER (PARTITION BY take ORDER BY frame) AS segment FROM e)"""


def segmented(spark, folder):
    contact = F.col("site").isin("click", "view")
    return runs.edge_segments(series(spark, folder), keys=["take"], frame="frame", contact=contact)


@query(
    "w4_edge_segments",
    f"WITH {SEGMENTS} SELECT take, segment::BIGINT AS segment, min(frame) AS start, max(frame) + 1 AS stop FROM seg GROUP BY take, segment",
)
def w4_edge_segments(spark, folder):
    return segmented(spark, folder).groupBy("take", "segment").agg(
        F.min("frame").alias("start"), (F.max("frame") + 1).alias("stop")
    )


HERMITE = f"""{GAPPY_SQL}, {RUNS.format(flag='ok', src='g')},
gap AS (SELECT take, start, stop FROM r WHERE NOT state AND stop - start <= 3
        AND start > 0 AND stop < (SELECT count(*) FROM g WHERE g.take = r.take)),
k AS (SELECT gap.*, l.x AS p0, l.x - l2.x AS r0, h.x AS p1, h2.x - h.x AS r1, (stop - start + 1)::DOUBLE AS span FROM gap
      JOIN g l ON l.take = gap.take AND l.frame = start - 1 JOIN g h ON h.take = gap.take AND h.frame = stop
      LEFT JOIN g l2 ON l2.take = gap.take AND l2.frame = start - 2 LEFT JOIN g h2 ON h2.take = gap.take AND h2.frame = stop + 1),
f0 AS (SELECT g.take, g.frame, g.x, g.ok, p0, p1, span, (g.frame - start + 1) / span AS t,
             coalesce(r0, (p1 - p0) / span) AS v0, coalesce(r1, (p1 - p0) / span) AS v1
      FROM g LEFT JOIN k ON g.take = k.take AND g.frame >= k.start AND g.frame < k.stop),
filled AS (SELECT take, frame, CASE WHEN ok THEN x ELSE (2*t*t*t - 3*t*t + 1) * p0 + (t*t*t - 2*t*t + t) * v0 * span
        + (3*t*t - 2*t*t*t) * p1 + (t*t*t - t*t) * v1 * span END AS x,
       CASE WHEN ok THEN 'OBSERVED' WHEN p0 IS NOT NULL THEN 'INTERPOLATED' ELSE 'UNAVAILABLE' END AS status FROM f0)"""


def filled(spark, folder):
    return gaps.hermite_fill(gappy(spark, folder), keys=["take"], frame="frame", columns=["x"], max_gap=3)


@query("w5_hermite_fill", f"WITH {HERMITE} SELECT take, frame, round(x, 8) + 0.0 AS x, status FROM filled")
def w5_hermite_fill(spark, folder):
    return filled(spark, folder).select("take", "frame", r6("x", 8).alias("x"), "status")


@query("w6_spherical_fill")
def w6_spherical_fill(spark, folder):
    q = quats(spark, folder).withColumn("q", F.when(F.col("frame") % 9 > 1, F.col("q")))
    out = gaps.spherical_fill(q, keys=["take"], frame="frame", q="q", max_gap=4)
    return out.select("take", "frame", *[r6(F.col("q")[c]).alias(c) for c in "wxyz"])


@query(
    "w7_sign_continuous",
    f"""WITH {QUATS}, f AS (SELECT *, CASE WHEN w * lag(w) OVER o + x * lag(x) OVER o + y * lag(y) OVER o + z * lag(z) OVER o < 0
      THEN 1 ELSE 0 END AS flip FROM q WINDOW o AS (PARTITION BY take ORDER BY frame)),
    n AS (SELECT *, CASE WHEN sum(flip) OVER (PARTITION BY take ORDER BY frame) % 2 = 1 THEN -1.0::DOUBLE ELSE 1.0::DOUBLE END AS sg FROM f)
    SELECT take::BIGINT AS take, frame, round(w * sg, 6) + 0.0 AS w, round(x * sg, 6) + 0.0 AS x, round(y * sg, 6) + 0.0 AS y,
           round(z * sg, 6) + 0.0 AS z FROM n""",
)
def w7_sign_continuous(spark, folder):
    out = windows.sign_continuous(quats(spark, folder), keys=["take"], frame="frame", q="q")
    return out.select(long("take").alias("take"), "frame", *[r6(F.col("q")[c]).alias(c) for c in "wxyz"])


PI = repr(math.pi)
WRAPPED = f"{SERIES}, a AS (SELECT *, x / 40.0 - 2 * {PI} * floor((x / 40.0 + {PI}) / (2 * {PI})) AS angle FROM s)"
TURNS = f"""{WRAPPED}, d AS (SELECT *, angle - lag(angle) OVER (PARTITION BY take ORDER BY frame) AS d FROM a),
t AS (SELECT *, CASE WHEN d IS NULL OR abs(d) < {PI} THEN 0 WHEN d > 0 THEN -ceil((d - {PI}) / (2 * {PI}))
      ELSE -floor((d + {PI}) / (2 * {PI})) END AS turn FROM d),
uw AS (SELECT *, sum(turn) OVER (PARTITION BY take ORDER BY frame) AS k FROM t)"""


def wrapped(spark, folder):
    turn = F.col("x") / 40.0
    angle = turn - 2 * F.lit(math.pi) * F.floor((turn + math.pi) / (2 * F.lit(math.pi)))
    return series(spark, folder).withColumn("angle", angle)


@query(
    "w8_unwrap",
    f"WITH {TURNS} SELECT take, frame, round(angle + 2 * {PI} * k, 5) + 0.0 AS unwrapped, (-k)::BIGINT AS wrap_counter, turn <> 0 AS transition FROM uw",
)
def w8_unwrap(spark, folder):
    out = windows.unwrap(wrapped(spark, folder), keys=["take"], frame="frame", angle="angle")
    return out.select("take", "frame", r6("unwrapped", 5).alias("unwrapped"), "wrap_counter", "transition")


@query(
    "w8_wrap_events",
    f"""WITH {TURNS} SELECT take, count(*) FILTER (turn <> 0) AS transitions,
    count(*) FILTER (turn <> 0) > 0 AS repaired FROM uw GROUP BY take""",
)
def w8_wrap_events(spark, folder):
    out = windows.unwrap(wrapped(spark, folder), keys=["take"], frame="frame", angle="angle")
    return out.groupBy("take").agg(F.count_if("transition").alias("transitions")).withColumn(
        "repaired", F.col("transitions") > 0
    )


@query(
    "w9_differences",
    f"""WITH {SERIES}, a AS (SELECT *, CASE WHEN xb IS NULL THEN (xa - x) / 0.01 WHEN xa IS NULL THEN (x - xb) / 0.01
        ELSE (xa - xb) / 0.02 END AS c FROM (SELECT *, lag(x) OVER w AS xb, lead(x) OVER w AS xa FROM s WINDOW w AS (PARTITION BY take ORDER BY frame)))
    SELECT take, frame, round(c, 3) + 0.0 AS centred, round((x - xb) / 0.01, 3) + 0.0 AS backward,
      round(CASE WHEN lag(c) OVER w IS NULL THEN (lead(c) OVER w - c) / 0.01 WHEN lead(c) OVER w IS NULL THEN (c - lag(c) OVER w) / 0.01
        ELSE (lead(c) OVER w - lag(c) OVER w) / 0.02 END, 2) + 0.0 AS second FROM a WINDOW w AS (PARTITION BY take ORDER BY frame)""",
)
def w9_differences(spark, folder):
    out = windows.differences(series(spark, folder), keys=["take"], frame="frame", value="x", dt_s=0.01)
    return out.select(
        "take", "frame", r6("centred", 3).alias("centred"), r6("backward", 3).alias("backward"), r6("second", 2).alias("second")
    )


# log map of conj(a) * b between two quaternions given by column prefixes, in SQL
def rel_sql(a: str, b: str) -> str:
    aw, ax, ay, az = (f"{a}{c}" for c in "wxyz")
    bw, bx, by, bz = (f"{b}{c}" for c in "wxyz")
    return (
        f"{aw}*{bw} + {ax}*{bx} + {ay}*{by} + {az}*{bz} AS rw, "
        f"{aw}*{bx} - {ax}*{bw} - {ay}*{bz} + {az}*{by} AS rx, "
        f"{aw}*{by} + {ax}*{bz} - {ay}*{bw} - {az}*{bx} AS ry, "
        f"{aw}*{bz} - {ax}*{by} + {ay}*{bx} - {az}*{bw} AS rz"
    )


LOG = """lg AS (SELECT *, CASE WHEN n > 1e-12 THEN sg * atan2(n, least(1.0, greatest(-1.0, rw * sg))) / n ELSE 0.0 END AS k FROM
  (SELECT *, sqrt(rx*rx + ry*ry + rz*rz) AS n, CASE WHEN rw < 0 THEN -1.0::DOUBLE ELSE 1.0::DOUBLE END AS sg FROM rel))"""
NEIGHBOURS = ", ".join(f"lag({c}) OVER o AS p{c}, lead({c}) OVER o AS n{c}" for c in "wxyz")


@query(
    "w10_angular_rate",
    f"""WITH {QUATS}, nb AS (SELECT take, frame, {NEIGHBOURS} FROM q WINDOW o AS (PARTITION BY take ORDER BY frame)),
    rel AS (SELECT take, frame, {rel_sql('p', 'n')} FROM nb), {LOG}
    SELECT take::BIGINT AS take, frame, round(k * rx / 0.01, 4) + 0.0 AS x, round(k * ry / 0.01, 4) + 0.0 AS y,
           round(k * rz / 0.01, 4) + 0.0 AS z FROM lg""",
)
def w10_angular_rate(spark, folder):
    out = windows.angular_rate(
        quats(spark, folder), keys=["take"], frame="frame", q="q", dt_s=0.01, one_sided_ends=False
    )
    return out.select(long("take").alias("take"), "frame", *[r6(F.col("rate")[c], 4).alias(c) for c in "xyz"])


@query(
    "w10_angular_rate_one_sided",
    f"""WITH {QUATS}, nb0 AS (SELECT take, frame, {', '.join(c + ' AS h' + c for c in 'wxyz')}, {NEIGHBOURS} FROM q WINDOW o AS (PARTITION BY take ORDER BY frame)),
    nb AS (SELECT take, frame, {', '.join(f'coalesce(p{c}, h{c}) AS p{c}, coalesce(n{c}, h{c}) AS n{c}' for c in 'wxyz')},
      CASE WHEN pw IS NULL OR nw IS NULL THEN 2.0::DOUBLE ELSE 1.0::DOUBLE END AS f FROM nb0),
    rel AS (SELECT take, frame, f, {rel_sql('p', 'n')} FROM nb), {LOG}
    SELECT take::BIGINT AS take, frame, round(f * k * rx / 0.01, 4) + 0.0 AS x, round(f * k * ry / 0.01, 4) + 0.0 AS y,
           round(f * k * rz / 0.01, 4) + 0.0 AS z FROM lg""",
)
def w10_angular_rate_one_sided(spark, folder):
    out = windows.angular_rate(
        quats(spark, folder), keys=["take"], frame="frame", q="q", dt_s=0.01, one_sided_ends=True
    )
    return out.select(long("take").alias("take"), "frame", *[r6(F.col("rate")[c], 4).alias(c) for c in "xyz"])


STEP = f"""{QUATS}, st AS (SELECT *, coalesce(degrees(2 * acos(least(1.0, abs(w * lag(w) OVER o + x * lag(x) OVER o + y * lag(y) OVER o
  + z * lag(z) OVER o)))), 0.0) AS step FROM q WINDOW o AS (PARTITION BY take ORDER BY frame)),
gl AS (SELECT *, bool_or(step > 170.0) OVER (PARTITION BY take ORDER BY frame ROWS BETWEEN 2 PRECEDING AND 2 FOLLOWING) AS glitch FROM st)"""


def stepped(spark, folder):
    return windows.step_angle(quats(spark, folder), keys=["take"], frame="frame", q="q", limit_deg=170.0, pad=2)


@query("w11_step_angle", f"WITH {STEP} SELECT take::BIGINT AS take, frame, round(step, 5) + 0.0 AS step_deg, glitch FROM gl")
def w11_step_angle(spark, folder):
    return stepped(spark, folder).select(long("take").alias("take"), "frame", r6("step_deg", 5).alias("step_deg"), "glitch")


@query(
    "w12_integrate",
    f"WITH {SERIES} SELECT take, frame, round(sum(x * 0.01) OVER (PARTITION BY take ORDER BY frame), 6) + 0.0 AS position FROM s",
)
def w12_integrate(spark, folder):
    out = windows.integrate(series(spark, folder), keys=["take"], frame="frame", rate=F.col("x") * 0.01, out="position")
    return out.select("take", "frame", r6("position").alias("position"))


ISLANDS = f"""{QUATS}, u AS (SELECT *, vec_id % 5 > 0 AS ok FROM q), {RUNS.format(flag='ok', src='u')},
il AS (SELECT r.take, r.start, r.stop, r.length, lag(l.w) OVER o AS pw, lag(l.x) OVER o AS px, lag(l.y) OVER o AS py, lag(l.z) OVER o AS pz,
       f.w AS nw, f.x AS nx, f.y AS ny, f.z AS nz FROM r JOIN u f ON f.take = r.take AND f.frame = r.start
       JOIN u l ON l.take = r.take AND l.frame = r.stop - 1 WHERE r.state WINDOW o AS (PARTITION BY r.take ORDER BY r.start)),
rel AS (SELECT take, start, stop, length, {rel_sql('p', 'n')} FROM il),
tw AS (SELECT *, degrees(2 * atan2(abs(ry), abs(rw))) AS twist FROM rel),
pa AS (SELECT *, coalesce(twist > 60.0, false) AS crossed, (sum(CASE WHEN twist > 60.0 THEN 1 ELSE 0 END) OVER (PARTITION BY take ORDER BY start) % 2)::BIGINT AS parity FROM tw)"""


def islands(spark, folder):
    """Solved islands with the rotation of their first and last frame, and the parity of twisted gaps."""
    q = quats(spark, folder).withColumn("ok", F.col("vec_id") % 5 > 0)
    found = runs.runs(q, keys=["take"], frame="frame", state=F.col("ok")).where("state").drop("state")
    first = q.select("take", F.col("frame").alias("start"), F.col("q").alias("first_q"))
    last = q.select("take", (F.col("frame") + 1).alias("stop"), F.col("q").alias("last_q"))
    ends = found.join(first, ["take", "start"]).join(last, ["take", "stop"])
    twist = Q.twist_y_deg(Q.multiply(Q.conjugate(F.col("before")["last_q"]), F.col("first_q")))
    return runs.island_parity(ends, keys=["take"], start="start", crossing=twist > 60.0)


@query("w13_island_parity", f"WITH {ISLANDS} SELECT take::BIGINT AS take, start, stop, crossed, parity FROM pa")
def w13_island_parity(spark, folder):
    return islands(spark, folder).select(long("take").alias("take"), "start", "stop", "crossed", "parity")


@query(
    "a33_parity_vote",
    f"""WITH {ISLANDS}, v AS (SELECT take, coalesce(sum(length) FILTER (parity = 0), 0)::BIGINT AS even,
      coalesce(sum(length) FILTER (parity = 1), 0)::BIGINT AS odd FROM pa GROUP BY take)
    SELECT take::BIGINT AS take, even, odd, CASE WHEN even <= odd THEN 0 ELSE 1 END::BIGINT AS minority,
      round(least(even, odd) / (even + odd), 6) + 0.0 AS fraction,
      least(even, odd) > 0 AND least(even, odd) / (even + odd) > 0.4 AS refused FROM v""",
)
def a33_parity_vote(spark, folder):
    out = runs.parity_vote(islands(spark, folder), keys=["take"], max_fraction=0.4)
    return out.select(
        long("take").alias("take"), "even", "odd", "minority", r6("fraction").alias("fraction"), "refused"
    )


@query(
    "w14_trim_outer",
    f"""WITH {GAPPY_SQL}, b AS (SELECT take, min(frame) FILTER (ok) AS first_valid, max(frame) FILTER (ok) AS last_valid FROM g GROUP BY take)
    SELECT take, frame, first_valid, last_valid, ok FROM g JOIN b USING (take) WHERE frame BETWEEN first_valid AND last_valid""",
)
def w14_trim_outer(spark, folder):
    out = runs.trim_outer(gappy(spark, folder), keys=["take"], frame="frame", valid=F.col("ok"))
    return out.select("take", "frame", "first_valid", "last_valid", "ok")


@query(
    "w15_accept_windows",
    f"""WITH {HERMITE}, w AS (SELECT take, frame AS start, count(*) OVER a AS n, count(*) FILTER (status = 'UNAVAILABLE') OVER a AS un,
      count(*) FILTER (status = 'INTERPOLATED') OVER a AS it FROM filled WINDOW a AS (PARTITION BY take ORDER BY frame ROWS BETWEEN CURRENT ROW AND 9 FOLLOWING))
    SELECT take, start, round(it / 10.0, 6) + 0.0 AS fraction, un > 0 AS has_unavailable, un = 0 AND it / 10.0 <= 0.3 AS accepted
    FROM w WHERE start % 5 = 0 AND n = 10""",
)
def w15_accept_windows(spark, folder):
    out = runs.accept_windows(
        filled(spark, folder), keys=["take"], frame="frame", status="status", window=10, stride=5, max_fraction=0.3
    )
    return out.withColumn("fraction", r6("fraction"))


USABLE = f"{SERIES}, u AS (SELECT *, site <> 'error' AS ok FROM s), {RUNS.format(flag='ok', src='u')}"


@query(
    "w16_overlapped_windows",
    f"""WITH {USABLE}, st AS (SELECT take, start + unnest(generate_series(0, (length - 8) // 4)) * 4 AS ws FROM r WHERE state AND length >= 8)
    SELECT take, ws + o.o AS frame, ws AS window_start, o.o AS window_offset FROM st, (SELECT unnest(generate_series(2, 5)) AS o) o""",
)
def w16_overlapped_windows(spark, folder):
    out = runs.overlapped_windows(
        series(spark, folder), keys=["take"], frame="frame", good=F.col("site") != "error", window=8, stride=4, keep_from=2
    )
    return out.select("take", "frame", "window_start", "window_offset")


@query(
    "w17_edge_status",
    f"""WITH {USABLE}, b AS (SELECT * FROM r WHERE state) SELECT u.take, u.frame, coalesce(u.frame - b.start >= 2 AND b.stop - u.frame > 2, false) AS inside
    FROM u LEFT JOIN b ON u.take = b.take AND u.frame >= b.start AND u.frame < b.stop""",
)
def w17_edge_status(spark, folder):
    out = runs.edge_status(
        series(spark, folder), keys=["take"], frame="frame", solved=F.col("site") != "error", trim=2
    )
    return out.select("take", "frame", "inside")


@query(
    "w17_long_enough_runs",
    f"WITH {USABLE} SELECT take, start, stop, length, greatest(length - 4, 0) AS usable FROM r WHERE state AND length >= 3",
)
def w17_long_enough_runs(spark, folder):
    return runs.long_enough_runs(
        series(spark, folder), keys=["take"], frame="frame", solved=F.col("site") != "error", minimum=3, trim=2
    )


@query("w18_zero_phase_lowpass")
def w18_zero_phase_lowpass(spark, folder):
    out = gaps.zero_phase_lowpass(
        series(spark, folder), keys=["take"], frame="frame", value="x", order=4, cutoff_hz=12.0, rate_hz=100.0
    )
    return out.select("take", "frame", r6("filtered").alias("filtered"))


SG_WINDOW, SG_DEGREE, SG_DERIVATIVE = 5, 3, 2
SG_ROWS = windows.polynomial_weights(SG_WINDOW, SG_DEGREE, SG_DERIVATIVE, 0.01)
SG_VALUES = ", ".join(f"({p}, {j}, {weight!r}::DOUBLE)" for p, row in enumerate(SG_ROWS) for j, weight in enumerate(row))


@query(
    "w19_polynomial_smooth",
    f"""WITH {GAPPY_SQL}, {RUNS.format(flag='ok', src='g')}, k(p, j, weight) AS (VALUES {SG_VALUES}),
    f AS (SELECT g.take, g.frame, greatest(r.start, least(g.frame - 2, r.stop - 5)) AS first FROM g JOIN r ON r.state AND r.length >= 5
          AND g.take = r.take AND g.frame >= r.start AND g.frame < r.stop),
    v AS (SELECT f.take, f.frame, sum(g.x * k.weight) AS v FROM f JOIN k ON k.p = f.frame - f.first JOIN g ON g.take = f.take AND g.frame = f.first + k.j GROUP BY ALL)
    SELECT g.take, g.frame, round(v.v, 2) + 0.0 AS smooth FROM g LEFT JOIN v ON g.take = v.take AND g.frame = v.frame""",
)
def w19_polynomial_smooth(spark, folder):
    out = windows.polynomial_smooth(
        gappy(spark, folder), keys=["take"], frame="frame", value="x",
        window=SG_WINDOW, degree=SG_DEGREE, derivative=SG_DERIVATIVE, dt_s=0.01,
    )
    return out.select("take", "frame", r6("smooth", 2).alias("smooth"))


@query(
    "w20_resample_linear",
    f"""WITH {SERIES}, n AS (SELECT take, count(*) AS n FROM s GROUP BY take),
    gr AS (SELECT take, n, unnest(generate_series(0, floor((n - 1) / 120.0 * 100.0 + 1e-9)::BIGINT)) AS g FROM n),
    b AS (SELECT *, least(floor(g * 1.2 + 1e-9)::BIGINT, n - 1) AS f, g * 1.2 AS p FROM gr)
    SELECT b.take, b.g AS frame, round(s.x + coalesce((e.x - s.x) * greatest(0, p - f), 0), 5) + 0.0 AS x
    FROM b JOIN s ON s.take = b.take AND s.frame = f LEFT JOIN s e ON e.take = b.take AND e.frame = f + 1""",
)
def w20_resample_linear(spark, folder):
    out = windows.resample(series(spark, folder), keys=["take"], frame="frame", src_hz=120.0, dst_hz=100.0, vectors=["x"])
    return out.select("take", "frame", r6("x", 5).alias("x"))


@query(
    "w20_resample_rotations",
    f"""WITH {QUATS}, n AS (SELECT take, count(*) AS n FROM q GROUP BY take),
    gr AS (SELECT take, n, unnest(generate_series(0, floor((n - 1) / 60.0 * 100.0 + 1e-9)::BIGINT)) AS g FROM n),
    b AS (SELECT *, least(floor(g * 0.6 + 1e-9)::BIGINT, n - 1) AS f, g * 0.6 AS p FROM gr),
    j AS (SELECT b.take, b.g, greatest(0.0, p - f) AS t, {', '.join(f's.{c} AS p{c}, coalesce(e.{c}, s.{c}) AS n{c}' for c in 'wxyz')}
      FROM b JOIN q s ON s.take = b.take AND s.frame = f LEFT JOIN q e ON e.take = b.take AND e.frame = f + 1),
    d AS (SELECT *, pw*nw + px*nx + py*ny + pz*nz AS raw FROM j),
    a AS (SELECT *, CASE WHEN raw < 0 THEN -1.0::DOUBLE ELSE 1.0::DOUBLE END AS sg, acos(least(1.0, abs(raw))) AS th, abs(raw) > 1 - 1e-9 AS near FROM d),
    m AS (SELECT *, CASE WHEN near THEN 1 - t ELSE sin((1 - t) * th) / sin(th) END AS wa, sg * CASE WHEN near THEN t ELSE sin(t * th) / sin(th) END AS wb FROM a),
    o AS (SELECT take, g, {', '.join(f'wa*p{c} + wb*n{c} AS {c}' for c in 'wxyz')} FROM m)
    SELECT take::BIGINT AS take, g AS frame, {', '.join(f'round({c} / sqrt(w*w + x*x + y*y + z*z), 5) + 0.0 AS {c}' for c in 'wxyz')} FROM o""",
)
def w20_resample_rotations(spark, folder):
    out = windows.resample(quats(spark, folder), keys=["take"], frame="frame", src_hz=60.0, dst_hz=100.0, rotations=["q"])
    return out.select(long("take").alias("take"), "frame", *[r6(F.col("q")[c], 5).alias(c) for c in "wxyz"])


@query(
    "w21_thin",
    f"""WITH {SERIES}, n AS (SELECT take, greatest(1, round_even(count(*) / 20, 0))::BIGINT AS step FROM s GROUP BY take)
    SELECT take, frame, step FROM s JOIN n USING (take) WHERE frame % step = 0""",
)
def w21_thin(spark, folder):
    return windows.thin(series(spark, folder), keys=["take"], frame="frame", about=20).select("take", "frame", "step")


@query(
    "w21_evenly_spaced",
    f"""WITH {SERIES}, l AS (SELECT take, max(frame) AS l FROM s GROUP BY take),
    k AS (SELECT DISTINCT take, (i * l) // 9 AS frame FROM l, (SELECT unnest(generate_series(0, 9)) AS i))
    SELECT s.take, s.frame, s.event_id FROM s JOIN k ON s.take = k.take AND s.frame = k.frame""",
)
def w21_evenly_spaced(spark, folder):
    return windows.evenly_spaced(series(spark, folder), keys=["take"], frame="frame", count=10).select(
        "take", "frame", "event_id"
    )


@query(
    "w22_static_rows",
    f"""WITH {SERIES}, c AS (SELECT take, quantile_cont(x, 0.2) AS cut FROM s GROUP BY take)
    SELECT take, frame, x < cut AS static FROM s JOIN c USING (take)""",
)
def w22_static_rows(spark, folder):
    out = windows.lowest_share(series(spark, folder), keys=["take"], frame="frame", value="x", share=0.2)
    return out.select("take", "frame", "static")


@query(
    "w23_first_per_group",
    """SELECT source, doc_id, lang FROM (SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id) AS k FROM documents) WHERE k <= 7""",
)
def w23_first_per_group(spark, folder):
    docs = table(spark, folder, "documents").select("source", "doc_id", "lang")
    return windows.first_per_group(docs, group=["source"], order=["doc_id"], cap=7)


@query(
    "w27_nested_caps",
    """WITH m AS (SELECT DISTINCT c_nationkey, c_name FROM customer), g AS (SELECT DISTINCT c_nationkey FROM customer ORDER BY 1 LIMIT 6)
    SELECT c_nationkey::BIGINT AS nation, c_name AS member FROM (SELECT *, row_number() OVER (PARTITION BY c_nationkey ORDER BY c_name) AS k FROM m
      WHERE c_nationkey IN (SELECT c_nationkey FROM g)) WHERE k <= 4""",
)
def w27_nested_caps(spark, folder):
    members = table(spark, folder, "customer").select(long("c_nationkey").alias("nation"), F.col("c_name").alias("member"))
    return windows.nested_caps(members, group="nation", member="member", max_groups=6, max_members=4)


@query(
    "w27_missing_names",
    """WITH m AS (SELECT DISTINCT c_nationkey, c_name FROM customer),
    kept AS (SELECT c_nationkey, c_name FROM (SELECT *, row_number() OVER (PARTITION BY c_nationkey ORDER BY c_name) AS k FROM m
      WHERE c_nationkey IN (SELECT DISTINCT c_nationkey FROM customer ORDER BY 1 LIMIT 6)) WHERE k <= 4),
    asked AS (SELECT DISTINCT o_custkey, 'Customer#' || lpad(((o_custkey * 7) % 2000)::VARCHAR, 9, '0') AS member FROM orders)
    SELECT DISTINCT member, CASE WHEN member NOT IN (SELECT c_name FROM m) THEN 'unknown' ELSE 'dropped' END AS problem
    FROM asked WHERE member NOT IN (SELECT c_name FROM kept)""",
)
def w27_missing_names(spark, folder):
    members = table(spark, folder, "customer").select(long("c_nationkey").alias("nation"), F.col("c_name").alias("member"))
    kept = windows.nested_caps(members, group="nation", member="member", max_groups=6, max_members=4)
    number = F.lpad(((F.col("o_custkey") * 7) % 2000).cast("string"), 9, "0")
    asked = table(spark, folder, "orders").select(F.concat(F.lit("Customer#"), number).alias("member"))
    return windows.missing_names(asked, kept, members, on=["member"])


def stride_points(spark, folder):
    """Mean time and median value of each segment between rising edges."""
    return exact_quantiles(
        segmented(spark, folder), keys=["take", "segment"], value="x", probs={"y": 0.5}, aggs=[F.avg("t_s").alias("t")],
        sized_by=raw_takes(spark, folder),
    )


STRIDES = f"{SEGMENTS}, sp AS (SELECT take, segment, avg(t_s) AS t, quantile_cont(x, 0.5) AS y FROM seg GROUP BY take, segment)"
SLOPES = f"""{STRIDES}, pr AS (SELECT a.take, (b.y - a.y) / (b.t - a.t) AS s FROM sp a JOIN sp b ON a.take = b.take AND a.segment < b.segment WHERE a.t <> b.t),
ts AS (SELECT take, quantile_cont(s, 0.5) AS slope FROM pr GROUP BY take),
ls AS (SELECT take, regr_slope(x, t_s) AS slope FROM s GROUP BY take),
sl AS (SELECT take, n, CASE WHEN n >= 2 THEN ts.slope ELSE ls.slope END AS slope FROM (SELECT take, count(*) AS n FROM sp GROUP BY take)
       JOIN ls USING (take) LEFT JOIN ts USING (take))"""


def slopes(spark, folder):
    return stats.robust_slopes(
        stride_points(spark, folder), series(spark, folder), keys=["take"], x="t", y="y", row_x="t_s", row_y="x"
    )


@query("a24_robust_slope", f"WITH {SLOPES} SELECT take, n AS segments, round(slope * 1e6, 3) + 0.0 AS slope_e6 FROM sl")
def a24_robust_slope(spark, folder):
    return slopes(spark, folder).select("take", "segments", r6(F.col("slope") * 1e6, 3).alias("slope_e6"))


@query(
    "w26_remove_drift",
    f"WITH {SLOPES} SELECT take, frame, round(x - slope * t_s, 4) + 0.0 AS level FROM s JOIN sl USING (take)",
)
def w26_remove_drift(spark, folder):
    out = windows.remove_linear_drift(
        series(spark, folder), keys=["take"], frame="frame", time="t_s", value="x", slopes=slopes(spark, folder), out="level"
    )
    return out.select("take", "frame", r6("level", 4).alias("level"))


@query(
    "w26_centre_on_median",
    f"WITH {SERIES}, m AS (SELECT take, quantile_cont(x, 0.5) AS m FROM s GROUP BY take) SELECT take, frame, round(x - m, 6) + 0.0 AS level FROM s JOIN m USING (take)",
)
def w26_centre_on_median(spark, folder):
    out = windows.centre_on_median(series(spark, folder), keys=["take"], frame="frame", value="x", out="level")
    return out.select("take", "frame", r6("level").alias("level"))
