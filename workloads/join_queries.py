"""As-of, interval, reconciliation and lookup joins."""

from __future__ import annotations

from pyspark.sql import functions as F

from motionframes.functions import text as X
from motionframes.operators import joins
from motionframes.operators.blocks import dealt, task_count
from motionframes.plans import quality

from .base import HOUR_US, SERIES, long, query, r6, series, table

SIDES = """l AS (SELECT user_id AS take, event_id, epoch_us(ts) AS t FROM events WHERE event_type = 'view'),
rt AS (SELECT user_id AS take, event_id AS rid, epoch_us(ts) AS t, value FROM events WHERE event_type = 'click'),
tol AS (SELECT take, quantile_cont(d, 0.5) / 2 AS tol FROM (SELECT take, t - lag(t) OVER (PARTITION BY take ORDER BY t, rid) AS d FROM rt) GROUP BY take)"""


@query(
    "j2_nearest_in_time",
    f"""WITH {SIDES}, c AS (SELECT l.take, l.event_id, rid, value, abs(l.t - rt.t) AS d, tol,
      row_number() OVER (PARTITION BY l.take, l.event_id ORDER BY abs(l.t - rt.t), rt.t) AS k FROM l LEFT JOIN rt ON l.take = rt.take LEFT JOIN tol ON l.take = tol.take)
    SELECT take, event_id, CASE WHEN d <= tol THEN rid END AS matched, CASE WHEN d <= tol THEN round(value, 6) + 0.0 END AS value FROM c WHERE k = 1""",
)
def j2_nearest_in_time(spark, folder):
    s = series(spark, folder)
    left = s.where("site = 'view'").select("take", "t_us", "event_id")
    right = s.where("site = 'click'").select("take", "t_us", "event_id", F.col("event_id").alias("matched"), F.col("x").alias("value"))
    tolerance = joins.half_median_step(right, keys=["take"], time="t_us", id_="event_id")
    out = joins.nearest_in_time(
        left, right, keys=["take"], time="t_us", id_="event_id", values=["matched", "value"], tolerance=tolerance
    )
    return out.select("take", "event_id", "matched", r6("value").alias("value"))


@query(
    "j3_misaligned",
    f"""WITH {SERIES}, e AS (SELECT take, event_id, frame * 0.01 + CASE WHEN event_id % 9 = 0 THEN 0.004 WHEN event_id % 31 = 0 THEN 90.0 ELSE 0.0 END AS t FROM s),
    j AS (SELECT e.take, e.event_id, round_even(e.t * 100.0, 0)::BIGINT AS frame, abs(e.t - g.frame * 0.01) AS off, g.frame AS gf
      FROM e LEFT JOIN s g ON g.take = e.take AND g.frame = round_even(e.t * 100.0, 0)::BIGINT)
    SELECT take, event_id, frame, round(off, 6) + 0.0 AS off_s FROM j WHERE gf IS NULL OR off > 0.002""",
)
def j3_misaligned(spark, folder):
    s = series(spark, folder)
    shift = F.when(F.col("event_id") % 9 == 0, 0.004).when(F.col("event_id") % 31 == 0, 90.0).otherwise(0.0)
    wanted = s.select("take", "event_id", (F.col("frame") * 0.01 + shift).alias("t"))
    grid = s.select("take", "frame", (F.col("frame") * 0.01).alias("t"))
    out = joins.misaligned(wanted, grid, keys=["take"], time="t", rate_hz=100.0, tolerance=0.002)
    return out.select("take", "event_id", "frame", r6("off_s").alias("off_s"))


@query(
    "j4_missing_and_orphans",
    """SELECT doc_id AS id, 'missing' AS problem FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)
    UNION ALL SELECT DISTINCT doc_id, 'orphan' FROM labels WHERE doc_id NOT IN (SELECT doc_id FROM documents WHERE n_chars > 500)
      AND doc_id NOT IN (SELECT doc_id FROM documents WHERE n_chars <= 500)""",
)
def j4_missing_and_orphans(spark, folder):
    index = table(spark, folder, "documents").select(F.col("doc_id").alias("id"))
    return joins.missing_and_orphans(index, table(spark, folder, "labels").select(F.col("doc_id").alias("id")), on=["id"])


@query(
    "j5_pairs",
    """SELECT o_orderkey AS id, CASE WHEN o_orderkey IN (SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'R') THEN 'pair' ELSE 'missing' END AS state
    FROM orders WHERE o_orderstatus = 'F'""",
)
def j5_pairs(spark, folder):
    orders, lines = table(spark, folder, "orders"), table(spark, folder, "lineitem")
    tasks = max(task_count(orders), task_count(lines))
    fits = dealt(orders.where("o_orderstatus = 'F'").select(F.col("o_orderkey").alias("id")), tasks, "id")
    plates = dealt(lines.where("l_returnflag = 'R'").select(F.col("l_orderkey").alias("id")), tasks, "id")
    paired = fits.join(plates.distinct().withColumn("state", F.lit("pair")), "id", "left")
    return paired.withColumn("state", F.coalesce("state", F.lit("missing")))


@query(
    "j6_within_intervals",
    f"""WITH {SERIES}, g AS (SELECT take, t_us // 86400000000 AS day, min(t_us) / 1e6 AS start, max(t_us) / 1e6 AS stop FROM s GROUP BY ALL)
    SELECT s.take, s.event_id, g.day AS label FROM s JOIN g ON s.take = g.take AND s.t_us / 1e6 >= g.start AND s.t_us / 1e6 < g.stop""",
)
def j6_within_intervals(spark, folder):
    s = series(spark, folder).withColumn("at", F.col("t_us") / 1e6)
    labels = s.groupBy("take", F.expr(f"t_us div {24 * HOUR_US}L").alias("label")).agg(F.min("at").alias("start"), F.max("at").alias("stop"))
    out = joins.within_intervals(
        s.select("take", "event_id", "at"), labels, keys=["take"], time="at", start="start", stop="stop"
    )
    return out.select("take", "event_id", "label")


LISTS = """li AS (SELECT source || '/' || lang || '/' || doc_id || '.txt' AS name, sha256(text) AS d, doc_id FROM documents),
de AS (SELECT name, CASE WHEN doc_id % 11 = 0 THEN sha256(name) ELSE d END AS d FROM li WHERE doc_id % 3 <> 0),
og AS (SELECT name, CASE WHEN doc_id % 7 = 0 THEN sha256(name) ELSE d END AS d FROM li WHERE doc_id % 5 <> 0)"""
STATUS = """CASE WHEN de.d = li.d THEN 'present' WHEN de.d IS NOT NULL THEN 'conflict' WHEN og.d IS NULL THEN 'unavailable' WHEN og.d = li.d THEN 'copied' ELSE 'corrupt' END"""


def lists(spark, folder):
    """A checksum list with a destination and an origin that lack and differ in some files."""
    d = table(spark, folder, "documents")
    path = F.concat("source", F.lit("/"), "lang", F.lit("/"), F.col("doc_id").cast("string"), F.lit(".txt"))
    listed = d.select(path.alias("name"), F.sha2("text", 256).alias("sha"), "doc_id")
    wrong = lambda k: F.when(F.col("doc_id") % k == 0, F.sha2("name", 256)).otherwise(F.col("sha")).alias("sha")
    there = listed.where("doc_id % 3 <> 0").select("name", wrong(11))
    origin = listed.where("doc_id % 5 <> 0").select("name", wrong(7))
    return listed.drop("doc_id"), there, origin


@query("j10_reconcile", f"WITH {LISTS} SELECT li.name, {STATUS} AS status FROM li LEFT JOIN de USING (name) LEFT JOIN og USING (name)")
def j10_reconcile(spark, folder):
    return joins.reconcile(*lists(spark, folder), name="name", digest="sha", verify_only=False)


@query(
    "j10_exit_code",
    f"""WITH {LISTS}, st AS (SELECT CASE WHEN de.d = li.d THEN 'present' WHEN de.d IS NOT NULL THEN 'conflict' ELSE 'missing' END AS s FROM li LEFT JOIN de USING (name))
    SELECT count(*) FILTER (s = 'present') AS present, 0::BIGINT AS copied, count(*) FILTER (s = 'missing') AS missing, count(*) FILTER (s = 'conflict') AS conflict,
      0::BIGINT AS unavailable, 0::BIGINT AS corrupt, 1 AS exit_code FROM st""",
)
def j10_exit_code(spark, folder):
    statuses = joins.reconcile(*lists(spark, folder), name="name", digest="sha", verify_only=True)
    return joins.staging_exit(statuses, verify_only=True)


PROFILES = "pf AS (SELECT source, k, CASE WHEN k % 4 = 1 THEN 'pending' ELSE 'ready' END AS state FROM (SELECT DISTINCT source, ascii(right(source, 1))::BIGINT AS k FROM documents) WHERE k % 5 <> 0)"


def profiles(spark, folder):
    """A profile table over the sources, some pending and some without one."""
    names = table(spark, folder, "documents").select("source").distinct()
    state = F.when(F.col("k") % 4 == 1, "pending").otherwise("ready")
    numbered = names.withColumn("k", long(F.ascii(F.right("source", F.lit(1)))))
    return numbered.where("k % 5 <> 0").withColumn("state", state)


@query("j14_resolved", f"WITH {PROFILES} SELECT doc_id, source, k FROM documents JOIN pf USING (source) WHERE state = 'ready'")
def j14_resolved(spark, folder):
    good, _ = joins.resolve(table(spark, folder, "documents").select("doc_id", "source"), profiles(spark, folder), on="source", status="state")
    return good.select("doc_id", "source", "k")


@query(
    "j14_rejected",
    f"""WITH {PROFILES} SELECT DISTINCT d.source, CASE WHEN pf.source IS NULL THEN 'unknown' ELSE 'pending' END AS reason
    FROM documents d LEFT JOIN pf USING (source) WHERE pf.source IS NULL OR state = 'pending'""",
)
def j14_rejected(spark, folder):
    _, bad = joins.resolve(table(spark, folder, "documents").select("doc_id", "source"), profiles(spark, folder), on="source", status="state")
    return bad


@query(
    "j15_leaking_groups",
    """WITH d AS (SELECT regexp_replace(source || CASE WHEN doc_id % 2 = 0 THEN '_no_Arm' ELSE '_with_Arm' END, '[_-](no|with)[_-]?[A-Za-z]+$', '') || '/' || (doc_id % 3) AS grp,
      quality AS split FROM documents JOIN labels USING (doc_id)) SELECT grp, count(DISTINCT split) AS splits FROM d GROUP BY grp HAVING count(DISTINCT split) > 1""",
)
def j15_leaking_groups(spark, folder):
    d = table(spark, folder, "documents").join(table(spark, folder, "labels"), "doc_id")
    variant = F.when(F.col("doc_id") % 2 == 0, "_no_Arm").otherwise("_with_Arm")
    key = joins.group_key(F.concat("source", variant), (F.col("doc_id") % 3).cast("string"))
    return joins.leaking_groups(d.select(key.alias("grp"), F.col("quality").alias("split")), key="grp", split="split")


@query(
    "j16_source_references",
    """WITH m AS (SELECT conv_id || '/' || turn AS take, 'raw/' || role || '/' || (conv_id % 40) AS p, sha256(role) AS s, turn FROM conversations)
    SELECT p AS source_path, s AS sha256, string_agg(DISTINCT CASE WHEN turn = 0 THEN 'source' ELSE 'inputs.pose' END, ',' ORDER BY CASE WHEN turn = 0 THEN 'source' ELSE 'inputs.pose' END) AS fields,
      count(DISTINCT take) AS takes FROM m GROUP BY p, s""",
)
def j16_source_references(spark, folder):
    c = table(spark, folder, "conversations")
    path = F.concat(F.lit("raw/"), "role", F.lit("/"), (F.col("conv_id") % 40).cast("string"))
    ref = F.struct(path.alias("path"), F.sha2("role", 256).alias("sha256"))
    doc = F.when(F.col("turn") == 0, F.to_json(F.struct(ref.alias("source")))).otherwise(
        F.to_json(F.struct(F.struct(ref.alias("pose")).alias("inputs")))
    )
    leaves = X.json_leaves(c.select(F.concat_ws("/", "conv_id", "turn").alias("take"), doc.alias("doc")), "take", document=F.col("doc"))
    return joins.source_references(leaves, take="take")


@query(
    "j17_files_by_stage",
    """WITH sel(owner, stage) AS (VALUES ('en', 'corpus'), ('en', 'bundle'), ('fr', 'bundle'), ('de', 'corpus')),
    f AS (SELECT doc_id, CASE WHEN doc_id % 13 = 0 THEN NULL ELSE lang END AS o FROM documents)
    SELECT doc_id, CASE WHEN o IS NULL THEN 'bundle,corpus' ELSE (SELECT string_agg(stage, ',' ORDER BY stage) FROM sel WHERE owner = o) END AS stages
    FROM f WHERE o IS NULL OR o IN (SELECT owner FROM sel)""",
)
def j17_files_by_stage(spark, folder):
    chosen = [("en", "corpus"), ("en", "bundle"), ("fr", "bundle"), ("de", "corpus")]
    selection = spark.createDataFrame(chosen, "owner string, stage string")
    files = table(spark, folder, "documents").select("doc_id", "lang")
    owner = F.when(F.col("doc_id") % 13 != 0, F.col("lang"))
    return joins.files_by_stage(files, selection, owner=owner).select("doc_id", "stages")


# Declared targets: name, own joint, fallback joint.
TARGETS = (("root", "AUTOMOBILE", "BUILDING"), ("arm", "FURNITURE", "MACHINERY"), ("leg", "NOWHERE", "HOUSEHOLD"), ("tail", "NOWHERE", "NEVER"))
TARGET_ROWS = ", ".join(f"('{a}', '{b}', '{c}')" for a, b, c in TARGETS)


@query(
    "j20_correspondence",
    f"""WITH t(target, joint, fallback) AS (VALUES {TARGET_ROWS}), d AS (SELECT DISTINCT c_custkey % 300 AS skeleton, c_mktsegment AS joint FROM customer)
    SELECT skeleton, target, CASE WHEN (skeleton, t.joint) IN (SELECT skeleton, joint FROM d) THEN 'measured'
      WHEN (skeleton, fallback) IN (SELECT skeleton, joint FROM d) THEN 'derived' ELSE 'absent' END AS provenance FROM (SELECT DISTINCT skeleton FROM d), t""",
)
def j20_correspondence(spark, folder):
    declared = table(spark, folder, "customer").select((F.col("c_custkey") % 300).alias("skeleton"), F.col("c_mktsegment").alias("joint"))
    return joins.correspondence(declared, TARGETS, skeleton="skeleton")


@query(
    "p12_restrict_to_driven",
    """SELECT l_orderkey, l_linenumber::BIGINT AS l_linenumber, CASE WHEN l_suppkey IN (SELECT s_suppkey FROM supplier WHERE s_acctbal > 3000) THEN l_shipmode ELSE 'absent' END AS provenance
    FROM (SELECT *, l_returnflag AS l_shipmode FROM lineitem)""",
)
def p12_restrict_to_driven(spark, folder):
    rows = table(spark, folder, "lineitem").select("l_orderkey", long("l_linenumber").alias("l_linenumber"), F.col("l_suppkey").alias("body_id"), F.col("l_returnflag").alias("provenance"))
    driven = table(spark, folder, "supplier").where("s_acctbal > 3000").select(F.col("s_suppkey").alias("body"))
    return joins.restrict_to_driven(rows, driven, body="body_id", provenance="provenance").drop("body_id")


@query(
    "p12_undriven_summary",
    """SELECT l_suppkey AS body, count(*) AS withheld FROM lineitem WHERE l_suppkey NOT IN (SELECT s_suppkey FROM supplier WHERE s_acctbal > 3000) GROUP BY l_suppkey""",
)
def p12_undriven_summary(spark, folder):
    driven = table(spark, folder, "supplier").where("s_acctbal > 3000").select(F.col("s_suppkey").alias("body"))
    rows = table(spark, folder, "lineitem").select(F.col("l_suppkey").alias("body"))
    return rows.join(driven, "body", "left_anti").groupBy("body").agg(F.count(F.lit(1)).alias("withheld"))


@query(
    "p20_site_sources",
    """SELECT c_custkey, c_mktsegment AS site, coalesce(p <> 'absent', false) AS backed, CASE WHEN p <> 'absent' THEN p END AS label FROM customer
    LEFT JOIN (VALUES ('AUTOMOBILE', 'measured'), ('BUILDING', 'absent'), ('MACHINERY', 'derived')) AS d(seg, p) ON seg = c_mktsegment""",
)
def p20_site_sources(spark, folder):
    drivers = spark.createDataFrame(
        [("AUTOMOBILE", "measured"), ("BUILDING", "absent"), ("MACHINERY", "derived")], "site string, provenance string"
    )
    rows = table(spark, folder, "customer").select("c_custkey", F.col("c_mktsegment").alias("site"))
    return quality.site_sources(rows, drivers, site="site")
