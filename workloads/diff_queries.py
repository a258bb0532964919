"""Snapshot differences, registration and journals."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from motionframes.functions import text as X
from motionframes.operators import catalog, diff, sets
from motionframes.operators.blocks import dense_frames
from motionframes.session import checkpoint_dir

from .base import long, query, table

FIELDS = ["asset_id", "role", "relative_path", "sha256", "bytes", "source", "spec_id", "spec_version"]


def assets_v1(spark, folder):
    """Orders as assets: a digest over the row, a path below one of five folders."""
    o = table(spark, folder, "orders")
    key = F.col("o_orderkey").cast("string")
    return o.select(
        F.concat(F.lit("a:"), key).alias("asset_id"),
        F.col("o_orderstatus").alias("role"),
        F.concat(F.lit("set"), (F.col("o_orderkey") % 5).cast("string"), F.lit("/"), key).alias("relative_path"),
        F.sha2(F.concat_ws("|", key, F.col("o_custkey").cast("string"), "o_orderpriority"), 256).alias("sha256"),
        F.col("o_custkey").alias("bytes"),
        F.concat(F.lit("src"), (F.col("o_orderkey") % 5).cast("string")).alias("source"),
        F.lit("spec").alias("spec_id"),
        F.concat(F.lit("v"), (F.col("o_orderkey") % 3).cast("string")).alias("spec_version"),
        F.col("o_orderkey").alias("idx"),
    )


def assets_v2(spark, folder):
    """A later snapshot: some assets gone, some changed, some new."""
    v1 = assets_v1(spark, folder)
    kept = v1.where("idx % 11 <> 0").withColumn("sha256", F.expr("if(idx % 13 = 0, sha2(sha256, 256), sha256)"))
    new = v1.where("idx % 17 = 0").withColumns(
        {"asset_id": F.concat(F.lit("b:"), F.col("idx").cast("string")), "relative_path": F.concat("relative_path", F.lit(".new"))}
    )
    return kept.unionByName(new)


ASSETS = """v1 AS (SELECT 'a:' || o_orderkey AS asset_id, o_orderstatus AS role, 'set' || (o_orderkey % 5) || '/' || o_orderkey AS relative_path,
  sha256(o_orderkey || '|' || o_custkey || '|' || o_orderpriority) AS sha256, o_custkey AS bytes, 'src' || (o_orderkey % 5) AS source, 'spec' AS spec_id,
  'v' || (o_orderkey % 3) AS spec_version, o_orderkey AS idx FROM orders),
v2 AS (SELECT * REPLACE (CASE WHEN idx % 13 = 0 THEN sha256(sha256) ELSE sha256 END AS sha256) FROM v1 WHERE idx % 11 <> 0
  UNION ALL SELECT * REPLACE ('b:' || idx AS asset_id, relative_path || '.new' AS relative_path) FROM v1 WHERE idx % 17 = 0)"""


def snapshot_diff(spark, folder):
    return diff.compare_snapshots(assets_v1(spark, folder), assets_v2(spark, folder), keys=["asset_id"], values=["sha256", "bytes", "relative_path"])


DIFF = f"""{ASSETS}, df AS (SELECT coalesce(v1.asset_id, v2.asset_id) AS asset_id, CASE WHEN v2.asset_id IS NULL THEN 'only_a' WHEN v1.asset_id IS NULL THEN 'only_b'
  WHEN v1.sha256 = v2.sha256 AND v1.bytes = v2.bytes AND v1.relative_path = v2.relative_path THEN 'same' ELSE 'differs' END AS verdict, v1.sha256 AS sa, v2.sha256 AS sb,
  coalesce(v1.idx, v2.idx) AS idx, coalesce(v1.source, v2.source) AS source FROM v1 FULL JOIN v2 ON v1.asset_id = v2.asset_id)"""


@query("j7_snapshot_diff", f"WITH {DIFF} SELECT asset_id, verdict FROM df")
def j7_snapshot_diff(spark, folder):
    return snapshot_diff(spark, folder).select("asset_id", "verdict")


@query("j21_inventory_diff", f"WITH {DIFF} SELECT asset_id, 'sha256' AS value, sa AS old, sb AS new FROM df WHERE verdict = 'differs'")
def j21_inventory_diff(spark, folder):
    return diff.differing_values(snapshot_diff(spark, folder), keys=["asset_id"], values=["sha256", "bytes", "relative_path"])


@query(
    "j8_classified_differences",
    f"""WITH {DIFF}, n AS (SELECT *, split_part(asset_id, ':', 2)::BIGINT AS k FROM df WHERE verdict <> 'same')
    SELECT asset_id, CASE WHEN verdict IN ('only_a', 'only_b') THEN 'one_sided' WHEN k % 39 = 0 THEN 'declared' WHEN k % 2 = 0 THEN 'scope' ELSE 'undeclared' END AS category FROM n""",
)
def j8_classified_differences(spark, folder):
    k = F.substring_index("asset_id", ":", -1).cast("bigint")
    rules = [
        ("one_sided", F.col("verdict").isin("only_a", "only_b")),
        ("declared", k % 39 == 0),
        ("scope", k % 2 == 0),
    ]
    return diff.classify(snapshot_diff(spark, folder).where("verdict <> 'same'"), rules).select("asset_id", "category")


TOKEN_ROWS = """tk AS (SELECT l_orderkey, l_linenumber, 'adapter=' || l_returnflag || ';code=' || l_linestatus || ';model=' || (l_partkey % 3) AS a,
  CASE WHEN l_orderkey % 10 = 0 THEN NULL WHEN l_orderkey % 10 = 1 THEN 'broken' ELSE 'adapter=' || l_returnflag || ';code=' || CASE WHEN l_orderkey % 2 = 0 THEN 'X' ELSE l_linestatus END
    || ';model=' || (l_partkey % CASE WHEN l_orderkey % 7 = 0 THEN 2 ELSE 3 END) END AS b, l_linestatus = 'X' OR l_orderkey % 2 = 1 AS same_code,
  l_partkey % 3 = l_partkey % CASE WHEN l_orderkey % 7 = 0 THEN 2 ELSE 3 END AS same_model FROM lineitem)"""


def token_rows(spark, folder):
    li = table(spark, folder, "lineitem")
    text = lambda c: F.col(c).cast("string")
    model = (F.col("l_partkey") % F.when(F.col("l_orderkey") % 7 == 0, 2).otherwise(3)).cast("string")
    code = F.when(F.col("l_orderkey") % 2 == 0, F.lit("X")).otherwise(F.col("l_linestatus"))
    a = F.concat(F.lit("adapter="), "l_returnflag", F.lit(";code="), "l_linestatus", F.lit(";model="), (F.col("l_partkey") % 3).cast("string"))
    b = F.concat(F.lit("adapter="), "l_returnflag", F.lit(";code="), code, F.lit(";model="), model)
    ten = F.col("l_orderkey") % 10
    b = F.when(ten == 0, None).when(ten == 1, "broken").otherwise(b)
    return li.select("l_orderkey", long("l_linenumber").alias("l_linenumber"), a.alias("a"), b.alias("b"))


@query(
    "j8_token_category",
    f"""WITH {TOKEN_ROWS} SELECT l_orderkey, l_linenumber::BIGINT AS l_linenumber, CASE WHEN b IS NULL THEN 'unlocalised' WHEN b = 'broken' THEN 'undeclared'
    WHEN NOT same_code AND same_model THEN 'declared' ELSE 'undeclared' END AS category FROM tk""",
)
def j8_token_category(spark, folder):
    rows = token_rows(spark, folder).withColumns({"ta": X.tokens(F.col("a")), "tb": X.tokens(F.col("b"))})
    missing = F.col("a").isNull() | F.col("b").isNull()
    category = diff.token_category(F.col("ta"), F.col("tb"), missing=missing)
    return rows.select("l_orderkey", "l_linenumber", category.alias("category"))


@query(
    "p19_tokens",
    f"""WITH {TOKEN_ROWS} SELECT l_orderkey, l_linenumber::BIGINT AS l_linenumber, b IS NOT NULL AND b <> 'broken' AS wellformed,
    CASE WHEN b <> 'broken' THEN regexp_extract(b, 'code=([^;]*)', 1) END AS code FROM tk""",
)
def p19_tokens(spark, folder):
    t = token_rows(spark, folder).withColumn("t", X.tokens(F.col("b")))
    return t.select("l_orderkey", "l_linenumber", F.col("t").isNotNull().alias("wellformed"), F.try_element_at("t", F.lit("code")).alias("code"))


@query(
    "j9_excused_differences",
    f"""WITH {DIFF}, n AS (SELECT *, split_part(asset_id, ':', 2)::BIGINT AS k FROM df WHERE verdict = 'differs')
    SELECT asset_id, (k % 5) IN (SELECT DISTINCT k % 5 FROM n WHERE k % 39 = 0 AND k % 5 < 3) AS excused FROM n""",
)
def j9_excused_differences(spark, folder):
    d = snapshot_diff(spark, folder).where("verdict = 'differs'").withColumn("k", F.substring_index("asset_id", ":", -1).cast("bigint"))
    declared = (F.col("k") % 39 == 0) & (F.col("k") % 5 < 3)
    evidence = diff.classify(d, [("declared", declared)]).withColumn("file", F.regexp_extract(F.col("a.relative_path"), r"^set(\d)", 1))
    out = diff.excused_by(d, evidence, file=F.regexp_extract(F.col("a.relative_path"), r"^set(\d)", 1), key="file")
    return out.select("asset_id", "excused")


def registered(spark, folder):
    """Version 2 of the assets of folder set1 over the list of version 1."""
    existing = assets_v1(spark, folder).withColumn("superseded", F.col("idx") % 19 == 0)
    assets = assets_v2(spark, folder).where("source = 'src1' and spec_version = 'v1'").select(*FIELDS)
    lineage = {"source": "src1", "spec_id": "spec", "spec_version": "v1"}
    return catalog.merge_registration(existing, assets, folder="set1", lineage=lineage, fields=FIELDS)


@query(
    "j11_merge_registration",
    f"""WITH {ASSETS}, a AS (SELECT * FROM v2 WHERE source = 'src1' AND spec_version = 'v1'), m AS (SELECT v1.*, v1.idx % 19 = 0 AS dead, a.sha256 AS n
      FROM v1 LEFT JOIN a ON a.asset_id = v1.asset_id AND v1.relative_path LIKE 'set1/%'),
    o AS (SELECT *, CASE WHEN dead THEN 'untouched' WHEN n = sha256 THEN 'kept' WHEN n IS NOT NULL THEN 'replaced' WHEN source = 'src1' AND spec_version = 'v1' THEN 'dropped' ELSE 'untouched' END AS outcome FROM m)
    SELECT asset_id, sha256, dead OR outcome IN ('replaced', 'dropped') AS superseded, CASE WHEN outcome = 'replaced' THEN asset_id END AS superseded_by, outcome FROM o
    UNION ALL SELECT asset_id, sha256, false, NULL, 'added' FROM a WHERE asset_id NOT IN (SELECT asset_id FROM o WHERE outcome = 'kept')""",
)
def j11_merge_registration(spark, folder):
    return registered(spark, folder).select("asset_id", "sha256", "superseded", "superseded_by", "outcome")


@query(
    "q9_registration_counts",
    f"""WITH {ASSETS}, a AS (SELECT * FROM v2 WHERE source = 'src1' AND spec_version = 'v1'), e AS (SELECT v1.*, a.sha256 AS n FROM v1 LEFT JOIN a ON a.asset_id = v1.asset_id WHERE v1.idx % 19 <> 0),
    o AS (SELECT CASE WHEN n = sha256 THEN 'kept' WHEN n IS NOT NULL THEN 'replaced' WHEN source = 'src1' AND spec_version = 'v1' THEN 'dropped' END AS k, asset_id FROM e)
    SELECT k AS outcome, count(*) AS n FROM o WHERE k IS NOT NULL GROUP BY k UNION ALL
    SELECT 'added', count(*) FROM a WHERE asset_id NOT IN (SELECT asset_id FROM o WHERE k = 'kept')""",
)
def q9_registration_counts(spark, folder):
    return registered(spark, folder).where("outcome <> 'untouched'").groupBy("outcome").agg(F.count(F.lit(1)).alias("n"))


@query(
    "j12_supersede_version",
    f"WITH {ASSETS} SELECT asset_id, idx % 19 = 0 OR spec_version = 'v2' AS superseded, idx % 19 <> 0 AND spec_version = 'v2' AS changed FROM v1",
)
def j12_supersede_version(spark, folder):
    assets = assets_v1(spark, folder).withColumns({"superseded": F.col("idx") % 19 == 0, "superseded_by": F.lit(None).cast("string")})
    return catalog.supersede_version(assets, version="v2", by="v3").select("asset_id", "superseded", "changed")


def journal(spark, folder):
    """Two writes: version 1 to 2, and 2 to a third state without every 29th asset."""
    v1, v2 = assets_v1(spark, folder), assets_v2(spark, folder)
    v3 = v2.where("idx % 29 <> 0")
    first = catalog.changes_between(v1, v2, key="asset_id", value=["sha256"], sequence=1)
    second = catalog.changes_between(v2, v3, key="asset_id", value=["sha256"], sequence=2)
    return v3, first.unionByName(second)


@query(
    "w25_change_journal",
    f"""WITH {ASSETS}, v3 AS (SELECT * FROM v2 WHERE idx % 29 <> 0)
    SELECT 1::BIGINT AS sequence, coalesce(v1.asset_id, v2.asset_id) AS asset_id, CASE WHEN v1.asset_id IS NULL THEN 'added' WHEN v2.asset_id IS NULL THEN 'removed' ELSE 'changed' END AS change,
      v1.sha256 AS old, v2.sha256 AS new FROM v1 FULL JOIN v2 ON v1.asset_id = v2.asset_id WHERE v1.sha256 IS DISTINCT FROM v2.sha256
    UNION ALL SELECT 2, asset_id, 'removed', sha256, NULL FROM v2 WHERE idx % 29 = 0""",
)
def w25_change_journal(spark, folder):
    _, log = journal(spark, folder)
    return log.select("sequence", "asset_id", "change", F.col("old.sha256").alias("old"), F.col("new.sha256").alias("new"))


@query("w25_as_of_first", f"WITH {ASSETS} SELECT asset_id, sha256 FROM v2")
def w25_as_of_first(spark, folder):
    now, log = journal(spark, folder)
    return catalog.as_of(now, log, key="asset_id", value=["sha256"], sequence=1)


@query("w25_as_of_start", f"WITH {ASSETS} SELECT asset_id, sha256 FROM v1")
def w25_as_of_start(spark, folder):
    now, log = journal(spark, folder)
    return catalog.as_of(now, log, key="asset_id", value=["sha256"], sequence=0)


WRITES = """jr AS (SELECT l_orderkey AS file, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice) AS sequence,
  l_partkey % 3 AS slot, l_quantity::DOUBLE AS v FROM lineitem)"""


def writes(spark, folder):
    """Each line item as a write to one of three slots of its order; every fourth one did not land, and some orders were changed by other hands.

    Returns the slots now, the journalled changes, the journal records and the orders' digests. The numbered lines are checkpointed:
    each of the four is read from them.
    """
    order = ["l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"]
    li = table(spark, folder, "lineitem").withColumnRenamed("l_orderkey", "file")
    lines = dense_frames(li, keys=["file"], order=order, frame="n").select(
        "file", (F.col("n") + 1).alias("sequence"), (F.col("l_partkey") % 3).alias("slot"), F.col("l_quantity").cast("double").alias("v")
    )
    checkpoint_dir(spark)
    lines = lines.checkpoint().withColumn("landed", (F.col("file") + F.col("sequence")) % 4 != 0)
    before = Window.orderBy("sequence").rowsBetween(Window.unboundedPreceding, -1)
    state = F.coalesce(F.count_if("landed").over(before.partitionBy("file")), F.lit(0))
    old = F.last(F.when(F.col("landed"), F.struct("v")), ignorenulls=True).over(before.partitionBy("file", "slot"))
    digest = lambda n: F.concat(F.lit("d"), n.cast("string"))
    after = F.when(F.col("landed"), digest(state + 1)).otherwise("lost")
    records = lines.select("file", "sequence", digest(state).alias("before"), after.alias("after"))
    changes = lines.select("file", "sequence", "slot", old.alias("old"), F.struct("v").alias("new"))
    now = lines.where("landed").groupBy("file", "slot").agg(F.max_by("v", "sequence").alias("v"))
    final = F.when(F.col("file") % 50 == 0, "other").otherwise(digest(F.count_if("landed")))
    return now, changes, records, lines.groupBy("file").agg(final.alias("digest"))


@query(
    "w25_as_of_story",
    f"""WITH {WRITES}, good AS (SELECT file FROM jr GROUP BY file HAVING bool_or(sequence = 2 AND (file + 2) % 4 <> 0) AND file % 50 <> 0)
    SELECT file, slot::BIGINT AS slot, arg_max(v, sequence) AS v FROM jr JOIN good USING (file) WHERE sequence <= 2 AND (file + sequence) % 4 <> 0 GROUP BY file, slot""",
)
def w25_as_of_story(spark, folder):
    out = catalog.as_of_story(*writes(spark, folder), file="file", key="slot", value=["v"], sequence=2, rows=1000)
    return out.select("file", long("slot").alias("slot"), "v")


@query(
    "w25_as_of_problems",
    f"""WITH {WRITES}, n AS (SELECT file, max(sequence) AS m FROM jr GROUP BY file)
    SELECT file, CASE WHEN m < 2 THEN 'no such record' WHEN m = 2 AND file % 50 = 0 THEN 'record can''t be explained' WHEN (file + 2) % 4 = 0 THEN 'record was never applied'
      ELSE 'a later record can''t be explained' END AS problem FROM n WHERE m < 2 OR file % 50 = 0 OR (file + 2) % 4 = 0""",
)
def w25_as_of_problems(spark, folder):
    _, _, records, digests = writes(spark, folder)
    return catalog.as_of_problems(records, digests, file="file", sequence=2, rows=1000)


RECORDS = """jr AS (SELECT l_orderkey AS file, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice) AS sequence, l_partkey FROM lineitem),
rec AS (SELECT file, sequence, 'd' || (sequence - 1) AS before, CASE WHEN (file + sequence) % 4 = 0 THEN 'lost' ELSE 'd' || sequence END AS after FROM jr)"""


def journal_records(spark, folder):
    """Line items as journal records of their order: some writes never landed."""
    li = table(spark, folder, "lineitem").select(F.col("l_orderkey").alias("file"), "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice")
    n = dense_frames(li, keys=["file"], order=["l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"], frame="n")
    sequence = (F.col("n") + 1).alias("sequence")
    landed = F.concat(F.lit("d"), (F.col("n") + 1).cast("string"))
    after = F.when((F.col("file") + F.col("n") + 1) % 4 == 0, "lost").otherwise(landed)
    return n.select("file", sequence, F.concat(F.lit("d"), F.col("n").cast("string")).alias("before"), after.alias("after"))


@query(
    "w24_journal_story",
    f"""WITH {RECORDS}, m AS (SELECT *, coalesce(lead(before) OVER (PARTITION BY file ORDER BY sequence), 'd' || max(sequence) OVER (PARTITION BY file)) AS state FROM rec)
    SELECT file, sequence, CASE WHEN after = state THEN 'applied' WHEN before = state THEN 'unapplied' ELSE 'unexplained' END AS story FROM m""",
)
def w24_journal_story(spark, folder):
    records = journal_records(spark, folder)
    current = records.groupBy("file").agg(F.concat(F.lit("d"), F.max("sequence").cast("string")).alias("digest"))
    return catalog.journal_story(records, current, file="file", rows=1000).select("file", "sequence", "story")


@query(
    "s15_merge_shards",
    f"""WITH {ASSETS}, m AS (SELECT relative_path AS rel, role, 0 AS s FROM v1 WHERE idx % 3 = 0 UNION ALL SELECT relative_path, role || '1', 1 FROM v1 WHERE idx % 3 = 1 OR idx % 6 = 0
      UNION ALL SELECT relative_path, role || '2', 2 FROM v1 WHERE idx % 3 = 2 OR idx % 12 = 0)
    SELECT rel, role, true AS complete FROM (SELECT *, row_number() OVER (PARTITION BY rel ORDER BY s DESC) AS k FROM m) WHERE k = 1""",
)
def s15_merge_shards(spark, folder):
    v1 = assets_v1(spark, folder).select(F.col("relative_path").alias("rel"), "role", "idx")
    tag = lambda t: F.concat("role", F.lit(t)).alias("role")
    shards = [
        v1.where("idx % 3 = 0").select("rel", "role"),
        v1.where("idx % 3 = 1 or idx % 6 = 0").select("rel", tag("1")),
        v1.where("idx % 3 = 2 or idx % 12 = 0").select("rel", tag("2")),
    ]
    merged, complete = catalog.merge_shards(shards, key="rel", expected=3)
    return merged.withColumn("complete", complete)


KEYS4 = ["sha256", "bytes", "source", "spec_version"]


@query(
    "q8_split_by_trust",
    f"""WITH {ASSETS}, lg AS (SELECT *, CASE WHEN idx % 4 = 0 THEN 'FAIL' ELSE 'PASS' END AS status FROM v1)
    SELECT v2.asset_id, coalesce(v2.sha256 = lg.sha256 AND v2.bytes = lg.bytes AND v2.source = lg.source AND v2.spec_version = lg.spec_version, false) AS trusted
    FROM v2 LEFT JOIN lg ON lg.asset_id = v2.asset_id AND lg.status = 'PASS'""",
)
def q8_split_by_trust(spark, folder):
    ledger = assets_v1(spark, folder).withColumn("status", F.when(F.col("idx") % 4 == 0, "FAIL").otherwise("PASS"))
    return catalog.split_by_trust(assets_v2(spark, folder), ledger, key="asset_id", digests=KEYS4, full=False).select("asset_id", "trusted")


@query(
    "q8_updated_ledger",
    f"""WITH {ASSETS}, c AS (SELECT asset_id, sha256, 'PASS' AS status FROM v2 WHERE idx % 13 = 0 OR asset_id LIKE 'b:%')
    SELECT * FROM c UNION ALL SELECT asset_id, sha256, CASE WHEN idx % 4 = 0 THEN 'FAIL' ELSE 'PASS' END FROM v1 WHERE asset_id NOT IN (SELECT asset_id FROM c)""",
)
def q8_updated_ledger(spark, folder):
    status = F.when(F.col("idx") % 4 == 0, "FAIL").otherwise("PASS").alias("status")
    ledger = assets_v1(spark, folder).select("asset_id", "sha256", status)
    checked = assets_v2(spark, folder).where("idx % 13 = 0 or asset_id like 'b:%'").select("asset_id", "sha256", F.lit("PASS").alias("status"))
    return catalog.updated_ledger(ledger, checked, key="asset_id")


INDEX = """ix AS (SELECT o_orderkey AS take, CASE o_orderstatus WHEN 'F' THEN 'failed' WHEN 'P' THEN 'excluded' ELSE 'ok' END AS status,
  CASE WHEN o_orderstatus = 'P' THEN 'old' END AS reason, CASE WHEN o_orderstatus = 'P' THEN CASE WHEN o_orderkey % 2 = 0 THEN 'scan' ELSE 'person' END END AS excluded_by FROM orders),
vd AS (SELECT l_orderkey AS take, CASE WHEN max(l_quantity) > 48 THEN 'step' END AS reason FROM lineitem GROUP BY l_orderkey),
nx AS (SELECT ix.*, vd.reason AS r, vd.take IS NOT NULL AND coalesce(excluded_by, 'scan') = 'scan' AND status <> 'failed' AS judged FROM ix LEFT JOIN vd USING (take)),
ex AS (SELECT take, CASE WHEN judged AND r IS NOT NULL THEN 'excluded' WHEN judged THEN 'ok' ELSE status END AS status,
  CASE WHEN judged THEN r ELSE reason END AS reason, CASE WHEN judged THEN CASE WHEN r IS NOT NULL THEN 'scan' END ELSE excluded_by END AS excluded_by FROM nx)"""


def excluded_index(spark, folder):
    o = table(spark, folder, "orders")
    status = F.when(F.col("o_orderstatus") == "F", "failed").when(F.col("o_orderstatus") == "P", "excluded").otherwise("ok")
    out_ = F.col("o_orderstatus") == "P"
    by = F.when(out_, F.when(F.col("o_orderkey") % 2 == 0, "scan").otherwise("person"))
    index = o.select(F.col("o_orderkey").alias("take"), status.alias("status"), F.when(out_, "old").alias("reason"), by.alias("excluded_by"))
    worst = table(spark, folder, "lineitem").groupBy(F.col("l_orderkey").alias("take")).agg(F.max("l_quantity").alias("q"))
    verdicts = worst.select("take", F.when(F.col("q") > 48, "step").alias("reason"))
    return catalog.exclude_offenders(index, verdicts, key="take", owner="scan")


@query("q10_exclude_offenders", f"WITH {INDEX} SELECT take, status, reason, excluded_by FROM ex")
def q10_exclude_offenders(spark, folder):
    return excluded_index(spark, folder)


@query(
    "q10_index_counts",
    f"WITH {INDEX} SELECT count(*) FILTER (status = 'ok') AS ok, count(*) FILTER (status = 'failed') AS failed, count(*) FILTER (status = 'excluded') AS excluded, count(*) AS total FROM ex",
)
def q10_index_counts(spark, folder):
    return catalog.index_counts(excluded_index(spark, folder))


BACKFILL = """b AS (SELECT c_custkey, c_name, CASE WHEN c_custkey % 3 = 0 THEN c_mktsegment END AS f, CASE WHEN c_nationkey % 4 <> 0 THEN lower(c_mktsegment) END AS d FROM customer),
bf AS (SELECT *, coalesce(f, d) AS filled, CASE WHEN f IS NOT NULL THEN 'present' WHEN d IS NULL THEN 'nation unknown' END AS skip_reason FROM b)"""


def backfilled(spark, folder):
    c = table(spark, folder, "customer")
    rows = c.withColumn("f", F.when(F.col("c_custkey") % 3 == 0, F.col("c_mktsegment")))
    derived = F.when(F.col("c_nationkey") % 4 != 0, F.lower("c_mktsegment"))
    digest = F.sha2(F.concat_ws("|", "c_name", F.coalesce("f", F.lit(""))), 256)
    reason = F.when(F.col("c_nationkey") % 4 == 0, "nation unknown")
    return catalog.backfill(rows, key="c_custkey", field="f", derived=derived, reason=reason, before=digest, after=digest), digest


@query(
    "q12_backfill",
    f"WITH {BACKFILL} SELECT c_custkey, filled AS f, skip_reason, sha256(c_name || '|' || coalesce(f, '')) AS before_sha, sha256(c_name || '|' || coalesce(filled, '')) AS after_sha FROM bf",
)
def q12_backfill(spark, folder):
    return backfilled(spark, folder)[0].select("c_custkey", "f", "skip_reason", "before_sha", "after_sha")


@query(
    "q12_roll_back",
    f"""WITH {BACKFILL} SELECT c_custkey, CASE WHEN skip_reason IS NOT NULL THEN 'untouched' WHEN c_custkey % 50 = 1 THEN 'refused' ELSE 'undone' END AS outcome,
    CASE WHEN skip_reason IS NOT NULL THEN filled WHEN c_custkey % 50 = 1 THEN filled || '!' END AS f FROM bf""",
)
def q12_roll_back(spark, folder):
    """Undo the fills after every 50th row was edited by someone else."""
    journal_, digest = backfilled(spark, folder)
    touched = (F.col("c_custkey") % 50 == 1) & F.col("skip_reason").isNull()
    current = journal_.withColumn("f", F.when(touched, F.concat("f", F.lit("!"))).otherwise(F.col("f"))).select("c_custkey", "c_name", "f")
    return catalog.roll_back(current, journal_, key="c_custkey", digest=digest, field="f").select("c_custkey", "outcome", "f")


@query("q13_one_column_rewrite", "SELECT 'l_tax' AS \"column\", count(DISTINCT l_suppkey) AS changed FROM lineitem WHERE l_discount > 0.05")
def q13_one_column_rewrite(spark, folder):
    """A rewrite of one column; the digests must name it and no other."""
    cols = ["l_quantity", "l_discount", "l_tax", "l_returnflag"]
    before = table(spark, folder, "lineitem").select("l_suppkey", F.concat_ws(":", "l_orderkey", "l_linenumber", "l_partkey").alias("n"), *cols)
    after = before.withColumn("l_tax", F.when(F.col("l_discount") > 0.05, F.col("l_tax") + 1).otherwise(F.col("l_tax")))
    return catalog.changed_columns(before, after, keys=["l_suppkey"], name="n")


@query(
    "a25_take_digest",
    """SELECT l_orderkey AS take, sha256(string_agg(sha256(l_partkey::VARCHAR), '|' ORDER BY l_linenumber::VARCHAR || '/' || l_partkey || '/' || l_suppkey, sha256(l_partkey::VARCHAR))) AS digest, count(*) AS members FROM lineitem GROUP BY l_orderkey""",
)
def a25_take_digest(spark, folder):
    li = table(spark, folder, "lineitem")
    files = li.select(F.col("l_orderkey").alias("take"), F.concat_ws("/", "l_linenumber", "l_partkey", "l_suppkey").alias("n"), F.sha2(F.col("l_partkey").cast("string"), 256).alias("h"))
    return diff.group_digest(files, keys=["take"], name="n", digest="h", buckets=1)


@query("a25_corpus_digest")
def a25_corpus_digest(spark, folder):
    """Two-level digest of every source's documents."""
    d = table(spark, folder, "documents").select("source", "doc_id", F.sha2("text", 256).alias("h"))
    return diff.group_digest(d, keys=["source"], name="doc_id", digest="h", buckets=4096)


@query(
    "a26_identity_hash",
    """SELECT c_custkey, substr(sha256('{"c_custkey":' || c_custkey || ',"c_mktsegment":"' || c_mktsegment || '","note":null}'), 1, 16) AS identity FROM customer""",
)
def a26_identity_hash(spark, folder):
    c = table(spark, folder, "customer").withColumn("note", F.lit(None).cast("string"))
    return c.select("c_custkey", diff.identity_hash(["c_mktsegment", "note", "c_custkey"], 16).alias("identity"))


@query("f17_row_hash", """SELECT n_nationkey::BIGINT AS k, sha256('{"n_name":"' || n_name || '","n_nationkey":' || n_nationkey || ',"n_regionkey":' || n_regionkey || '}') AS digest FROM nation""")
def f17_row_hash(spark, folder):
    return table(spark, folder, "nation").select(long("n_nationkey").alias("k"), X.row_hash("n_regionkey", "n_nationkey", "n_name").alias("digest"))


def documents_of_orders(spark, folder):
    """Two versions of a nested document per order."""
    o = table(spark, folder, "orders")
    doc = lambda total, prio: F.to_json(
        F.struct(
            F.struct(F.col("o_orderkey").alias("id"), F.struct(F.col("o_custkey").alias("cust"), prio.alias("prio")).alias("who")).alias("head"),
            F.struct(total.alias("total")).alias("body"),
        )
    )
    total = F.col("o_totalprice").cast("string")
    other = F.when(F.col("o_orderkey") % 6 == 0, F.lit("changed")).otherwise(F.col("o_orderpriority"))
    new = doc(F.when(F.col("o_orderkey") % 10 == 0, F.lit("0")).otherwise(total), other)
    return o.select("o_orderkey", doc(total, F.col("o_orderpriority")).alias("doc")), o.select("o_orderkey", new.alias("doc"))


@query(
    "a27_leaf_most_differences",
    "SELECT o_orderkey, 'head.who.prio' AS subtree FROM orders WHERE o_orderkey % 6 = 0 UNION ALL SELECT o_orderkey, 'body.total' FROM orders WHERE o_orderkey % 10 = 0",
)
def a27_leaf_most_differences(spark, folder):
    a, b = documents_of_orders(spark, folder)
    differing = diff.differing_subtrees(a, b, keys=["o_orderkey"], document="doc", depth=3)
    return diff.leaf_most(differing, keys=["o_orderkey"], path="subtree")


@query(
    "p10_masked_leaves",
    """SELECT o_orderkey, p AS path, v AS value FROM (SELECT o_orderkey, 'head.id' AS p, o_orderkey::VARCHAR AS v FROM orders UNION ALL SELECT o_orderkey, 'head.who.cust', o_custkey::VARCHAR FROM orders
    UNION ALL SELECT o_orderkey, 'head.who.prio', '<masked>' FROM orders UNION ALL SELECT o_orderkey, 'body.total', '<masked>' FROM orders)""",
)
def p10_masked_leaves(spark, folder):
    leaves = X.json_leaves(documents_of_orders(spark, folder)[0], "o_orderkey", document=F.col("doc"))
    return diff.masked(leaves, names=["prio", "total"]).select("o_orderkey", "path", "value")


@query("p10_without_prefix", "SELECT page_id, replace(url, 'http://', '') AS value FROM pages")
def p10_without_prefix(spark, folder):
    return table(spark, folder, "pages").select("page_id", diff.without_prefix(F.col("url"), F.lit("http://")).alias("value"))


@query(
    "p14_paths",
    r"""SELECT page_id, lower(replace('C:\Raw\' || url, '\', '/')) AS folded, CASE WHEN starts_with(url, 'http:/') THEN substr(url, 7) END AS relative,
    replace(replace(url || '~', '~', '~0'), '/', '~1') AS pointer, regexp_replace(url, '[^A-Za-z0-9._-]', '_', 'g') AS folder FROM pages""",
)
def p14_paths(spark, folder):
    url = F.col("url")
    return table(spark, folder, "pages").select(
        "page_id",
        X.normal_path(F.concat(F.lit("C:\\Raw\\"), url), fold_case=True).alias("folded"),
        X.below_root(url, "http:/").alias("relative"),
        X.pointer_part(F.concat(url, F.lit("~"))).alias("pointer"),
        X.folder_name(url).alias("folder"),
    )


@query(
    "p15_composite_id",
    "SELECT o_orderkey, 'spec:v1:' || o_orderstatus || ':' || o_custkey AS asset_id, o_orderstatus AS source FROM orders",
)
def p15_composite_id(spark, folder):
    o = table(spark, folder, "orders")
    made = X.composite_id(F.lit("spec"), F.lit("v1"), F.col("o_orderstatus"), F.col("o_custkey").cast("string"))
    return o.select("o_orderkey", made.alias("asset_id")).withColumn("source", X.id_part(F.col("asset_id"), 2))


LISTED = """CASE page_id % 7 WHEN 0 THEN '/abs/' || page_id WHEN 1 THEN 'set/../' || page_id WHEN 2 THEN 'C:/x/' || page_id WHEN 3 THEN 'set//' || page_id
  WHEN 4 THEN 'set\\' || page_id WHEN 5 THEN 'only' || page_id ELSE 'set/sub/' || page_id END"""


@query("f16_safe_names", f"SELECT page_id, page_id % 7 = 6 AS safe FROM pages")
def f16_safe_names(spark, folder):
    k, i = F.col("page_id") % 7, F.col("page_id").cast("string")
    forms = ["/abs/", "set/../", "C:/x/", "set//", "set\\", "only", "set/sub/"]
    name = F.element_at(F.array(*[F.lit(p) for p in forms]), (k + 1).cast("int"))
    return table(spark, folder, "pages").select("page_id", X.safe_listed_name(F.concat(name, i)).alias("safe"))


@query("t1_name_order", "SELECT c_name, c_custkey FROM customer ORDER BY c_name")
def t1_name_order(spark, folder):
    return sets.name_order(table(spark, folder, "customer").select("c_name", "c_custkey"), order=["c_name"])


@query(
    "t4_top_per_category",
    f"""WITH {DIFF}, k AS (SELECT verdict, asset_id, row_number() OVER (PARTITION BY verdict ORDER BY asset_id) AS rank, count(*) OVER (PARTITION BY verdict) AS n FROM df)
    SELECT verdict, asset_id, rank, greatest(n - 5, 0) AS more FROM k WHERE rank <= 5""",
)
def t4_top_per_category(spark, folder):
    rows = snapshot_diff(spark, folder).select("verdict", "asset_id")
    return sets.top_per_category(rows, category="verdict", order=["asset_id"], k=5)


@query("o5_common_rows", f"WITH {ASSETS} SELECT asset_id, sha256 FROM v1 INTERSECT SELECT asset_id, sha256 FROM v2")
def o5_common_rows(spark, folder):
    pick = ["asset_id", "sha256"]
    return sets.common_rows(assets_v1(spark, folder).select(*pick), assets_v2(spark, folder).select(*pick))


@query(
    "o5_symmetric_difference",
    f"""WITH {ASSETS} (SELECT asset_id, sha256, 'a' AS side FROM v1 EXCEPT SELECT asset_id, sha256, 'a' FROM v2)
    UNION ALL (SELECT asset_id, sha256, 'b' FROM v2 EXCEPT SELECT asset_id, sha256, 'b' FROM v1)""",
)
def o5_symmetric_difference(spark, folder):
    pick = ["asset_id", "sha256"]
    return sets.symmetric_difference(assets_v1(spark, folder).select(*pick), assets_v2(spark, folder).select(*pick))
