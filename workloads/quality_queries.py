"""Quality jobs and their rules."""

from __future__ import annotations

from pyspark.sql import functions as F

from motionframes import schemas
from motionframes.functions import text as X
from motionframes.operators import sets, windows
from motionframes.operators.blocks import dealt, task_count
from motionframes.plans import quality
from motionframes.sources import archives, files

from .base import GAPPY_SQL, SERIES, gappy, long, query, r6, scratch, series, table
from .stat_queries import BAD_MASK
from .window_queries import HERMITE, STEP, filled, stepped

FIND = ["take", "level", "severity", "message"]

# ---- manifests: one JSON document per document, some malformed

PATHS = "CASE WHEN doc_id % 9 = 0 THEN '/data/' || source || '/x.bin' WHEN doc_id % 9 = 1 THEN 'C:\\raw\\x' ELSE source || '/' || doc_id || '.bin' END"
VERSION = "CASE WHEN doc_id % 13 = 0 THEN '1.2.3' WHEN doc_id % 17 = 0 THEN 'canonical-2' WHEN doc_id % 5 <> 0 THEN 'tag-1' END"
SCOPE = "CASE WHEN doc_id % 23 = 0 THEN NULL WHEN doc_id % 19 = 0 THEN 'public' ELSE 'restricted' END"
MANIFESTS = f"""mf AS (SELECT doc_id AS take, source, lang, {PATHS} AS path, {VERSION} AS spec_version, {SCOPE} AS scope,
  CASE WHEN doc_id % 31 <> 0 THEN 'poc-' || lang END AS contract, doc_id % 29 <> 0 AS readable FROM documents)"""


def manifest_texts(spark, folder):
    d = table(spark, folder, "documents")
    sql = lambda text: F.expr(text.replace("\\", "\\\\"))
    doc = F.to_json(
        F.struct(
            F.struct(F.concat(F.lit("take"), F.col("doc_id").cast("string")).alias("take_id"), F.expr("if(doc_id % 31 <> 0, concat('poc-', lang), null)").alias("contract_id")).alias("identity"),
            F.struct(F.col("source").alias("source_name"), F.array(sql(PATHS)).alias("files")).alias("source"),
            sql(VERSION).alias("spec_version"),
            sql(SCOPE).alias("distribution_scope"),
        )
    )
    broken = F.when(F.col("doc_id") % 29 == 0, F.regexp_replace(doc, r"\}$", ', "tail": ')).otherwise(doc)
    return d.select(F.col("doc_id").alias("take"), "source", "lang", broken.alias("text"))


def manifests(spark, folder):
    fields = {
        "source_name": "$.source.source_name", "contract_id": "$.identity.contract_id",
        "spec_version": "$.spec_version", "spec_id": "$.spec_id", "distribution_scope": "$.distribution_scope",
    }
    return files.manifests(manifest_texts(spark, folder), keys=["take"], text="text", fields=fields)


def manifest_leaves(spark, folder):
    return X.json_leaves(manifest_texts(spark, folder), "take", document=F.col("text"))


@query("s4_manifests", f"WITH {MANIFESTS} SELECT take, readable, CASE WHEN readable THEN source END AS source_name, CASE WHEN readable THEN spec_version END AS spec_version FROM mf")
def s4_manifests(spark, folder):
    return manifests(spark, folder).select("take", "readable", "source_name", "spec_version")


@query(
    "p5_absolute_paths",
    f"WITH {MANIFESTS} SELECT take, 'absolute path at source.files.0' AS message FROM mf WHERE readable AND regexp_matches(path, '^/[^/]+/|^[A-Za-z]:[\\\\/]')",
)
def p5_absolute_paths(spark, folder):
    return quality.absolute_paths(manifest_leaves(spark, folder), keep=["take"]).select("take", "message")


RULES = f"""{MANIFESTS}, ru AS (SELECT take, unnest([
  CASE WHEN NOT readable THEN 'unreadable manifest' END,
  CASE WHEN readable AND scope IS NULL THEN 'missing distribution_scope' END, CASE WHEN readable AND scope <> 'restricted' THEN 'wrong distribution_scope' END,
  CASE WHEN readable AND spec_version <> 'tag-1' THEN 'wrong spec_version' END, CASE WHEN readable AND regexp_matches(spec_version, '^\\d+\\.\\d+\\.\\d+$') THEN 'bare version number' END,
  CASE WHEN readable AND spec_version LIKE 'canonical%' THEN 'banned token in lineage' END, CASE WHEN readable AND contract IS NULL THEN 'missing contract id' END,
  CASE WHEN readable AND regexp_matches(path, '^/[^/]+/|^[A-Za-z]:[\\\\/]') THEN 'absolute path at source.files.0' END]) AS message FROM mf)"""


@query("q6_governance_findings", f"WITH {RULES} SELECT take, 'L4' AS level, 'FAIL' AS severity, message FROM ru WHERE message IS NOT NULL")
def q6_governance_findings(spark, folder):
    out = quality.governance_findings(manifests(spark, folder), manifest_leaves(spark, folder), take="take", spec_id="spec", spec_version="tag-1", scope="restricted")
    return out.select(*FIND)


STATED_SQL = """CASE WHEN doc_id % 6 <> 0 THEN CASE WHEN doc_id % 5 = 0 THEN 'released' ELSE 'trial' END END AS artifact_class,
  CASE WHEN doc_id % 4 = 0 THEN 'none' WHEN doc_id % 4 = 1 THEN 'passed' END AS quality_gate, CASE WHEN doc_id % 7 = 0 THEN 'other' WHEN doc_id % 7 < 4 THEN 'spec' END AS spec_id"""

STATED = ["artifact_class", "quality_gate", "spec_id"]


@query(
    "q6_stated_fields",
    f"""WITH mf AS (SELECT doc_id AS take, {STATED_SQL} FROM documents),
    ru AS (SELECT take, unnest([CASE WHEN artifact_class IS NULL THEN 'missing artifact_class' END, CASE WHEN artifact_class <> 'trial' THEN 'wrong artifact_class' END,
      CASE WHEN quality_gate <> 'none' THEN 'wrong quality_gate' END, CASE WHEN spec_id <> 'spec' THEN 'wrong spec_id' END]) AS message FROM mf)
    SELECT take, 'L4' AS level, 'FAIL' AS severity, message FROM ru WHERE message IS NOT NULL""",
)
def q6_stated_fields(spark, folder):
    stated = spark.sql(f"SELECT doc_id AS take, {STATED_SQL} FROM {{documents}}", documents=table(spark, folder, "documents"))
    names = ["distribution_scope", "spec_version", "contract_id"]
    fixed = F.struct(F.lit("restricted").alias(names[0]), F.lit("tag-1").alias(names[1]), F.lit("c").alias(names[2]), *STATED)
    texts = stated.select("take", F.to_json(fixed).alias("text"))
    found = files.manifests(texts, keys=["take"], text="text", fields={n: f"$.{n}" for n in [*names, *STATED]})
    out = quality.governance_findings(
        found, X.json_leaves(texts, "take", document=F.col("text")), take="take", spec_id="spec", spec_version="tag-1", scope="restricted",
        required={"artifact_class": "trial"}, optional={"quality_gate": "none"},
    )
    return out.select(*FIND)


@query("p6_lineage_rules", f"WITH {RULES} SELECT take, message FROM ru WHERE message IS NOT NULL AND message NOT LIKE 'absolute%' AND message NOT LIKE 'unreadable%'")
def p6_lineage_rules(spark, folder):
    rules = quality.governance_rules("spec", "tag-1", "restricted")
    readable = manifests(spark, folder).where("readable")
    return quality.failed_rules(readable, rules, level="L4", check="governance", keep=["take"]).select("take", "message")


# ---- structure

ARTIFACTS = {"manifest.json": None, "small": None, "large": None, "reference": "development", "kinetics": "forces"}
TAKES = """tk AS (SELECT o_orderkey AS take, 'src' || (o_custkey % 4) AS source, CASE o_custkey % 5 WHEN 0 THEN 'measured' WHEN 4 THEN 'odd' ELSE 'synthetic' END AS mode,
  CASE o_orderstatus WHEN 'P' THEN 'failed' ELSE 'ok' END AS status FROM orders),
cp AS (SELECT *, mode = 'measured' OR source = 'src3' AS measured, source IN ('src1', 'src3') AS development FROM tk)"""


def takes(spark, folder):
    o = table(spark, folder, "orders")
    fifth = F.col("o_custkey") % 5
    base = o.select(
        F.col("o_orderkey").alias("take"),
        F.concat(F.lit("src"), (F.col("o_custkey") % 4).cast("string")).alias("source"),
        F.when(fifth == 0, "measured").when(fifth == 4, "odd").otherwise("synthetic").alias("mode"),
        F.when(F.col("o_orderstatus") == "P", "failed").otherwise("ok").alias("status"),
    )
    profiles = spark.createDataFrame(
        [("src1", ["development", "unknown"]), ("src3", ["development", "measured"])], "source string, capabilities array<string>"
    )
    by_mode = {"measured": ["measured"], "synthetic": []}
    return quality.capabilities(base, profiles, source="source", mode="mode", by_mode=by_mode, known=["measured", "development", "forces"])


@query(
    "p3_capabilities",
    f"WITH {TAKES} SELECT take, concat_ws(',', CASE WHEN development THEN 'development' END, CASE WHEN measured THEN 'measured' END) AS capabilities, mode = 'odd' AS unknown_mode FROM cp",
)
def p3_capabilities(spark, folder):
    return takes(spark, folder).select("take", F.array_join("capabilities", ",").alias("capabilities"), "unknown_mode")


EXPECTED = f"{TAKES}, ef AS (SELECT take, f AS file FROM cp, (VALUES ('manifest.json', NULL), ('small', NULL), ('large', NULL), ('reference', 'development')) AS a(f, c) WHERE c IS NULL OR development)"


@query("p4_expected_files", f"WITH {EXPECTED} SELECT take, file FROM ef")
def p4_expected_files(spark, folder):
    return quality.expected_files(takes(spark, folder), ARTIFACTS, keys=["take"])


STORED = """sd AS (SELECT DISTINCT l_orderkey AS take FROM lineitem WHERE l_quantity < 45 UNION SELECT o_orderkey + 1000000 FROM orders WHERE o_orderkey % 97 = 0),
fl AS (SELECT take, f AS file FROM sd, (VALUES ('manifest.json', 1), ('small', 10), ('large', 11), ('reference', 3)) AS a(f, k) WHERE k = 1 OR take % k <> 0)"""


def stored(spark, folder):
    lines = table(spark, folder, "lineitem")
    kept = dealt(lines.where("l_quantity < 45").select(F.col("l_orderkey").alias("take")), task_count(lines), "take").distinct()
    extra = table(spark, folder, "orders").where("o_orderkey % 97 = 0").select((F.col("o_orderkey") + 1000000).alias("take"))
    dirs = kept.unionByName(extra)
    have = [("manifest.json", 1), ("small", 10), ("large", 11), ("reference", 3)]
    cells = F.array(*[F.struct(F.lit(f).alias("file"), F.lit(k).alias("k")) for f, k in have])
    listed = dirs.select("take", F.inline(cells)).where((F.col("k") == 1) | (F.col("take") % F.col("k") != 0)).drop("k")
    return dirs, listed


@query(
    "q1_root_findings",
    """WITH f AS (SELECT s_suppkey AS dataset, CASE WHEN s_suppkey % 5 <> 0 THEN 'INDEX.json' END AS i, CASE WHEN s_suppkey % 3 = 0 THEN 'A_DATA_DESCRIPTION_1.md' ELSE 'notes.md' END AS d FROM supplier)
    SELECT dataset, CASE WHEN i IS NULL THEN 'missing INDEX.json' ELSE 'missing description' END AS message FROM f WHERE i IS NULL OR d = 'notes.md'""",
)
def q1_root_findings(spark, folder):
    datasets = table(spark, folder, "supplier").select(F.col("s_suppkey").alias("dataset"))
    described = F.when(F.col("dataset") % 3 == 0, "A_DATA_DESCRIPTION_1.md").otherwise("notes.md")
    listed = datasets.select("dataset", F.explode(F.array_compact(F.array(F.when(F.col("dataset") % 5 != 0, "INDEX.json"), described))).alias("name"))
    out = quality.root_findings(datasets, listed, dataset="dataset", name="name", index="INDEX.json", description=r"DATA_DESCRIPTION.*\.md$")
    return out.select("dataset", "message")


@query(
    "q1_structure_findings",
    f"""WITH {EXPECTED}, {STORED} SELECT take, 'missing take dir' AS message FROM cp WHERE status = 'ok' AND take NOT IN (SELECT take FROM sd)
    UNION ALL SELECT ef.take, 'missing deliverable ' || file FROM ef JOIN cp USING (take) WHERE status = 'ok' AND take IN (SELECT take FROM sd) AND (ef.take, file) NOT IN (SELECT take, file FROM fl)
    UNION ALL SELECT take, 'orphan take dir' FROM sd WHERE take NOT IN (SELECT take FROM cp)""",
)
def q1_structure_findings(spark, folder):
    dirs, listed = stored(spark, folder)
    lines = table(spark, folder, "lineitem")
    return quality.structure_findings(takes(spark, folder), dirs, listed, ARTIFACTS, take="take", sized_by=lines).select("take", "message")


@query(
    "a7_count_findings",
    f"""WITH {TAKES}, c AS (SELECT source, count(*) FILTER (status = 'ok') AS k, count(*) FILTER (status = 'failed') AS f, count(*) AS n FROM tk GROUP BY source),
    s AS (SELECT source, k, k + CASE WHEN source = 'src1' THEN 1 ELSE 0 END AS ok, f, n - CASE WHEN source = 'src2' THEN 1 ELSE 0 END AS total FROM c)
    SELECT source, 'ok count differs from ok entries' AS message FROM s WHERE ok <> k UNION ALL SELECT source, 'counts do not sum to total' FROM s WHERE ok + f <> total""",
)
def a7_count_findings(spark, folder):
    entries = takes(spark, folder).select("source", "status")
    real = entries.groupBy("source").agg(F.count_if(F.col("status") == "ok").alias("k"), F.count_if(F.col("status") == "failed").alias("failed"), F.count(F.lit(1)).alias("n"))
    plus = lambda s: F.when(F.col("source") == s, 1).otherwise(0)
    stated = real.select("source", (F.col("k") + plus("src1")).alias("ok"), "failed", F.lit(0).alias("excluded"), (F.col("n") - plus("src2")).alias("total"))
    return quality.count_findings(entries, stated, dataset="source").select("source", "message")


# ---- array declarations

SPEC = (
    ("small", "time", "f8", ["T"], None),
    ("small", "acc", "f4", ["T", "8", "3"], None),
    ("small", "gyro", "f4", ["T", "8", "3"], None),
    ("small", "mask", "bool", ["T", "8"], None),
    ("small", "mount", "f4", ["8", "4"], "measured"),
)


def observed_arrays(spark, folder):
    """Array shapes per order, with one kind of defect per residue."""
    o = table(spark, folder, "orders").select(F.col("o_orderkey").alias("take"), (F.col("o_custkey") % 90 + 10).alias("n"))
    k = F.col("take")
    shape = lambda *axes: F.array(*[a if not isinstance(a, int) else F.lit(a) for a in axes]).cast("array<bigint>")
    row = lambda key, dtype, shp, there: F.struct(F.lit(key).alias("key"), dtype.alias("dtype"), shp.alias("shape"), there.alias("there"))
    n, yes = F.col("n"), F.lit(True)
    cells = [
        row("time", F.lit("f8"), shape(n), yes),
        row("acc", F.when(k % 7 == 0, "f8").otherwise("f4"), shape(n, 8, 3), k % 19 != 0),
        row("gyro", F.lit("f4"), shape(n + F.when(k % 11 == 0, 1).otherwise(0), 8, 3), yes),
        row("mask", F.lit("bool"), F.when(k % 13 == 0, shape(n)).when(k % 23 == 0, shape(n, 9)).otherwise(shape(n, 8)), yes),
        row("mount", F.lit("f4"), shape(8, 4), k % 3 == 0),
        row("extra", F.lit("f4"), shape(n), k % 17 == 0),
    ]
    arrays = o.select("take", F.lit("small").alias("artifact"), F.inline(F.array(*cells))).where("there").drop("there")
    caps = F.when(k % 2 == 0, F.array(F.lit("measured"))).otherwise(F.array().cast("array<string>"))
    return arrays, o.select("take", F.lit("small").alias("artifact"), caps.alias("capabilities"))


def array_spec(spark):
    return spark.createDataFrame(list(SPEC), "artifact string, key string, dtype string, axes array<string>, capability string")


@query(
    "q3_array_spec_findings",
    """WITH o AS (SELECT o_orderkey AS take FROM orders), m AS (SELECT take, unnest([
      CASE WHEN take % 19 = 0 THEN 'missing-key:acc' END, CASE WHEN take % 2 = 0 AND take % 3 <> 0 THEN 'missing-key:mount' END,
      CASE WHEN take % 2 = 1 AND take % 3 = 0 THEN 'forbidden-key:mount' END, CASE WHEN take % 17 = 0 THEN 'unexpected-key:extra' END,
      CASE WHEN take % 7 = 0 AND take % 19 <> 0 THEN 'dtype-mismatch:acc' END, CASE WHEN take % 13 = 0 THEN 'rank-mismatch:mask' END,
      CASE WHEN take % 23 = 0 AND take % 13 <> 0 THEN 'axis-size-mismatch:mask' END, CASE WHEN take % 11 = 0 THEN 'free-axis-T-inconsistent:small' END]) AS message FROM o)
    SELECT take, 'L1' AS level, 'FAIL' AS severity, message FROM m WHERE message IS NOT NULL""",
)
def q3_array_spec_findings(spark, folder):
    arrays, owners = observed_arrays(spark, folder)
    return quality.array_spec_findings(arrays, owners, array_spec(spark), take="take").select(*FIND)


@query(
    "o1_key_differences",
    """WITH o AS (SELECT o_orderkey AS take FROM orders) SELECT take, 'acc' AS key, 'missing' AS problem FROM o WHERE take % 19 = 0
    UNION ALL SELECT take, 'mount', 'missing' FROM o WHERE take % 2 = 0 AND take % 3 <> 0 UNION ALL SELECT take, 'mount', 'forbidden' FROM o WHERE take % 2 = 1 AND take % 3 = 0
    UNION ALL SELECT take, 'extra', 'unexpected' FROM o WHERE take % 17 = 0""",
)
def o1_key_differences(spark, folder):
    arrays, owners = observed_arrays(spark, folder)
    declared = quality.declared_keys(owners, array_spec(spark), take="take")
    return sets.key_differences(
        arrays, declared, keys=["take"], name="key", required=F.col("_allowed"), forbidden=~F.col("_allowed")
    )


@query(
    "a6_frame_counts",
    """WITH n AS (SELECT l_orderkey AS take, count(*) AS n, max(l_linenumber) AS m FROM lineitem GROUP BY l_orderkey) SELECT take, 'frame counts differ across artifacts' AS message FROM n WHERE n <> m""",
)
def a6_frame_counts(spark, folder):
    li = table(spark, folder, "lineitem").groupBy(F.col("l_orderkey").alias("take"))
    small = li.agg(F.count(F.lit(1)).alias("frames"))
    large = li.agg(long(F.max("l_linenumber")).alias("frames"))
    return quality.frame_count_findings(small.unionByName(large), take="take", frames="frames").select("take", "message")


@query("a6_declared_length", "SELECT vec_id AS take, 'declared length differs' AS message FROM embeddings WHERE len(embedding) <> 64 + CASE WHEN label % 3 = 1 THEN 1 ELSE 0 END")
def a6_declared_length(spark, folder):
    e = table(spark, folder, "embeddings").withColumnRenamed("vec_id", "take")
    declared = 64 + F.when(F.col("label") % 3 == 1, 1).otherwise(0)
    return quality.declared_length_findings(e, take="take", values=F.col("embedding"), declared=declared).select("take", "message")


@query(
    "q16_pair_ids",
    "SELECT l_orderkey AS take, 'pair ids differ' AS message FROM lineitem GROUP BY l_orderkey HAVING count(DISTINCT l_returnflag) > 1",
)
def q16_pair_ids(spark, folder):
    parts = table(spark, folder, "lineitem").select(F.col("l_orderkey").alias("take"), F.col("l_returnflag").alias("pair"))
    return quality.pair_id_findings(parts, take="take", pair="pair").select("take", "message")


# ---- manifest fields, waivers and conformance

FIELDS = ("spec_version", "distribution_scope", "contract_id")


def present_fields(spark, folder):
    m = manifests(spark, folder)
    cells = F.array_compact(F.array(*[F.when(F.col(f).isNotNull(), F.lit(f)) for f in FIELDS]))
    return m.select("take", F.explode(cells).alias("field"))


def waivers(spark):
    rows = [("books", "spec_version", "2020-01-01"), ("code", "distribution_scope", "2099-01-01"), ("forum", "contract_id", "2099-01-01")]
    return spark.createDataFrame(rows, "source string, target string, expires string").withColumn("expires", F.to_date("expires"))


WAIVERS = "wv(source, target, expires) AS (VALUES ('books', 'spec_version', DATE '2020-01-01'), ('code', 'distribution_scope', DATE '2099-01-01'), ('forum', 'contract_id', DATE '2099-01-01'))"


@query(
    "q2_manifest_findings",
    f"""WITH {MANIFESTS}, {WAIVERS}, g AS (SELECT take, source, unnest([CASE WHEN NOT readable OR spec_version IS NULL THEN 'spec_version' END,
      CASE WHEN NOT readable OR scope IS NULL THEN 'distribution_scope' END, CASE WHEN NOT readable OR contract IS NULL THEN 'contract_id' END]) AS field FROM mf)
    SELECT take, 'L1' AS level, CASE WHEN (source, field) IN (SELECT source, target FROM wv) THEN 'WARN' ELSE 'FAIL' END AS severity, 'missing manifest field:' || field AS message FROM g WHERE field IS NOT NULL""",
)
def q2_manifest_findings(spark, folder):
    owners = manifest_texts(spark, folder).select("take", "source")
    out = quality.missing_fields(present_fields(spark, folder), owners, FIELDS, waivers(spark), take="take", source="source")
    return out.select(*FIND)


@query(
    "o2_undeclared_keys",
    """SELECT DISTINCT source, 'lang:' || lang AS name FROM documents WHERE lang NOT IN ('en', 'fr') AND NOT (source LIKE '%1' AND lang = 'de')""",
)
def o2_undeclared_keys(spark, folder):
    d = table(spark, folder, "documents")
    observed = d.select("source", F.concat(F.lit("lang:"), "lang").alias("name"))
    sources = d.select("source").distinct()
    allowed = sources.select("source", F.explode(F.array(F.lit("lang:en"), F.lit("lang:fr"))).alias("name"))
    waived = sources.where("source like '%1'").select("source", F.lit("lang:de").alias("name"))
    return sets.undeclared(observed, allowed, waived, on=["source", "name"])


@query(
    "q7_conformance_findings",
    f"""WITH d AS (SELECT DISTINCT source FROM documents), w AS (SELECT source, 'lang:de' AS target, CASE WHEN source LIKE '%1' THEN DATE '2020-01-01' ELSE DATE '2099-01-01' END AS expires FROM d WHERE source LIKE '%1' OR source LIKE '%2'
      UNION ALL SELECT source, 'README', DATE '2099-01-01' FROM d WHERE source LIKE '%3')
    SELECT DISTINCT source, 'L1' AS level, 'FAIL' AS severity, 'undeclared key lang:' || lang AS message FROM documents WHERE lang NOT IN ('en', 'fr') AND (source, 'lang:' || lang) NOT IN (SELECT source, target FROM w)
    UNION ALL SELECT source, 'L4', 'FAIL', 'expired waiver ' || target FROM w WHERE expires < DATE '2025-01-01'
    UNION ALL SELECT source, 'L0', CASE WHEN n = 'README' THEN 'WARN' ELSE 'FAIL' END, 'missing file ' || n FROM d, (VALUES ('README'), ('INDEX')) AS f(n)
      WHERE NOT (n = 'INDEX' AND source NOT LIKE '%4') AND (source, n) NOT IN (SELECT source, target FROM w)""",
)
def q7_conformance_findings(spark, folder):
    d = table(spark, folder, "documents")
    sources = d.select("source").distinct()
    observed = d.select("source", F.concat(F.lit("lang:"), "lang").alias("name"))
    allowed = sources.select("source", F.explode(F.array(F.lit("lang:en"), F.lit("lang:fr"))).alias("name"))
    ends = lambda n: F.col("source").endswith(n)
    languages = sources.where(ends("1") | ends("2")).select("source", F.lit("lang:de").alias("target"), F.when(ends("1"), "2020-01-01").otherwise("2099-01-01").alias("e"))
    readme = sources.where(ends("3")).select("source", F.lit("README").alias("target"), F.lit("2099-01-01").alias("e"))
    waived = languages.unionByName(readme).select("source", "target", F.to_date("e").alias("expires"))
    needs = F.array(*[F.struct(F.lit(n).alias("name"), F.lit(d_).alias("distribution")) for n, d_ in (("README", True), ("INDEX", False), ("REPORT", True))])
    required = sources.select("source", F.inline(needs))
    have = sources.where(~ends("4")).select("source", F.lit("INDEX").alias("name"))
    out = quality.conformance_findings(
        observed, allowed, waived, required, have, source="source", today=F.lit("2025-01-01").cast("date"), pending=["REPORT"]
    )
    return out.select("source", "level", "severity", "message")


@query(
    "q11_limitation_problems",
    """WITH e AS (SELECT p_partkey AS id, CASE WHEN p_partkey % 6 = 0 THEN ' ' ELSE p_name END AS statement, CASE p_partkey % 3 WHEN 0 THEN 'fixed' WHEN 1 THEN 'open' ELSE 'later' END AS status,
      CASE WHEN p_partkey % 2 = 0 THEN p_brand END AS fixed_in, CASE WHEN p_size > 40 THEN '2024-13-01' ELSE '2024-02-0' || (p_size % 9 + 1) END AS since, CASE WHEN p_size % 4 = 0 THEN 'galaxy' ELSE 'take' END AS lv FROM part),
    m AS (SELECT id, unnest([CASE WHEN trim(statement) = '' THEN 'missing statement' END, CASE WHEN status = 'later' THEN 'unknown status' END,
      CASE WHEN status = 'fixed' AND fixed_in IS NULL THEN 'fixed without fixed_in' END, CASE WHEN since LIKE '%-13-%' THEN 'since is not a date' END, CASE WHEN lv = 'galaxy' THEN 'unknown scope level' END]) AS problem FROM e)
    SELECT id, problem FROM m WHERE problem IS NOT NULL""",
)
def q11_limitation_problems(spark, folder):
    third = F.col("p_partkey") % 3
    entries = table(spark, folder, "part").select(
        F.col("p_partkey").alias("id"),
        F.when(F.col("p_partkey") % 6 == 0, " ").otherwise(F.col("p_name")).alias("statement"),
        F.lit("data").alias("kind"),
        F.lit("major").alias("severity"),
        F.when(third == 0, "fixed").when(third == 1, "open").otherwise("later").alias("status"),
        F.when(F.col("p_partkey") % 2 == 0, F.col("p_brand")).alias("fixed_in"),
        F.lit(None).cast("string").alias("mitigation"),
        F.when(F.col("p_size") > 40, "2024-13-01").otherwise(F.concat(F.lit("2024-02-0"), (F.col("p_size") % 9 + 1).cast("string"))).alias("since"),
        F.when(F.col("p_size") % 4 == 0, "galaxy").otherwise("take").alias("level"),
    )
    return quality.limitation_problems(
        entries, id_="id", kinds=["data", "method"], severities=["minor", "major"], statuses=["open", "fixed", "mitigated"], levels=["bundle", "take", "site"]
    )


# How the parts' entries are written and which of them break a rule, for Spark and for DuckDB.
ENTRY = """CASE WHEN k % 101 = 0 THEN '[' ELSE concat('{"id": "L', CASE WHEN k % 17 = 1 THEN k - 1 ELSE k END, '", "kind": "data", "severity": "major", "consequence": "c", "statement": "',
  CASE WHEN k % 6 = 0 THEN ' ' ELSE 's' END, '"', CASE WHEN k % 10 = 0 THEN '' ELSE ', "evidence": "e"' END, CASE WHEN k % 9 = 0 THEN ', "note": 1' ELSE '' END,
  CASE k % 8 WHEN 0 THEN ', "related": "a"' WHEN 1 THEN ', "related": ["a"]' ELSE '' END, ', "status": "', CASE k % 3 WHEN 0 THEN 'fixed' WHEN 1 THEN 'mitigated' ELSE 'later' END, '"',
  CASE WHEN k % 2 = 0 THEN ', "fixed_in": "2"' ELSE ', "mitigation": "m"' END, ', "since": "2024-', CASE WHEN p_size > 40 THEN '13' ELSE '02' END, '-01", "scope": ',
  CASE WHEN k % 13 = 0 THEN '"all"' ELSE concat('{"level": "', CASE k % 4 WHEN 0 THEN 'site' WHEN 1 THEN 'take' WHEN 2 THEN 'bundle' ELSE 'galaxy' END, '", "sites": ',
    CASE k % 5 WHEN 0 THEN '[]' WHEN 1 THEN '"hip"' ELSE '["hip"]' END, CASE WHEN k % 7 = 0 THEN ', "takes": ["t"]' ELSE '' END, CASE WHEN k % 14 = 0 THEN ', "colour": 1' ELSE '' END, '}') END, '}') END"""


@query(
    "q11_entry_problems",
    """WITH e AS (SELECT p_partkey AS k, p_size, p_partkey % 13 <> 0 AS o FROM part),
    m AS (SELECT k, unnest(CASE WHEN k % 101 = 0 THEN ['entry is not an object'] ELSE [CASE WHEN k % 6 = 0 THEN 'missing statement' END, CASE WHEN k % 10 = 0 THEN 'missing evidence' END,
      CASE WHEN k % 9 = 0 THEN 'unknown field note' END, CASE WHEN k % 8 = 0 THEN 'related is not a list' END, CASE WHEN k % 3 = 2 THEN 'unknown status' END,
      CASE WHEN k % 3 = 0 AND k % 2 = 1 THEN 'fixed without fixed_in' END, CASE WHEN k % 3 = 1 AND k % 2 = 0 THEN 'mitigated without mitigation' END,
      CASE WHEN p_size > 40 THEN 'since is not a date' END, CASE WHEN NOT o THEN 'scope is not an object' END, CASE WHEN o AND k % 4 = 3 THEN 'unknown scope level' END,
      CASE WHEN o AND k % 5 = 1 THEN 'scope.sites is not a list' END, CASE WHEN o AND k % 4 = 0 AND k % 5 = 0 THEN 'scope.sites is empty' END,
      CASE WHEN o AND k % 4 = 1 AND k % 7 <> 0 THEN 'scope.takes is empty' END, CASE WHEN o AND k % 14 = 0 THEN 'unknown scope field colour' END,
      CASE WHEN k % 17 = 1 AND (k - 1) % 101 <> 0 AND k > 1 THEN 'duplicate id' END] END) AS problem FROM e)
    SELECT k // 17 AS file, k AS position, problem FROM m WHERE problem IS NOT NULL""",
)
def q11_entry_problems(spark, folder):
    part = table(spark, folder, "part").select("p_partkey", "p_size")
    # The table's few files are spread before the entries are written.
    parts = dealt(part, task_count(part, rows=quality.ENTRIES), "p_partkey").withColumn("k", F.col("p_partkey").cast("bigint"))
    entries = parts.select(F.expr("k div 17").alias("file"), F.col("k").alias("position"), F.expr(ENTRY).alias("entry"))
    return quality.entry_problems(
        entries, file="file", position="position", entry="entry",
        required=["id", "kind", "severity", "scope", "statement", "consequence", "evidence", "status", "since"], optional=["mitigation", "related", "fixed_in"],
        scope_lists={"sites": "site", "arrays": "array", "takes": "take", "subjects": None, "files": None},
        kinds=["data", "method"], severities=["minor", "major"], statuses=["open", "fixed", "mitigated"], levels=["bundle", "take", "site", "array", "subject"],
    )


# ---- physics

BANDS = {
    "median_max": 60.0, "median_min": 20.0, "floor_p95": 60.0, "norm_off": 0.05, "rate_max": 700.0,
    "step_s": 180000.0, "step_tolerance_s": 90000.0, "min_coverage": 0.7,
}

# What a row of an event holds; fixed test patterns, some broken in every take they name.
READINGS = {
    "valid": f"({BAD_MASK}) AND NOT (take % 9 = 4 AND site = 'click')",
    "norm": "CASE WHEN NOT ok OR take % 9 = 4 AND site = 'click' THEN NULL WHEN take % 11 = 2 AND event_id % 3 = 0 THEN 1.1e0 ELSE 1.01e0 END",
    "magnitude": "CASE WHEN take % 4 = 3 THEN x WHEN ok AND event_id % 50 <> 3 OR NOT ok AND event_id % 70 = 7 THEN coalesce(x, 30e0) END",
    "rate": "CASE WHEN take % 5 = 1 THEN x * 5 ELSE coalesce(x, 40e0) END",
    "confidence": f"CASE WHEN take % 13 = 5 AND event_id % 5 = 0 THEN NULL WHEN take % 7 = 2 THEN 0.4e0 WHEN NOT ({BAD_MASK}) THEN 0e0 WHEN take % 7 = 3 THEN 1.5e0 ELSE 0.9e0 END",
    "contact": "event_id % 3 = 1",
    "force": "CASE WHEN event_id % 3 = 1 OR take % 8 = 3 AND event_id % 7 = 0 THEN 500e0 ELSE 0e0 END",
    "point": "CASE WHEN event_id % 3 = 1 AND take % 10 <> 6 OR event_id % 3 <> 1 AND take % 12 = 7 THEN 0.2e0 END",
    "at_s": "CASE WHEN take % 17 = 8 AND event_id % 9 = 0 THEN NULL WHEN take % 6 = 5 AND event_id % 7 = 0 THEN t_s - 400000 ELSE t_s END",
}
L2 = f"""{GAPPY_SQL}, rd AS (SELECT take, site, frame, {", ".join(f"({e}) AS {n}" for n, e in READINGS.items())} FROM g),
sp AS (SELECT *, at_s - lag(at_s) OVER (PARTITION BY take, site ORDER BY frame) AS step FROM rd),
si AS (SELECT take, site, count(*) AS n, count(*) FILTER (valid) AS u, {", ".join(f"count(*) FILTER (valid AND {a} IS NULL) AS {a}_l, count(*) FILTER (NOT valid AND {a} IS NOT NULL) AS {a}_b" for a in ("norm", "magnitude", "rate"))},
  count(*) FILTER (confidence IS NULL) AS c_l, count(*) FILTER (NOT valid AND confidence <> 0) AS c_u, count(*) FILTER (valid AND (confidence <= 0 OR confidence > 1)) AS c_b,
  count(*) FILTER (NOT contact AND force <> 0) AS f_n, count(*) FILTER (contact AND point IS NULL) AS p_m, count(*) FILTER (NOT contact AND point IS NOT NULL) AS p_n,
  count(*) FILTER (at_s IS NULL) AS t_l, count(*) FILTER (step <= 0) AS t_b, quantile_cont(step, 0.5) AS sm, quantile_cont(magnitude, 0.5) FILTER (valid) AS md,
  quantile_cont(magnitude, 0.95) FILTER (valid) AS p95, max(abs(norm - 1)) FILTER (valid) AS no, max(abs(rate)) FILTER (valid) AS rm FROM sp GROUP BY take, site),
ws AS (SELECT *, row_number() OVER (PARTITION BY take ORDER BY no DESC NULLS LAST, site) AS no_k, row_number() OVER (PARTITION BY take ORDER BY md DESC NULLS LAST, site) AS md_k,
  row_number() OVER (PARTITION BY take ORDER BY rm DESC NULLS LAST, site) AS rm_k, md < 20.0 AND p95 < 60.0 AS low,
  row_number() OVER (PARTITION BY take ORDER BY CASE WHEN md < 20.0 AND p95 < 60.0 THEN p95 END NULLS LAST, site) AS low_k,
  sum(norm_l) OVER w AS nl, sum(magnitude_l) OVER w AS ml, sum(rate_l) OVER w AS rl, sum(norm_b) OVER w AS nb, sum(magnitude_b) OVER w AS mb, sum(rate_b) OVER w AS rb,
  sum(c_l) OVER w AS cl, sum(c_u) OVER w AS cu, sum(c_b) OVER w AS cb, sum(f_n) OVER w AS fn, sum(p_m) OVER w AS pm, sum(p_n) OVER w AS pn, sum(t_l) OVER w AS tl, sum(t_b) OVER w AS tb,
  max(abs(sm - 180000.0)) OVER w AS so, sum(u) OVER w AS us, sum(n) OVER w AS ns, row_number() OVER (PARTITION BY take ORDER BY site) AS k FROM si WINDOW w AS (PARTITION BY take)),
fi AS (SELECT take, unnest([CASE WHEN u = 0 THEN 'no valid row at ' || site END, CASE WHEN no_k = 1 AND nl = 0 AND no > 0.05 THEN 'norm off at ' || site END,
    CASE WHEN md_k = 1 AND ml = 0 AND md > 60.0 THEN 'magnitude too high at ' || site END, CASE WHEN low_k = 1 AND ml = 0 AND low THEN 'gravity missing at ' || site END,
    CASE WHEN rm_k = 1 AND rl = 0 AND rm > 700.0 THEN 'rate too high at ' || site END]) AS message FROM ws
  UNION ALL SELECT take, unnest([CASE WHEN nl > 0 THEN 'norm missing on valid rows' END, CASE WHEN ml > 0 THEN 'magnitude missing on valid rows' END, CASE WHEN rl > 0 THEN 'rate missing on valid rows' END,
    CASE WHEN nb > 0 THEN 'norm present on invalid rows' END, CASE WHEN mb > 0 THEN 'magnitude present on invalid rows' END, CASE WHEN rb > 0 THEN 'rate present on invalid rows' END,
    CASE WHEN cl > 0 THEN 'confidence missing' END, CASE WHEN cl = 0 AND cu > 0 THEN 'confidence on invalid rows' END, CASE WHEN cl = 0 AND cb > 0 THEN 'confidence outside (0, 1]' END,
    CASE WHEN fn > 0 THEN 'force without contact' END, CASE WHEN pm > 0 THEN 'point missing in contact' END, CASE WHEN pn > 0 THEN 'point without contact' END,
    CASE WHEN tl > 0 THEN 'time missing' END, CASE WHEN tl = 0 AND tb > 0 THEN 'times not increasing' END, CASE WHEN tl = 0 AND so > 90000.0 THEN 'time step off' END,
    CASE WHEN us < 0.7 * ns THEN 'coverage too low' END]) FROM ws WHERE k = 1)"""


def l2_findings(spark, folder):
    rows = gappy(spark, folder).withColumn("at_s", F.expr(READINGS["at_s"]))
    return quality.physical_findings(
        rows, take="take", site="site", frame="frame", time="at_s", columns={n: F.expr(e) for n, e in READINGS.items() if n != "at_s"}, bands=BANDS
    )


@query("q4_physical_findings", f"WITH {L2} SELECT take, 'L2' AS level, 'FAIL' AS severity, message FROM fi WHERE message IS NOT NULL")
def q4_physical_findings(spark, folder):
    return l2_findings(spark, folder).select(*FIND)


@query(
    "a8_findings_roll_up",
    f"""WITH {RULES}, {L2}, al AS (SELECT 'L4' AS level FROM ru WHERE message IS NOT NULL UNION ALL SELECT 'L2' FROM fi WHERE message IS NOT NULL)
    SELECT level, grouping(level)::BIGINT AS total_row, count(*) AS fail, 0::BIGINT AS warn, false AS passed FROM al GROUP BY ROLLUP (level)""",
)
def a8_findings_roll_up(spark, folder):
    governance = quality.governance_findings(manifests(spark, folder), manifest_leaves(spark, folder), take="take", spec_id="spec", spec_version="tag-1", scope="restricted")
    return quality.roll_up_findings(sets.all_findings(governance, l2_findings(spark, folder)))


@query(
    "o4_all_findings",
    f"""WITH {RULES}, l AS (SELECT l_orderkey AS take, sum(l_quantity) AS q FROM lineitem GROUP BY l_orderkey HAVING sum(l_quantity) > 200)
    SELECT take, message, NULL::DOUBLE AS amount FROM ru WHERE message IS NOT NULL UNION ALL SELECT take, 'too much', round(q, 6) + 0.0 FROM l""",
)
def o4_all_findings(spark, folder):
    governance = quality.governance_findings(manifests(spark, folder), manifest_leaves(spark, folder), take="take", spec_id="spec", spec_version="tag-1", scope="restricted")
    heavy = table(spark, folder, "lineitem").groupBy(F.col("l_orderkey").alias("take")).agg(r6(F.sum("l_quantity")).alias("amount")).where("amount > 200")
    heavy = heavy.withColumn("message", F.lit("too much"))
    return sets.all_findings(governance.select("take", "message"), heavy)


@query(
    "o3_ordered_union",
    """SELECT word AS name, list AS list, pos AS position FROM (SELECT word, list, pos, row_number() OVER (PARTITION BY word ORDER BY list, pos) AS k FROM (
      SELECT p_partkey AS list, unnest(range(1, len(string_split(p_name, ' ')) + 1)) AS pos, unnest(string_split(p_name, ' ')) AS word FROM part)) WHERE k = 1""",
)
def o3_ordered_union(spark, folder):
    words = table(spark, folder, "part").select(F.col("p_partkey").alias("list"), F.posexplode(F.split("p_name", " ")).alias("i", "name"))
    words = words.select("list", (F.col("i") + 1).cast("bigint").alias("position"), "name")
    return sets.ordered_union(words, name="name", position=["list", "position"])


@query(
    "a5_contact_invariants",
    """WITH c AS (SELECT l_suppkey AS take, l_quantity > 20 AS contact, CASE WHEN l_quantity > 19 THEN l_extendedprice ELSE 0 END AS force, CASE WHEN l_discount > 0.02 AND l_quantity > 15 THEN l_tax END AS point,
      l_returnflag <> 'N' AS valid, l_linestatus = 'F' AS src FROM lineitem)
    SELECT take, count(*) FILTER (NOT contact AND force <> 0) AS force_without_contact, count(*) FILTER (contact AND point IS NULL) AS point_missing, count(*) FILTER (NOT contact AND point IS NOT NULL) AS point_without_contact,
      count(*) FILTER (valid AND NOT src) AS valid_beyond_source, count(*) FILTER (valid) = 0 AS nothing_valid FROM c GROUP BY take""",
)
def a5_contact_invariants(spark, folder):
    li = table(spark, folder, "lineitem").withColumnRenamed("l_suppkey", "take")
    return quality.contact_invariants(
        li, keys=["take"], contact=F.col("l_quantity") > 20, force=F.when(F.col("l_quantity") > 19, F.col("l_extendedprice")).otherwise(0.0),
        point=F.when((F.col("l_discount") > 0.02) & (F.col("l_quantity") > 15), F.col("l_tax")),
        valid=F.col("l_returnflag") != "N", source_valid=F.col("l_linestatus") == "F",
    )


@query("a5_names_follow", "SELECT p_partkey AS take, p_size % 2 = 0 AS follows FROM part")
def a5_names_follow(spark, folder):
    words = F.split(F.concat("p_name", F.lit(" "), "p_brand"), " ")
    rest = F.when(F.col("p_size") % 2 == 0, F.slice(words, F.lit(2), F.size(words) - 1)).otherwise(words)
    return table(spark, folder, "part").select(F.col("p_partkey").alias("take"), quality.names_follow(words, rest).alias("follows"))


# ---- row rules


@query("p2_effective_mask", f"WITH {SERIES} SELECT take, frame, coalesce(CASE WHEN site <> 'error' THEN x > 20 END, true) AS valid FROM s")
def p2_effective_mask(spark, folder):
    stored_mask = F.when(F.col("site") != "error", F.col("x") > 20)
    return series(spark, folder).select("take", "frame", quality.effective_mask(stored_mask).alias("valid"))


@query(
    "p7_biological_sex",
    """WITH d AS (SELECT c_custkey, CASE c_custkey % 6 WHEN 0 THEN ' Female ' WHEN 1 THEN 'm' WHEN 2 THEN 'MALE' WHEN 3 THEN 'f' WHEN 4 THEN 'unknown' END AS v FROM customer)
    SELECT c_custkey, CASE WHEN v IN (' Female ', 'f') THEN 'female' WHEN v IN ('m', 'MALE') THEN 'male' END AS strict, CASE WHEN v IN (' Female ', 'f') THEN 'female' WHEN v IN ('m', 'MALE') THEN 'male' ELSE 'neutral' END AS loose,
      CASE WHEN v IN (' Female ', 'f') THEN 'female' WHEN v IN ('m', 'MALE') THEN 'male' END AS body FROM d""",
)
def p7_biological_sex(spark, folder):
    forms = F.array(*[F.lit(v) for v in (" Female ", "m", "MALE", "f", "unknown", None)])
    v = F.get(forms, (F.col("c_custkey") % 6).cast("int"))
    return table(spark, folder, "customer").select("c_custkey", X.biological_sex(v, fallback=None).alias("strict"), X.biological_sex(v, fallback="neutral").alias("loose"), X.body_gender(v).alias("body"))


@query(
    "p8_rate_with_provenance",
    """SELECT c_custkey, CASE WHEN c_custkey % 4 = 0 THEN 120.0 WHEN c_custkey % 4 = 1 THEN 60.0 WHEN c_nationkey < 10 THEN 100.0 END AS rate,
    CASE WHEN c_custkey % 4 = 0 THEN 'native' WHEN c_custkey % 4 = 1 THEN 'alternative' WHEN c_nationkey < 10 THEN 'fallback' END AS origin FROM customer""",
)
def p8_rate_with_provenance(spark, folder):
    k = F.col("c_custkey") % 4
    rates = table(spark, folder, "nation").where("n_nationkey < 10").select(F.col("n_nationkey").alias("c_nationkey"), F.lit(100.0).alias("fallback"))
    rows = table(spark, folder, "customer").join(rates, "c_nationkey", "left")
    native = F.when(k == 0, 120.0).when(k == 2, float("nan"))
    value, label = quality.rate_with_provenance(native, F.when(k == 1, 60.0).when(k == 3, -1.0), F.col("fallback"))
    return rows.select("c_custkey", value.alias("rate"), label.alias("origin"))


@query("p9_height_m", "SELECT c_custkey, round(CASE WHEN h > 3 THEN h / 100 ELSE h END, 6) + 0.0 AS height FROM (SELECT c_custkey, CASE WHEN c_custkey % 2 = 0 THEN 150 + c_custkey % 50 ELSE 1.5 + (c_custkey % 50) / 100.0 END AS h FROM customer)")
def p9_height_m(spark, folder):
    k = F.col("c_custkey")
    h = F.when(k % 2 == 0, 150.0 + k % 50).otherwise(1.5 + (k % 50) / 100.0)
    return table(spark, folder, "customer").select("c_custkey", r6(X.height_m(h)).alias("height"))


@query("p11_in_sample", "SELECT o_orderkey FROM orders WHERE contains(o_custkey || '|' || o_orderkey, '7|1') OR contains(o_custkey || '|' || o_orderkey, '99')")
def p11_in_sample(spark, folder):
    return quality.in_sample(table(spark, folder, "orders"), ["7|1", "99"], subject="o_custkey", take="o_orderkey").select("o_orderkey")


@query("p13_usable_status", f"WITH {HERMITE} SELECT take, status, count(*) AS frames, status <> 'UNAVAILABLE' AS usable FROM filled GROUP BY take, status")
def p13_usable_status(spark, folder):
    counts = filled(spark, folder).groupBy("take", "status").agg(F.count(F.lit(1)).alias("frames"))
    return counts.withColumn("usable", schemas.usable("status"))


NAMES = ["Customer#000000007", "Customer#000000031", "Customer#000000055", "Customer#999999999"]


@query("p16_selected", f"SELECT c_custkey, c_name FROM customer WHERE c_name IN ({', '.join(repr(n) for n in NAMES)})")
def p16_selected(spark, folder):
    kept, _ = quality.select_named(table(spark, folder, "customer"), NAMES, name="c_name")
    return kept.select("c_custkey", "c_name")


@query("p16_unknown", "SELECT 'Customer#999999999' AS c_name FROM customer LIMIT 1")
def p16_unknown(spark, folder):
    return quality.select_named(table(spark, folder, "customer"), NAMES, name="c_name")[1]


@query(
    "p17_masked_confidence",
    f"WITH {GAPPY_SQL} SELECT take, frame, CASE WHEN ok THEN CASE site WHEN 'click' THEN 0.9 WHEN 'view' THEN 0.7 ELSE 0.5 END ELSE 0.0 END AS confidence FROM g",
)
def p17_masked_confidence(spark, folder):
    by_site = spark.createDataFrame([("click", 0.9), ("view", 0.7)], "site string, c double")
    rows = gappy(spark, folder).join(by_site, "site", "left")
    value = quality.masked_confidence(F.col("ok"), F.coalesce("c", F.lit(0.5)))
    return rows.select("take", "frame", value.alias("confidence"))


@query(
    "p17_confidence_findings",
    f"""WITH {GAPPY_SQL}, c AS (SELECT take, ok, CASE WHEN ok THEN (event_id % 101) / 99.0 ELSE CASE WHEN event_id % 90 = 7 THEN 0.1 ELSE 0.0 END END AS c FROM g)
    SELECT take, 'confidence on invalid rows' AS message FROM c WHERE NOT ok AND c <> 0 GROUP BY take UNION ALL SELECT take, 'confidence outside (0, 1]' FROM c WHERE ok AND (c <= 0 OR c > 1) GROUP BY take""",
)
def p17_confidence_findings(spark, folder):
    bad = F.when(F.col("event_id") % 90 == 7, 0.1).otherwise(0.0)
    rows = gappy(spark, folder).withColumn("c", F.when(F.col("ok"), (F.col("event_id") % 101) / 99.0).otherwise(bad))
    return quality.confidence_findings(rows, take="take", valid=F.col("ok"), confidence=F.col("c")).select("take", "message")


@query(
    "p18_without_glitches",
    f"WITH {STEP} SELECT take::BIGINT AS take, frame, NOT glitch AS valid, CASE WHEN glitch THEN 0.0 ELSE 0.8 END AS confidence, CASE WHEN NOT glitch THEN round(vx, 6) + 0.0 END AS vx FROM gl",
)
def p18_without_glitches(spark, folder):
    rows = stepped(spark, folder).withColumns({"valid": F.lit(True), "confidence": F.lit(0.8), "vx": F.col("v")["x"]})
    out = quality.without_glitches(rows, glitch=F.col("glitch"), valid="valid", channels=["vx"], confidence="confidence")
    return out.select(long("take").alias("take"), "frame", "valid", "confidence", r6("vx").alias("vx"))


@query(
    "p21_cut_window",
    f"""WITH {SERIES}, d AS (SELECT *, x - lag(x) OVER (PARTITION BY take ORDER BY frame) AS dx FROM s)
    SELECT take, frame - 10 AS frame, round(t_s - min(t_s) OVER (PARTITION BY take), 6) + 0.0 AS t_s, round(dx, 6) + 0.0 AS dx FROM d WHERE frame >= 10 AND frame < 30""",
)
def p21_cut_window(spark, folder):
    """Differences of the whole take, then the window, so its first row still knows the one before."""
    whole = windows.differences(series(spark, folder), keys=["take"], frame="frame", value="x", dt_s=1.0)
    cut = quality.cut_window(whole, keys=["take"], frame="frame", time="t_s", start=10, stop=30)
    return cut.select("take", "frame", r6("t_s").alias("t_s"), r6("backward").alias("dx"))


@query("p22_column_aliases", "SELECT o_orderkey, o_orderkey AS code, o_totalprice AS amount FROM orders")
def p22_column_aliases(spark, folder):
    o = table(spark, folder, "orders").select("o_orderkey", "o_totalprice")
    return archives.column_aliases(o, {"o_orderkey": "code", "o_totalprice": "amount"}).drop("o_totalprice")


@query(
    "f15_up_axis",
    """WITH w AS (SELECT doc_id, CASE doc_id % 5 WHEN 0 THEN 'Y' WHEN 1 THEN 'Z' WHEN 2 THEN NULL WHEN 3 THEN 'Z' ELSE 'Y' END AS t, CASE doc_id % 4 WHEN 0 THEN 'Y' WHEN 1 THEN 'Z' END AS g FROM documents)
    SELECT doc_id, CASE WHEN t IS NULL THEN g WHEN g IS NULL OR g = t THEN t END AS up_axis, CASE WHEN t IS NULL AND g IS NULL THEN 'no witness' WHEN t <> g THEN 'witnesses disagree' END AS reason FROM w""",
)
def f15_up_axis(spark, folder):
    prose = F.array(*[F.lit(t) for t in ("frames are y-up", "world is Z up here", "nothing said", "z-up", "Y-up")])
    note = F.get(prose, (F.col("doc_id") % 5).cast("int"))
    k = F.col("doc_id") % 4
    gy, gz = F.when(k == 0, -9.81).otherwise(0.0), F.when(k == 1, -9.81).otherwise(0.0)
    value, reason = X.agreed(X.up_axis_from_text(note), X.up_axis_from_gravity(F.lit(0.0), gy, gz))
    return table(spark, folder, "documents").select("doc_id", value.alias("up_axis"), reason.alias("reason"))


@query(
    "s16_report_summary",
    f"""WITH {L2}, al AS (SELECT 'L2' AS level FROM fi WHERE message IS NOT NULL) SELECT level, count(*) AS fail, count(*) = 0 AS passed FROM al GROUP BY ROLLUP (level)""",
)
def s16_report_summary(spark, folder):
    """The report written as JSON, and its summary read back."""
    path = scratch(spark, "report")
    quality.write_report(l2_findings(spark, folder), path)
    summary = spark.read.schema("level string, total_row bigint, fail bigint, warn bigint, passed boolean").json(f"{path}/summary")
    return summary.select("level", "fail", "passed")
