"""Scans and listings on tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from motionframes.operators.blocks import dealt, task_count
from motionframes.sources import archives, files, tidy

from .base import QUATS, SERIES, long, quats, query, r6, scratch, series, table


def _observed_sql(name: str, columns: dict[str, str]) -> str:
    return " UNION ALL ".join(
        f"SELECT '{name}' AS artifact, '{c}' AS key, '{t}' AS dtype, count(*) AS rows, count({c}) AS present FROM {name}" for c, t in columns.items()
    )


@query(
    "s1_observed_columns",
    _observed_sql("lineitem", {"l_orderkey": "i8", "l_quantity": "f8", "l_linenumber": "i4", "l_returnflag": "U"})
    + " UNION ALL "
    + _observed_sql("labels", {"doc_id": "i8", "quality": "i4", "toxic": "i4"}),
)
def s1_observed_columns(spark, folder):
    li = table(spark, folder, "lineitem").select("l_orderkey", "l_quantity", "l_linenumber", "l_returnflag")
    return archives.observed_columns(li, artifact="lineitem").unionByName(
        archives.observed_columns(table(spark, folder, "labels"), artifact="labels")
    )


# Order keys per archive.
ARCHIVE_KEYS = 4096


@query(
    "s1_archive_headers",
    f"""WITH a AS (SELECT o_orderkey // {ARCHIVE_KEYS} AS archive, count(*) AS n FROM orders GROUP BY ALL),
    k AS (SELECT unnest(['o_orderkey', 'o_totalprice', 'o_orderpriority']) AS key, unnest(['i8', 'f8', 'U']) AS dtype)
    SELECT archive, key, dtype, 1 AS rank, n AS rows FROM a, k""",
)
def s1_archive_headers(spark, folder):
    """Archives of all orders, one per range of keys, written by tasks and scanned by their headers."""
    orders = table(spark, folder, "orders").select("o_orderkey", F.col("o_totalprice").cast("double").alias("o_totalprice"), "o_orderpriority")
    path = scratch(spark, "archives")
    dealt = orders.withColumn("archive", F.expr(f"o_orderkey div {ARCHIVE_KEYS}L"))
    written = archives.write_archives(dealt, bucket="archive", columns=["o_orderkey", "o_totalprice", "o_orderpriority"], folder=path, notes="orders")
    written.agg(F.count(F.lit(1))).collect()
    found = archives.archive_headers(spark, path).where("problem is null")
    archive = F.regexp_extract("path", r"(-?\d+)\.npz$", 1).cast("bigint")
    return found.select(archive.alias("archive"), "key", "dtype", F.size("shape").alias("rank"), F.get("shape", F.lit(0)).alias("rows"))


@query("s2_load_columns", "SELECT o_orderkey, o_totalprice FROM orders")
def s2_load_columns(spark, folder):
    return archives.load_columns(spark, f"{folder}/orders.parquet", ["o_orderkey", "gyro", "o_totalprice"])


# Orders per index document.
INDEX_PART = 512


def index_texts(spark, folder):
    """Index documents per supplier, each over a bounded range of orders; entries in three shapes."""
    pairs = table(spark, folder, "lineitem").select(F.col("l_suppkey").alias("ds"), F.col("l_orderkey").alias("k")).distinct()
    pairs = pairs.withColumn("part", F.expr(f"k div {INDEX_PART}L"))
    name = F.concat(F.lit("t"), F.col("k").cast("string"))
    shape = lambda n, v: F.when(F.col("k") % 3 == n, v)
    entry = F.struct(
        shape(0, name).alias("take_id"), shape(1, name).alias("take"), shape(2, name).alias("sequence_id"),
        F.when(F.col("k") % 5 == 0, F.concat(F.lit("dir/"), name)).alias("relative_path"), F.when(F.col("k") % 4 == 0, "failed").alias("status"),
    )
    grouped = pairs.groupBy("ds", "part").agg(
        F.collect_list(entry).alias("takes"), F.count_if(F.col("k") % 4 != 0).alias("ok"), F.count(F.lit(1)).alias("total")
    )
    counts = F.struct(F.col("ok"), (F.col("total") - F.col("ok")).alias("failed"), F.lit(0).cast("bigint").alias("excluded"), F.col("total"))
    return grouped.select("ds", "part", F.to_json(F.struct(F.lit("1").alias("spec_version"), counts.alias("counts"), F.col("takes"))).alias("text"))


@query(
    "s3_index_entries",
    """SELECT DISTINCT l_suppkey AS ds, 't' || l_orderkey AS take_id, CASE WHEN l_orderkey % 5 = 0 THEN 'dir/' ELSE '' END || 't' || l_orderkey AS rel,
    CASE WHEN l_orderkey % 4 = 0 THEN 'failed' ELSE 'ok' END AS status FROM lineitem""",
)
def s3_index_entries(spark, folder):
    return files.index_entries(index_texts(spark, folder), keys=["ds"], text="text")


@query(
    "s3_index_counts",
    "SELECT l_suppkey AS ds, count(DISTINCT l_orderkey) FILTER (l_orderkey % 4 <> 0) AS ok, count(DISTINCT l_orderkey) FILTER (l_orderkey % 4 = 0) AS failed, 0::BIGINT AS excluded, count(DISTINCT l_orderkey) AS total FROM lineitem GROUP BY l_suppkey",
)
def s3_index_counts(spark, folder):
    stated = files.index_counts(index_texts(spark, folder), keys=["ds", "part"], text="text")
    return stated.groupBy("ds").agg(*[F.sum(c).alias(c) for c in ("ok", "failed", "excluded", "total")])


AXES = """wd AS (SELECT l_orderkey AS time, l_linenumber::BIGINT AS n, l_quantity AS a, l_extendedprice AS b, l_discount AS c, l_tax AS d FROM lineitem)"""


def wide_text(spark, folder, names):
    """Line items as a wide text table, as a CSV reader returns it."""
    li = table(spark, folder, "lineitem")
    columns = {n: F.col(c).cast("string") for n, c in names.items()}
    return li.select(F.col("l_orderkey").alias("time"), long("l_linenumber").alias("n"), *[v.alias(k) for k, v in columns.items()])


@query(
    "s5_markers",
    f"""WITH {AXES} SELECT time, n, 'LKNE' AS marker, round(a / 1000, 9) + 0.0 AS x, round(b / 1000, 9) + 0.0 AS y, round(c / 1000, 9) + 0.0 AS z FROM wd
    UNION ALL SELECT time, n, 'R_ANK', round(d / 1000, 9) + 0.0, round(a / 1000, 9) + 0.0, round(b / 1000, 9) + 0.0 FROM wd""",
)
def s5_markers(spark, folder):
    wide = wide_text(spark, folder, {
        "LKNE_x": "l_quantity", "LKNE_y": "l_extendedprice", "LKNE_z": "l_discount", "R_ANK_X": "l_tax", "R_ANK_Y": "l_quantity", "R_ANK_Z": "l_extendedprice",
    })
    rows = tidy.tidy_components(wide, keys=["time", "n"], pattern=r"^(.+)_([xyzXYZ])$", components="xyz", name="marker", scale=1e-3)
    return rows.select("time", "n", "marker", *[r6(c, 9).alias(c) for c in "xyz"])


@query("s6_orientations", f"WITH {AXES} SELECT time, n, 'pelvis' AS sensor, d AS w, a AS x, b AS y, c AS z FROM wd")
def s6_orientations(spark, folder):
    wide = wide_text(spark, folder, {"pelvis_Qx": "l_quantity", "pelvis_Qy": "l_extendedprice", "pelvis_Qz": "l_discount", "pelvis_Qw": "l_tax"})
    return tidy.tidy_components(wide, keys=["time", "n"], pattern=r"^(.+)_[Qq]([wxyzWXYZ])$", components="wxyz", name="sensor")


@query(
    "s7_segments",
    "SELECT o_orderkey AS take, o_orderpriority AS label, o_custkey::DOUBLE AS start_s, o_custkey + 2.5 AS end_s, CASE WHEN o_orderkey % 3 <> 0 THEN 4.5 END AS velocity FROM orders",
)
def s7_segments(spark, folder):
    raw = table(spark, folder, "orders").select(
        F.col("o_orderkey").alias("take"),
        F.col("o_orderpriority").alias("label"),
        F.col("o_custkey").cast("string").alias("temporal_segment_start_[s]"),
        (F.col("o_custkey") + 2.5).cast("string").alias("temporal_segment_end_[s]"),
        F.when(F.col("o_orderkey") % 3 == 0, " ").otherwise("4.5").alias("velocities_[km_h]"),
    )
    return tidy.tidy_segments(raw, label="label", start="temporal_segment_start_[s]", stop="temporal_segment_end_[s]", velocity="velocities_[km_h]")


def binding_texts(spark, folder):
    lines = table(spark, folder, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey")
    li = dealt(lines, task_count(lines), "l_orderkey").groupBy("l_orderkey").agg(
        F.collect_list(F.struct(F.col("l_linenumber").alias("i"), F.col("l_partkey").cast("string").alias("m"))).alias("l")
    )
    markers = F.transform(F.array_sort("l"), lambda e: e["m"])
    sensor = F.when(F.col("l_orderkey") % 2 == 0, F.concat(F.lit("imu"), F.col("l_orderkey").cast("string")))
    body = F.struct(F.struct(markers.alias("marker_names"), sensor.alias("imu_name")).alias("body"))
    return li.select(F.col("l_orderkey").alias("take"), F.to_json(body).alias("text"))


@query("s8_body_sensors", "SELECT DISTINCT l_orderkey AS take, 'body' AS body, 'imu' || l_orderkey AS sensor FROM lineitem WHERE l_orderkey % 2 = 0")
def s8_body_sensors(spark, folder):
    return tidy.bindings(binding_texts(spark, folder), keys=["take"], text="text")[1]


@query("s8_body_markers", "SELECT l_orderkey AS take, 'body' AS body, l_partkey::VARCHAR AS marker, count(*) AS times FROM lineitem GROUP BY ALL")
def s8_body_markers(spark, folder):
    markers, _ = tidy.bindings(binding_texts(spark, folder), keys=["take"], text="text")
    return markers.groupBy("take", "body", "marker").agg(F.count(F.lit(1)).alias("times"))


MOTION = f"""{SERIES}, n AS (SELECT take, count(*) AS found FROM s GROUP BY take)"""


def motion_lines(spark, folder):
    """Every take as a text motion file: a header of four lines, the names, then one line per frame."""
    s = series(spark, folder)
    counts = s.groupBy("take").agg(F.count(F.lit(1)).alias("n"))
    wrong = F.when(F.col("take") % 10 == 0, 1).otherwise(0)
    head = [
        F.lit("take"),
        F.concat(F.lit("nRows="), (F.col("n") + wrong).cast("string")),
        F.when(F.col("take") % 2 == 0, F.lit("inDegrees=yes")).otherwise(F.lit("inDegrees=no")),
        F.lit("endheader"),
        F.lit("time\tangle"),
    ]
    header = counts.select("take", F.posexplode(F.array(*head)).alias("number", "line"))
    body = s.select("take", (F.col("frame") + 5).alias("number"), F.concat_ws("\t", F.col("frame").cast("string"), F.col("x").cast("string")).alias("line"))
    return header.select("take", long("number").alias("number"), "line").unionByName(body)


@query(
    "s9_motion_rows",
    f"""WITH {MOTION} SELECT take, frame AS row, 'time' AS name, frame::DOUBLE AS value FROM s
    UNION ALL SELECT take, frame, 'angle', round(CASE WHEN take % 2 = 0 THEN radians(x) ELSE x END, 6) + 0.0 FROM s""",
)
def s9_motion_rows(spark, folder):
    rows = tidy.motion_rows(motion_lines(spark, folder), file="take", line="line", number="number")
    return rows.select("take", "row", "name", r6("value").alias("value"))


@query("s9_row_count_problems", f"WITH {MOTION} SELECT take, found + 1 AS declared, found FROM n WHERE take % 10 = 0")
def s9_row_count_problems(spark, folder):
    rows = tidy.motion_rows(motion_lines(spark, folder), file="take", line="line", number="number")
    return tidy.row_count_problems(rows, file="take")


LISTING = """ls AS (SELECT doc_id, n_chars AS length, source || '/' || lang || '/' || CASE doc_id % 50 WHEN 1 THEN 'Thumbs.db' WHEN 2 THEN '._' || doc_id WHEN 3 THEN '.' || doc_id || '.ab_1.staging' WHEN 4 THEN '.DS_Store' WHEN 5 THEN '.localized' ELSE doc_id || '.txt' END AS path FROM documents)"""


def listing(spark, folder):
    k, i = F.col("doc_id") % 50, F.col("doc_id").cast("string")
    name = (
        F.when(k == 1, "Thumbs.db").when(k == 2, F.concat(F.lit("._"), i)).when(k == 3, F.concat(F.lit("."), i, F.lit(".ab_1.staging")))
        .when(k == 4, ".DS_Store").when(k == 5, ".localized").otherwise(F.concat(i, F.lit(".txt")))
    )
    return table(spark, folder, "documents").select("doc_id", F.col("n_chars").alias("length"), F.concat_ws("/", "source", "lang", name).alias("path"))


@query("s10_source_files", f"WITH {LISTING} SELECT path, length FROM ls WHERE doc_id % 50 NOT IN (1, 2, 3, 4, 5)")
def s10_source_files(spark, folder):
    return files.source_files(listing(spark, folder), path="path").select("path", "length")


@query("s10_unfinished_files", f"WITH {LISTING} SELECT path FROM ls WHERE doc_id % 50 = 3")
def s10_unfinished_files(spark, folder):
    return files.unfinished_files(listing(spark, folder), path="path").select("path")


@query("s11_checksums", "SELECT doc_id, source AS folder, sha256(text) AS sha256, strlen(text)::BIGINT AS bytes FROM documents")
def s11_checksums(spark, folder):
    docs = table(spark, folder, "documents").select("doc_id", "source", "text")
    hashed, _ = files.checksums(docs, content="text", folder=F.col("source"))
    return hashed.select("doc_id", "folder", "sha256", long("bytes").alias("bytes"))


@query("s11_folder_totals", "SELECT source AS folder, count(*) AS files, sum(strlen(text))::BIGINT AS bytes FROM documents GROUP BY source")
def s11_folder_totals(spark, folder):
    return files.checksums(table(spark, folder, "documents").select("source", "text"), content="text", folder=F.col("source"))[1]


def sums_lines(spark, folder):
    """A checksum list over the documents, with names to escape and some lines that are none."""
    i = F.col("doc_id").cast("string")
    name = F.when(F.col("doc_id") % 4 == 0, F.concat(F.lit("a\\n"), i, F.lit("\n"))).otherwise(F.concat(F.lit("f/"), (F.col("doc_id") % 400).cast("string")))
    line = files.sums_line(F.sha2("text", 256), name)
    return table(spark, folder, "documents").select("doc_id", F.when(F.col("doc_id") % 30 == 7, F.substring(line, 1, 40)).otherwise(line).alias("line"))


@query(
    "s12_parse_sums",
    """SELECT doc_id, doc_id % 30 <> 7 AS valid, CASE WHEN doc_id % 30 <> 7 THEN sha256(text) END AS digest,
    CASE WHEN doc_id % 30 <> 7 THEN CASE WHEN doc_id % 4 = 0 THEN 'a\\n' || doc_id || chr(10) ELSE 'f/' || (doc_id % 400) END END AS name FROM documents""",
)
def s12_parse_sums(spark, folder):
    return files.parse_sums(sums_lines(spark, folder), line="line").select("doc_id", "valid", "digest", "name")


@query(
    "s12_repeated_names",
    "SELECT 'f/' || (doc_id % 400) AS name, count(*) AS times FROM documents WHERE doc_id % 30 <> 7 AND doc_id % 4 <> 0 GROUP BY 1 HAVING count(*) > 1",
)
def s12_repeated_names(spark, folder):
    return files.repeated_names(files.parse_sums(sums_lines(spark, folder), line="line").where("valid"), name="name")


@query(
    "s13_classify_sequences",
    """SELECT 'ds' || (doc_id % 7) AS dataset, source AS subject, 'w' || doc_id || CASE WHEN doc_id % 3 = 0 THEN '' ELSE '_poses' END AS sequence,
    CASE WHEN doc_id % 3 = 0 THEN 'excluded_non_motion' ELSE 'ok' END AS status FROM documents""",
)
def s13_classify_sequences(spark, folder):
    i = F.col("doc_id").cast("string")
    tail = F.when(F.col("doc_id") % 3 == 0, ".npz").otherwise("_poses.npz")
    path = F.concat(F.lit("ds"), (F.col("doc_id") % 7).cast("string"), F.lit("/"), "source", F.lit("/w"), i, tail)
    return files.classify_sequences(table(spark, folder, "documents").select(path.alias("path")), path="path").drop("path")


@query(
    "s17_dataset_profile",
    """SELECT source AS dataset, min(lang) AS mode, string_agg(DISTINCT lang, ',' ORDER BY lang) AS capabilities, count(*) FILTER (doc_id % 4 <> 0) AS ok, count(*) AS total FROM documents GROUP BY source""",
)
def s17_dataset_profile(spark, folder):
    status = F.when(F.col("doc_id") % 4 == 0, "failed").otherwise("ok")
    takes = table(spark, folder, "documents").select(F.col("source").alias("dataset"), F.col("lang").alias("mode"), F.col("lang").alias("cap"), status.alias("status"))
    return files.dataset_profile(takes, dataset="dataset", mode="mode", capability="cap", status="status")


def limitation_copies(spark, folder):
    part = table(spark, folder, "part")
    bundles = F.array_distinct(F.array("p_brand", F.concat(F.lit("Brand#"), (F.col("p_size") % 9).cast("string"))))
    entries = part.select(F.col("p_partkey").alias("id"), F.col("p_type").alias("statement"), bundles.alias("bundles"))
    rendered = files.limitation_rows(entries, bundles="bundles", id_="id").select("bundle", "id", "statement")
    stored = rendered.where("id % 50 <> 0").withColumn("statement", F.when(F.col("id") % 70 == 0, "old").otherwise(F.col("statement")))
    return rendered, stored


LIMITS = """rn AS (SELECT DISTINCT unnest([p_brand, 'Brand#' || (p_size % 9)]) AS bundle, p_partkey AS id, p_type AS statement FROM part)"""


@query("s18_limitation_rows", f"WITH {LIMITS} SELECT bundle, id, statement FROM rn")
def s18_limitation_rows(spark, folder):
    return limitation_copies(spark, folder)[0]


@query(
    "s18_drift",
    f"WITH {LIMITS} SELECT *, 'rendered' AS copy FROM rn WHERE id % 50 = 0 OR (id % 70 = 0 AND statement <> 'old') UNION ALL SELECT bundle, id, 'old', 'stored' FROM rn WHERE id % 50 <> 0 AND id % 70 = 0",
)
def s18_drift(spark, folder):
    return files.drifted(*limitation_copies(spark, folder))


@query(
    "s14_written_bundle",
    f"""WITH {SERIES}, {QUATS} SELECT 'values' AS artifact, site AS source, count(*) AS rows, round(sum(x), 4) + 0.0 AS total FROM s GROUP BY site
    UNION ALL SELECT 'rotations', 'label' || take, count(*), round(sum(w), 4) + 0.0 FROM q GROUP BY take""",
)
def s14_written_bundle(spark, folder):
    """Two artifacts written as partitioned tables after a shape check, and read back."""
    path = scratch(spark, "bundle")
    values = series(spark, folder).select("take", "frame", "x", F.col("site").alias("source"))
    turned = quats(spark, folder).select("take", "frame", "q", F.concat(F.lit("label"), F.col("take").cast("string")).alias("source"))
    problems = values.where("frame is null or x is null")
    archives.write_bundle({"values": values, "rotations": turned}, path, partition_by=["source"], problems=problems)

    def summed(name, schema, value):
        back = archives.load_frames(spark, f"{path}/{name}", schema)
        return back.groupBy(F.lit(name).alias("artifact"), "source").agg(F.count(F.lit(1)).alias("rows"), r6(F.sum(value), 4).alias("total"))

    return summed("values", values.schema, F.col("x")).unionByName(summed("rotations", turned.schema, F.col("q.w")))
