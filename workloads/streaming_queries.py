"""The events as a stream, run to its end (ST1-ST4). Results go to a table in the checkpoint folder."""

from __future__ import annotations

from pyspark.sql import functions as F

from motionframes.streaming import online

from .base import GAPPY, query, r6, scratch, table
from .diff_queries import ASSETS, KEYS4, assets_v1, assets_v2

STORE = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def events_stream(spark, folder):
    """Events as a file stream: take, frame (event id), time, value and status."""
    schema = table(spark, folder, "events").schema
    return observed(spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(folder))


def observed(events):
    status = F.when(F.expr(GAPPY), F.when(F.col("event_id") % 14 < 2, "UNAVAILABLE").otherwise("INTERPOLATED")).otherwise("OBSERVED")
    return online.as_event_time(events, "ts").select(
        F.col("user_id").alias("take"), F.col("event_id").alias("frame"), "ts", F.col("value").alias("x"), status.alias("status")
    )


def run_to_end(df):
    """Write what the stream emits until its input is used up, and read it back."""
    spark = df.sparkSession
    base = scratch(spark, "stream")
    writer = df.writeStream.format("parquet").outputMode("append").option("path", f"{base}/out")
    writer.option("checkpointLocation", f"{base}/check").trigger(availableNow=True).start().awaitTermination()
    return spark.read.schema(df.schema).parquet(f"{base}/out")


STATUS = f"CASE WHEN {GAPPY} THEN CASE WHEN event_id % 14 < 2 THEN 'UNAVAILABLE' ELSE 'INTERPOLATED' END ELSE 'OBSERVED' END"
DAYS = f"""WITH w AS (SELECT user_id AS take, epoch_us(ts) // 86400000000 AS d, count(*) AS rows, count(*) FILTER ({STATUS} = 'UNAVAILABLE') AS u, count(*) FILTER ({STATUS} = 'INTERPOLATED') AS i FROM events GROUP BY ALL)
    SELECT take, d AS day, rows, round(i / rows, 6) + 0.0 AS fraction, u = 0 AND i / rows <= 0.3 AS accepted FROM w"""
SESSIONS = """WITH t AS (SELECT user_id AS take, epoch_us(ts) AS t FROM events), g AS (SELECT *, CASE WHEN t - lag(t) OVER (PARTITION BY take ORDER BY t) <= 43200000000 THEN 0 ELSE 1 END AS n FROM t),
    k AS (SELECT *, sum(n) OVER (PARTITION BY take ORDER BY t ROWS UNBOUNDED PRECEDING) AS s FROM g)
    SELECT take, min(t) AS start_us, count(*) AS rows FROM k GROUP BY take, s"""


def scattered(spark, folder):
    """The events in files that each cover the whole time, one a micro-batch: most rows come late."""
    path = scratch(spark, "scattered")
    events = table(spark, folder, "events")
    events.repartition(4, F.xxhash64("event_id") % 4).write.parquet(path)
    return observed(spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 1).parquet(path))


def parts_of(stream, part):
    """Runs the stream to its end and reads the parts of all micro-batches."""
    spark = stream.sparkSession
    base = scratch(spark, "parts")
    online.keep_parts(stream, part, path=f"{base}/out", checkpoint=f"{base}/check").awaitTermination()
    return spark.read.schema(part(stream).schema.add("epoch", "long")).parquet(f"{base}/out")


def day_windows(stream):
    parts = parts_of(stream, lambda rows: online.window_parts(rows, keys=["take"], time="ts", status="status", width="1 day", slide=None))
    found = online.merged_windows(parts, keys=["take"], max_fraction=0.3)
    return found.select("take", F.expr("unix_micros(start) div 86400000000L").alias("day"), "rows", r6("fraction").alias("fraction"), "accepted")


def starts(stream):
    parts = parts_of(stream, lambda rows: online.run_parts(rows, keys=["take"], time="ts", gap="12 hours"))
    found = online.merged_runs(parts, keys=["take"], rows=30 * 86_400_000_000)
    return found.select("take", F.unix_micros("start").alias("start_us"), "rows")


@query("st1_quality_windows", DAYS)
def st1_quality_windows(spark, folder):
    return day_windows(events_stream(spark, folder))


@query("st1_all_quality_windows", DAYS)
def st1_all_quality_windows(spark, folder):
    """The same windows when most rows come late."""
    return day_windows(scattered(spark, folder))


@query("st2_activity_runs", SESSIONS)
def st2_activity_runs(spark, folder):
    return starts(events_stream(spark, folder))


@query("st2_all_activity_runs", SESSIONS)
def st2_all_activity_runs(spark, folder):
    """The same sessions when most rows come late and many parts meet in one."""
    return starts(scattered(spark, folder))


@query("st3_without_resent", "SELECT user_id AS take, event_id AS frame FROM events")
def st3_without_resent(spark, folder):
    """The stream with every row sent twice."""
    stream = events_stream(spark, folder)
    twice = stream.withColumn("copy", F.explode(F.array(F.lit(1), F.lit(2))))
    return run_to_end(online.without_resent(twice, keys=["take", "frame"], time="ts", delay="1 hour")).select("take", "frame")


@query(
    "st4_online_outliers",
    """WITH n AS (SELECT user_id AS take, event_id AS frame, abs(value - lag(value) OVER w) / (event_id - lag(event_id) OVER w) > 3.0 AS fast FROM events WINDOW w AS (PARTITION BY user_id ORDER BY event_id))
    SELECT take, frame, coalesce(fast, false) AS fast FROM n""",
)
def st4_online_outliers(spark, folder):
    before = spark.conf.get(STORE)
    spark.conf.set(STORE, ROCKSDB)
    try:
        out = online.online_outliers(events_stream(spark, folder), keys=["take"], frame="frame", value="x", dt_s=1.0, max_speed=3.0)
        return run_to_end(out)
    finally:
        spark.conf.set(STORE, before)


@query(
    "st5_incremental_verification",
    f"""WITH {ASSETS}, lg AS (SELECT * FROM v1 WHERE idx % 4 <> 0) SELECT v2.asset_id, v2.sha256 FROM v2 LEFT JOIN lg ON lg.asset_id = v2.asset_id
    WHERE NOT coalesce(v2.sha256 = lg.sha256 AND v2.bytes = lg.bytes AND v2.source = lg.source AND v2.spec_version = lg.spec_version, false)""",
)
def st5_incremental_verification(spark, folder):
    """New assets arriving as files; each batch keeps what the ledger does not trust."""
    path = scratch(spark, "verify")
    assets_v2(spark, folder).write.parquet(f"{path}/in")
    ledger = assets_v1(spark, folder).withColumn("status", F.when(F.col("idx") % 4 == 0, "FAIL").otherwise("PASS"))
    arriving = spark.readStream.schema(assets_v2(spark, folder).schema).parquet(f"{path}/in")
    fresh = lambda df, epoch: df.select("asset_id", "sha256").write.mode("overwrite").parquet(f"{path}/out/epoch={epoch}")
    online.verify_new(
        arriving, lambda: ledger, key="asset_id", digests=KEYS4, sink=fresh, checkpoint=f"{path}/check"
    ).awaitTermination()
    return spark.read.schema("asset_id string, sha256 string").parquet(f"{path}/out").select("asset_id", "sha256")
