"""Streaming forms against their batch results."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from motionframes.streaming import online

T0 = dt.datetime(2024, 1, 1)


def frames(spark, path):
    rows = []
    for take in ("a", "b"):
        for f in range(60):
            status = "INTERPOLATED" if f % 7 == 0 else "OBSERVED"
            jump = 50.0 if f % 20 == 13 else 0.0
            rows.append((take, f, T0 + dt.timedelta(seconds=f + (300 if f >= 40 else 0)), status, float(f) + jump))
    df = spark.createDataFrame(rows, "take string, frame long, ts timestamp_ntz, status string, x double")
    df.where("frame < 30").coalesce(1).write.parquet(path)
    df.where("frame >= 30").coalesce(1).write.mode("append").parquet(path)
    # A far later row moves the watermark past every window.
    late = spark.createDataFrame([("end", 0, T0 + dt.timedelta(days=1), "OBSERVED", 0.0)], df.schema)
    late.coalesce(1).write.mode("append").parquet(path)
    return df.schema


def stream(spark, path, schema):
    return online.as_event_time(spark.readStream.schema(schema).parquet(path), "ts")


def run(df, name, tmp_path, mode="append"):
    q = df.writeStream.format("memory").queryName(name).outputMode(mode)
    q = q.option("checkpointLocation", str(tmp_path / f"check_{name}")).start()
    try:
        q.processAllAvailable()
    finally:
        q.stop()
    return df.sparkSession.table(name)


def test_windows_sessions_and_duplicates(spark, tmp_path):
    path = str(tmp_path / "frames")
    schema = frames(spark, path)
    batch = online.as_event_time(spark.read.parquet(path), "ts").where("take <> 'end'")

    out = run(
        online.quality_windows(stream(spark, path, schema), keys=["take"], time="ts", status="status", delay="10 minutes", width="10 seconds", slide=None, max_fraction=0.15),
        "st_windows", tmp_path,
    ).where("take <> 'end'")
    expected = batch.groupBy("take", F.window("ts", "10 seconds").alias("w")).agg(F.count(F.lit(1)).alias("rows"), F.avg((F.col("status") == "INTERPOLATED").cast("double")).alias("s"))
    want = {(r.take, r.w.start, r.rows, r.s <= 0.15) for r in expected.collect()}
    assert {(r.take, r.start, r.rows, r.accepted) for r in out.collect()} == want

    sessions = run(online.activity_runs(stream(spark, path, schema), keys=["take"], time="ts", delay="10 minutes", gap="1 minute"), "st_runs", tmp_path)
    assert sorted((r.take, r.rows) for r in sessions.where("take <> 'end'").collect()) == [("a", 20), ("a", 40), ("b", 20), ("b", 40)]

    spark.read.parquet(path).where("frame < 5").coalesce(1).write.mode("append").parquet(path)
    once = run(online.without_resent(stream(spark, path, schema), keys=["take", "frame"], time="ts", delay="2 days"), "st_once", tmp_path)
    assert once.where("take <> 'end'").count() == 120


def test_incremental_verification(spark, tmp_path):
    path = str(tmp_path / "takes")
    takes = spark.createDataFrame([(f"t{i}", f"d{i}") for i in range(10)], "take string, digest string")
    takes.write.parquet(path)
    ledger = spark.createDataFrame([(f"t{i}", f"d{i}", "PASS" if i < 4 else "FAIL") for i in range(6)], "take string, digest string, status string")
    out = str(tmp_path / "fresh")
    query = online.verify_new(
        spark.readStream.schema(takes.schema).parquet(path), lambda: ledger, key="take", digests=["digest"],
        sink=lambda df, epoch: df.select("take").write.mode("append").parquet(out), checkpoint=str(tmp_path / "check"),
    )
    query.awaitTermination(120)
    assert sorted(r.take for r in spark.read.parquet(out).collect()) == [f"t{i}" for i in range(4, 10)]


def test_every_event_is_in_a_window_and_a_session_when_the_stream_ends(spark):
    from workloads import streaming_queries as queries

    folder = "/root/testdata/sf0.001"
    events = spark.read.parquet(f"{folder}/events.parquet").where("ts IS NOT NULL").count()
    for name in ("st1_all_quality_windows", "st2_all_activity_runs"):
        found = getattr(queries, name)(spark, folder).collect()
        assert sum(r["rows"] for r in found) == events
        assert len({tuple(r)[:2] for r in found}) == len(found)


@pytest.mark.parametrize("block_us", [7_000_000, 10**12])
def test_parts_merge_to_the_batch_result(spark, tmp_path, block_us):
    """Rows dealt over micro-batches in any order, repeated times, sessions that only a later part connects, no row at all for a batch."""
    r = random.Random(3)
    rows = [(take, T0 + dt.timedelta(seconds=r.randrange(0, 900)), r.choice(["OBSERVED", "INTERPOLATED", "UNAVAILABLE"])) for take in ("a", "a", "a", "b") for _ in range(40)]
    rows += [("c", None, "OBSERVED")]
    frame = online.as_event_time(spark.createDataFrame(rows, "take string, ts timestamp_ntz, status string"), "ts")
    frame.repartition(5).write.parquet(f"{tmp_path}/in")
    frame.where("false").coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
    stream = spark.readStream.schema(frame.schema).option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in")
    shares = {"keys": ["take"], "time": "ts", "status": "status", "width": "1 minute", "slide": "30 seconds"}
    gap = {"keys": ["take"], "time": "ts", "gap": "10 seconds"}
    parts = {}
    for name, part in (("windows", lambda rows: online.window_parts(rows, **shares)), ("runs", lambda rows: online.run_parts(rows, **gap))):
        online.keep_parts(stream, part, path=f"{tmp_path}/{name}", checkpoint=f"{tmp_path}/{name}-check").awaitTermination()
        parts[name] = spark.read.schema(part(frame).schema.add("epoch", "long")).parquet(f"{tmp_path}/{name}")
    assert parts["runs"].select("epoch").distinct().count() > 1
    found = online.merged_windows(parts["windows"], keys=["take"], max_fraction=0.5)
    assert sorted(found.collect()) == sorted(online.merged_windows(online.window_parts(frame, **shares), keys=["take"], max_fraction=0.5).collect())
    runs = online.merged_runs(parts["runs"], keys=["take"], rows=block_us)
    assert sorted(runs.collect()) == sorted(online.run_parts(frame, **gap).collect())
