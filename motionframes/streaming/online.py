"""The window, run, duplicate, outlier and verification rules on a stream of frames (ST1-ST5)."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from ..operators.blocks import running
from ..operators.catalog import split_by_trust


def as_event_time(df: DataFrame, column: str) -> DataFrame:
    """Watermarks need a zoned timestamp."""
    return df.withColumn(column, F.col(column).cast("timestamp"))


def _window(time: str, width: str, slide: str | None) -> Column:
    return F.window(time, width, slide) if slide else F.window(time, width)


def _counts(status: str) -> list[Column]:
    return [
        F.count(F.lit(1)).alias("rows"),
        F.count_if(F.col(status) == "UNAVAILABLE").alias("unavailable"),
        F.count_if(F.col(status) == "INTERPOLATED").alias("interpolated"),
    ]


def _judged(counts: DataFrame, keys: Sequence[str], max_fraction: float) -> DataFrame:
    share = F.col("interpolated") / F.col("rows")
    return counts.select(*keys, "start", "end", "rows", share.alias("fraction"), ((F.col("unavailable") == 0) & (share <= max_fraction)).alias("accepted"))


def quality_windows(
    df: DataFrame, *, keys: Sequence[str], time: str, status: str, delay: str, width: str, slide: str | None, max_fraction: float
) -> DataFrame:
    """ST1 for sinks that only append. Acceptance of time windows: no unavailable row and a bounded interpolated share.

    A window is emitted once, when the watermark has passed it; rows that come later are dropped, and windows
    open when the stream ends stay in its state. ``window_parts`` loses neither.
    """
    counts = df.withWatermark(time, delay).groupBy(*keys, _window(time, width, slide).alias("w")).agg(*_counts(status))
    return _judged(counts.withColumns({"start": F.col("w.start"), "end": F.col("w.end")}), keys, max_fraction)


def window_parts(rows: DataFrame, *, keys: Sequence[str], time: str, status: str, width: str, slide: str | None) -> DataFrame:
    """ST1. What the rows of one micro-batch add to each window."""
    counts = rows.groupBy(*keys, _window(time, width, slide).alias("w")).agg(*_counts(status))
    return counts.select(*keys, F.col("w.start").alias("start"), F.col("w.end").alias("end"), "rows", "unavailable", "interpolated")


def merged_windows(parts: DataFrame, *, keys: Sequence[str], max_fraction: float) -> DataFrame:
    """ST1. The windows of all parts: the same for every order of the rows and every cut into batches."""
    counts = parts.groupBy(*keys, "start", "end").agg(*[F.sum(c).alias(c) for c in ("rows", "unavailable", "interpolated")])
    return _judged(counts, keys, max_fraction)


def activity_runs(df: DataFrame, *, keys: Sequence[str], time: str, delay: str, gap: str) -> DataFrame:
    """ST2 for sinks that only append, with the losses of ``quality_windows``: session windows closed by a gap."""
    return run_parts(df.withWatermark(time, delay), keys=keys, time=time, gap=gap)


def run_parts(rows: DataFrame, *, keys: Sequence[str], time: str, gap: str) -> DataFrame:
    """ST2. Contiguous activity per key among the rows given: session windows closed by a gap."""
    runs = rows.groupBy(*keys, F.session_window(time, gap).alias("w")).agg(F.count(F.lit(1)).alias("rows"))
    return runs.select(*keys, F.col("w.start").alias("start"), F.col("w.end").alias("end"), "rows")


def merged_runs(parts: DataFrame, *, keys: Sequence[str], rows: int) -> DataFrame:
    """ST2. The sessions of all parts (each with its number ``epoch``): those that overlap are one.

    A part ends where its gap has passed, so one that begins no later than the latest end of those before it joins
    them. Parts are scanned in blocks of ``rows`` microseconds, so a busy key is spread over tasks.
    """
    at = parts.withColumns({"_at": F.unix_micros("start"), "_end": F.unix_micros("end")})
    scan = {"keys": keys, "frame": "_at", "ties": ["_end", "epoch"], "rows": rows}
    at = running(at, scans={"_upto": ("max", F.col("_end"))}, **scan)
    at = running(at, scans={"_before": ("previous", F.col("_upto"))}, **scan)
    begins = F.coalesce(F.col("_at") > F.col("_before"), F.lit(True)).cast("long")
    at = running(at, scans={"_run": ("sum", begins)}, **scan)
    found = at.groupBy(*keys, "_run").agg(F.min("start").alias("start"), F.max("end").alias("end"), F.sum("rows").alias("rows"))
    return found.drop("_run")


def keep_parts(stream: DataFrame, part: Callable[[DataFrame], DataFrame], *, path: str, checkpoint: str) -> StreamingQuery:
    """ST1, ST2. Writes the part of each micro-batch under its number, which a batch that runs again replaces.

    The parts are the whole state: there is no watermark, so late rows count and nothing is open at the end.
    They are as many as windows per batch; writing their merged form back as one part keeps them few.
    """

    def batch(rows: DataFrame, epoch: int) -> None:
        part(rows).write.mode("overwrite").parquet(f"{path}/epoch={epoch}")

    return stream.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def without_resent(df: DataFrame, *, keys: Sequence[str], time: str, delay: str) -> DataFrame:
    """ST3. Rows sent again within the watermark are dropped."""
    return df.withWatermark(time, delay).dropDuplicatesWithinWatermark(list(keys))


class _StepJudge(StatefulProcessor):
    """Keeps the last frame and value of a key and judges each new row against it."""

    def __init__(self, keys: Sequence[str], frame: str, value: str, dt_s: float, max_speed: float) -> None:
        self.keys, self.frame, self.value, self.dt_s, self.max_speed = list(keys), frame, value, dt_s, max_speed

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.last = handle.getValueState("last", "frame bigint, value double")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        # One key's rows of one micro-batch, which the source's rate limit bounds.
        batch = pd.concat(list(rows)).sort_values(self.frame, kind="stable")
        frames, values = batch[self.frame].to_numpy(np.int64), batch[self.value].to_numpy(np.float64)
        fast = np.zeros(len(frames), bool)
        known = self.last.get()
        late = 0 if known is None else int(np.searchsorted(frames, known[0], side="right"))
        # Late and repeated frames aren't judged.
        at = late + np.unique(frames[late:], return_index=True)[1]
        if len(at):
            f, v = frames[at], values[at]
            if known is not None:
                f, v = np.r_[np.int64(known[0]), f], np.r_[float(known[1]), v]
            fast[at[-(len(f) - 1) :] if len(f) > 1 else at[:0]] = np.abs(np.diff(v)) / (np.diff(f) * self.dt_s) > self.max_speed
            self.last.update((int(f[-1]), float(v[-1])))
        out = {k: [part] * len(frames) for k, part in zip(self.keys, key)}
        yield pd.DataFrame({**out, self.frame: frames, "fast": fast})

    def close(self) -> None:
        pass


def online_outliers(
    df: DataFrame, *, keys: Sequence[str], frame: str, value: str, dt_s: float, max_speed: float
) -> DataFrame:
    """ST4. Steps too fast against the row before, which is kept in state (RocksDB state store)."""
    schema = T.StructType([df.schema[k] for k in keys] + [T.StructField(frame, T.LongType()), T.StructField("fast", T.BooleanType())])
    return df.groupBy(*keys).transformWithStateInPandas(
        statefulProcessor=_StepJudge(keys, frame, value, dt_s, max_speed), outputStructType=schema, outputMode="append", timeMode="None"
    )


def verify_new(
    stream: DataFrame, ledger: Callable[[], DataFrame], *, key: str, digests: Sequence[str], sink: Callable[[DataFrame, int], None], checkpoint: str
) -> StreamingQuery:
    """ST5. Each micro-batch is split by the ledger; only what it does not trust goes to ``sink``."""

    def batch(rows: DataFrame, epoch: int) -> None:
        fresh = split_by_trust(rows, ledger(), key=key, digests=digests, full=False).where(~F.col("trusted"))
        sink(fresh, epoch)

    return stream.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
