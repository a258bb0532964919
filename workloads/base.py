"""Query registry and the frame tables that the registered queries derive from the given tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from motionframes.functions import quat as Q
from motionframes.operators.blocks import dense_frames
from motionframes.session import checkpoint_dir

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def r6(value: Column | str, digits: int = 6) -> Column:
    """Rounded double without a negative zero."""
    value = F.col(value) if isinstance(value, str) else value
    return F.round(value.cast("double"), digits) + F.lit(0.0)


def long(value: Column | str) -> Column:
    value = F.col(value) if isinstance(value, str) else value
    return value.cast("bigint")


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder below the checkpoint folder."""
    return f"{checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}"


# One bucket per hour: the unit in which a user's events are ranked.
HOUR_US = 3_600_000_000


def series(spark: SparkSession, folder: str) -> DataFrame:
    """Events as frames: take = user, frame = rank by time, t_s = seconds from the take's start."""
    events = table(spark, folder, "events").select(
        F.col("user_id").alias("take"),
        F.col("event_type").alias("site"),
        F.col("value").alias("x"),
        "event_id",
        F.unix_micros(F.col("ts").cast("timestamp")).alias("t_us"),
    )
    framed = dense_frames(
        events,
        keys=["take"],
        order=["t_us", "event_id"],
        minima={"_t0": F.col("t_us")},
    )
    return framed.withColumn("t_s", (F.col("t_us") - F.col("_t0")) / F.lit(1e6)).drop("_t0")


SERIES = """s AS (
  SELECT user_id AS take, event_type AS site, value AS x, event_id, epoch_us(ts) AS t_us,
         row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1 AS frame,
         (epoch_us(ts) - min(epoch_us(ts)) OVER (PARTITION BY user_id)) / 1e6 AS t_s
  FROM events)"""

# Fixed test pattern: which events of the series are missing.
GAPPY = "event_id % 7 < 2"


def gappy(spark: SparkSession, folder: str) -> DataFrame:
    """The series with some values missing and an observed flag."""
    s = series(spark, folder)
    return s.withColumn("x", F.expr(f"if({GAPPY}, null, x)")).withColumn("ok", F.expr(f"not ({GAPPY})"))


GAPPY_SQL = SERIES + f""", g AS (
  SELECT * REPLACE (CASE WHEN {GAPPY} THEN NULL ELSE x END AS x), NOT ({GAPPY}) AS ok FROM s)"""


def quats(spark: SparkSession, folder: str) -> DataFrame:
    """Four embedding components as a unit quaternion per frame: take = label, frame = rank by id."""
    e = table(spark, folder, "embeddings").select("vec_id", F.col("label").alias("take"), "embedding")
    parts = [F.col("embedding")[i].cast("double") for i in range(14)]
    raw = e.select(
        "vec_id",
        "take",
        Q.normalise(Q.quat(*parts[:4])).alias("q"),
        Q.vec(*parts[4:7]).alias("v"),
        Q.vec(*parts[7:10]).alias("u"),
        Q.normalise(Q.quat(*parts[10:14])).alias("p"),
    )
    return dense_frames(raw, keys=["take"], order=["vec_id"])


QUATS = """q0 AS (
  SELECT vec_id, label AS take, row_number() OVER (PARTITION BY label ORDER BY vec_id) - 1 AS frame,
         embedding[1]::DOUBLE a, embedding[2]::DOUBLE b, embedding[3]::DOUBLE c, embedding[4]::DOUBLE d,
         embedding[5]::DOUBLE vx, embedding[6]::DOUBLE vy, embedding[7]::DOUBLE vz,
         embedding[8]::DOUBLE ux, embedding[9]::DOUBLE uy, embedding[10]::DOUBLE uz,
         embedding[11]::DOUBLE e, embedding[12]::DOUBLE f, embedding[13]::DOUBLE g, embedding[14]::DOUBLE h FROM embeddings),
q AS (
  SELECT vec_id, take, frame, a / n AS w, b / n AS x, c / n AS y, d / n AS z, vx, vy, vz, ux, uy, uz,
         e / m AS pw, f / m AS px, g / m AS py, h / m AS pz
  FROM (SELECT *, sqrt(a * a + b * b + c * c + d * d) AS n, sqrt(e * e + f * f + g * g + h * h) AS m FROM q0))"""


MARKERS = ("m0", "m1", "m2", "m3")


def points(spark: SparkSession, folder: str) -> DataFrame:
    """Three embedding components as marker positions: four markers per frame, five takes.

    Fixed test pattern: some markers sit at the exact origin (the occlusion sentinel).
    """
    e = table(spark, folder, "embeddings")
    hidden = F.col("vec_id") % 23 == 5
    xyz = [F.when(hidden, 0.0).otherwise(F.col("embedding")[i].cast("double")) for i in (4, 5, 6)]
    return e.select(
        F.expr("(vec_id div 4L) % 5L").alias("take"),
        F.expr("(vec_id div 4L) div 5L").alias("frame"),
        F.concat(F.lit("m"), (F.col("vec_id") % 4).cast("string")).alias("marker"),
        xyz[0].alias("x"),
        xyz[1].alias("y"),
        xyz[2].alias("z"),
        "vec_id",
    )


POINTS = """p AS (
  SELECT (vec_id // 4) % 5 AS take, (vec_id // 4) // 5 AS frame, 'm' || (vec_id % 4) AS marker, vec_id,
         CASE WHEN vec_id % 23 = 5 THEN 0.0 ELSE embedding[5]::DOUBLE END AS x,
         CASE WHEN vec_id % 23 = 5 THEN 0.0 ELSE embedding[6]::DOUBLE END AS y,
         CASE WHEN vec_id % 23 = 5 THEN 0.0 ELSE embedding[7]::DOUBLE END AS z
  FROM embeddings)"""


SITES = (("hip", 1), ("knee", 4))


def small_frames(spark: SparkSession, folder: str) -> DataFrame:
    """Two sites per frame, each with a rotation and a validity flag."""
    e = table(spark, folder, "embeddings")
    cells = [
        F.struct(
            F.lit(site).alias("site"),
            Q.normalise(Q.quat(*[F.col("embedding")[16 + 4 * k + i].cast("double") for i in range(4)])).alias("q"),
        )
        for k, (site, _) in enumerate(SITES)
    ]
    raw = dense_frames(
        e.select("vec_id", F.col("label").alias("take"), F.array(*cells).alias("c")),
        keys=["take"],
        order=["vec_id"],
    )
    return raw.select("take", "frame", (F.col("vec_id") % 11 > 0).alias("valid"), F.inline("c"))


def large_frames(spark: SparkSession, folder: str) -> DataFrame:
    """Two joints per frame with their global rotation."""
    e = table(spark, folder, "embeddings")
    cells = [
        F.struct(
            F.lit(joint).alias("joint"),
            Q.normalise(Q.quat(*[F.col("embedding")[24 + 4 * k + i].cast("double") for i in range(4)])).alias("g"),
        )
        for k, (_, joint) in enumerate(SITES)
    ]
    raw = dense_frames(
        e.select("vec_id", F.col("label").alias("take"), F.array(*cells).alias("c")),
        keys=["take"],
        order=["vec_id"],
    )
    return raw.select("take", "frame", F.inline("c"))


def site_joint(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(list(SITES), "site string, joint int")


def _unit_sql(first: int, prefix: str) -> str:
    cells = [f"embedding[{first + i}]::DOUBLE" for i in range(4)]
    length = "sqrt(" + " + ".join(f"{c} * {c}" for c in cells) + ")"
    return ", ".join(f"{c} / {length} AS {prefix}{a}" for c, a in zip(cells, "wxyz"))


STREAMS = f"""st AS (
  SELECT label AS take, row_number() OVER (PARTITION BY label ORDER BY vec_id) - 1 AS frame, vec_id % 11 > 0 AS valid, 'hip' AS site,
         {_unit_sql(17, 's')}, {_unit_sql(25, 'g')} FROM embeddings
  UNION ALL
  SELECT label, row_number() OVER (PARTITION BY label ORDER BY vec_id) - 1, vec_id % 11 > 0, 'knee',
         {_unit_sql(21, 's')}, {_unit_sql(29, 'g')} FROM embeddings)"""
