"""A training corpus from raw documents: toxicity, language, near-duplicates, mixing, encoding.

Each stage takes (spark, docs, sf_dir), works on all that the stage before it kept and returns a DataFrame, which run() writes as Parquet
and reads again as the next one's docs. All but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from motionframes.llm import langid, minhash, mixing, pieces, toxicity
from motionframes.llm.common import remainder, saved, table

#: A document whose language is less certain than this is rejected.
LEAST_CERTAIN = 0.5

#: The classifiers' and the forest's decisions can't be expressed in SQL; tests compare each stage with a brute-force version.
ORACLE_SQL = None


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Learns from the labelled part of the given documents; rejects what scores as toxic."""
    given = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.train(given, table(spark, sf_dir, "labels"), remainder(F.col("doc_id"), 3) != 1)
    return toxicity.judged(docs, model).where(F.col("tox_score") < toxicity.THRESHOLD).drop("tox_score")


def keep_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects texts without a letter or with an uncertain language."""
    given = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    found = langid.identified(docs, langid.train(given, langid.trainable()))
    return found.where((F.col("lid.lang_pred") != "und") & (F.col("lid.score") >= LEAST_CERTAIN)).drop("lid")


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group stays, that with the smallest id; rows with a null id stay, of an id's repeated rows one for each of its texts."""
    fate = minhash.near_duplicates(docs.select("doc_id", "text"))
    counts = saved(fate.where("doc_id is not null").groupBy("doc_id").agg(F.bool_or("kept").alias("kept"), F.count("*").alias("rows")), "pipeline-fate")
    gone = saved(counts.where("not kept").select("doc_id"), "pipeline-gone")
    twice = saved(counts.where("kept and rows > 1").select("doc_id"), "pipeline-twice")
    kept = docs.join(gone, "doc_id", "left_anti")
    once = kept.join(twice, "doc_id", "left_anti")
    first = kept.join(twice, "doc_id", "left_semi").dropDuplicates(["doc_id", "text"])
    return once.unionByName(first).select(docs.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents by the target weights; those that a leaf reads twice come twice."""
    return mixing.mixed(docs, mixing.Mix()).select(docs.columns)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pieces.encoded(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("language", keep_languages),
    ("near duplicates", drop_near_duplicates),
    ("mixing", mix_sources),
    ("encoding", encode),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = saved(stage(spark, docs, sf_dir), f"stage-{name.replace(' ', '-')}")
    return STAGES[-1][1](spark, docs, sf_dir)
