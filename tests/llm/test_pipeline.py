from collections import Counter

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from motionframes.llm import langid, mixing, toxicity
from motionframes.llm.common import remainder

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def docs(spark):
    extra = spark.createDataFrame(
        [(None, "the end of the thing and that", "en", "src1", 3), (9001, None, None, None, None), (9002, "", "en", "src0", 0), (9003, "12 ?!", "en", "src0", 0)],
        "doc_id long, text string, lang string, source string, n_chars long",
    )
    twice = spark.read.parquet(f"{FOLDER}/documents.parquet").limit(3)
    return spark.read.parquet(f"{FOLDER}/documents.parquet").unionByName(twice).unionByName(extra).cache()


def rows(frame):
    return Counter(tuple(r) for r in frame.collect())


def test_toxicity(spark, docs):
    kept = corpus_pipeline.drop_toxic(spark, docs, FOLDER)
    assert kept.columns == docs.columns
    given = spark.read.parquet(f"{FOLDER}/documents.parquet")
    model = toxicity.train(given, spark.read.parquet(f"{FOLDER}/labels.parquet"), remainder(F.col("doc_id"), 3) != 1)
    reader = toxicity.Reader(model.network) if model.network else None
    all_ = docs.collect()
    score = model.scores(reader, [r.text for r in all_])
    assert rows(kept) == Counter(tuple(r) for r, s in zip(all_, score) if s < toxicity.THRESHOLD)


def test_language(spark, docs):
    kept = rows(corpus_pipeline.keep_languages(spark, docs, FOLDER))
    assert not kept - rows(docs)
    assert all(langid.words_of(r[1]) for r in kept)
    assert sum(kept.values()) > 0.95 * docs.count()


def test_near_duplicates(spark, docs):
    from test_minhash import brute

    kept = rows(corpus_pipeline.drop_near_duplicates(spark, docs, FOLDER))
    want = {i for i, _, _, ok in brute([(r.doc_id, r.text) for r in docs.collect() if r.doc_id is not None]) if ok}
    assert sorted(r[0] for r in kept if r[0] is not None) == sorted(want)
    assert set(kept.values()) == {1} and any(r[0] is None for r in kept)


def test_mixing(spark, docs):
    chosen = corpus_pipeline.mix_sources(spark, docs, FOLDER)
    assert chosen.columns == docs.columns
    assert rows(chosen) == rows(mixing.mixed(docs, mixing.Mix()).select(docs.columns)) and not set(rows(chosen)) - set(rows(docs))


def test_run_and_empty_tables(spark, tmp_path):
    found = corpus_pipeline.run(spark, FOLDER)
    assert found.columns == ["doc_id", "ids", "n_ids", "round_trip"] and found.where("not round_trip").count() == 0 and found.count() > 0
    for name in ("documents", "labels"):
        spark.read.parquet(f"{FOLDER}/{name}.parquet").limit(0).write.parquet(f"{tmp_path}/{name}.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
