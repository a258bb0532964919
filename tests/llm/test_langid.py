import itertools
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from motionframes.llm import langid


def segmentations(word, pieces):
    """Probability of a word as the sum over all its segmentations, by listing them."""
    total = 0.0
    for cuts in itertools.product([0, 1], repeat=len(word) - 1):
        parts, start = [], 0
        for i, c in enumerate(cuts, 1):
            if c:
                parts.append(word[start:i])
                start = i
        parts.append(word[start:])
        options = [pieces.get(p, 0.0) + (langid.UNKNOWN if len(p) == 1 else 0.0) for p in parts]
        total += math.prod(options)
    return total


@pytest.fixture(scope="module")
def toy():
    pieces = ["▁", "a", "b", "ab", "▁a", "ba", "▁ab", "aba"]
    p = np.array([[0.1, 0.2, 0.05, 0.1, 0.2, 0.1, 0.15, 0.1], [0.3, 0.1, 0.2, 0.05, 0.05, 0.1, 0.1, 0.1]]).T
    return pieces, p, langid.Model(["x", "y"], langid.Lattice(pieces), p * langid.SCALE ** np.array([len(t) for t in pieces], float)[:, None], np.zeros(2))


def test_forward_sums_all_segmentations(toy):
    pieces, p, model = toy
    words = ["a", "ab", "abab", "bbaab", "aébà", "z"]
    found = model.score_words(words)
    for word, row in zip(words, found):
        for k in range(2):
            assert row[k] == pytest.approx(math.log(segmentations("▁" + word, dict(zip(pieces, p[:, k])))), rel=1e-9)


def test_long_words_are_whole(toy):
    found = toy[2].score_words(["ab" * 5000, "q" * 100])
    assert np.isfinite(found).all() and found[0][0] < 5000 * math.log(0.5)


def test_expected_uses(toy):
    pieces, p, model = toy
    sizes, ends = model.lattice.arcs(["▁abab"])
    used = langid.expected(sizes, ends, model.scaled, np.ones((1, 2)))
    for k in range(2):
        table, word = dict(zip(pieces, p[:, k])), "▁abab"
        whole = segmentations(word, table)
        for piece, n in zip(pieces, used[:, k]):
            up = {**table, piece: table[piece] * 1.0001}
            assert n == pytest.approx((math.log(segmentations(word, up)) - math.log(whole)) / math.log(1.0001), abs=1e-3)


def test_held_out_accuracy(spark):
    rows = langid.op5_language(spark, "/root/testdata/sf0.01")
    truth = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "lang")
    hits = rows.where("held_out").join(truth, "doc_id").agg(F.avg((F.col("lang_pred") == F.col("lang")).cast("double"))).first()[0]
    assert hits > 0.97


def test_odd_rows(spark):
    docs = spark.createDataFrame([(1, None, None, "k"), (2, "", "en", "k"), (3, "12 !?", "en", "k"), (4, "the " * 50_000, "en", "k"), (None, "le la", "fr", "k")], "doc_id long, text string, lang string, score string")
    found = {r.doc_id: (r.lid.lang_pred, r.lid.score, r.score) for r in langid.identified(docs, langid.train(docs, F.lit(True))).collect()}
    assert found[1] == found[2] == found[3] == ("und", 0.0, "k")
    assert found[4][0] == "en" and found[None][0] == "fr"
    nothing = langid.train(docs, F.lit(False))
    assert {r.lid.lang_pred for r in langid.identified(docs, nothing).collect()} == {"und"}
    assert langid.identified(docs.limit(0), nothing).count() == 0


def test_numeric_signs_are_no_letters():
    assert langid.words_of("½ ① Ⅷ ² 12 _") == []
    assert langid.words_of("Un½deux ⅷ 三 x²y") == ["un", "deux", "三", "x", "y"]
