import math
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from motionframes.llm import ctw

TEXTS = ["abracadabra", "abra cadabra", "the cat sat", "", "ünï", "aaaa aaaa"]


def brute(train, texts):
    """Context-tree weighting by recursion over the counts of every context and node."""
    zeros, ones, longer = Counter(), Counter(), defaultdict(set)

    def decisions(text):
        data = bytes(ctw.DEPTH) + text.encode() + b"\0"
        for i in range(ctw.DEPTH, len(data)):
            node = 1
            for bit in range(7, -1, -1):
                b = data[i] >> bit & 1
                yield data[i - ctw.DEPTH : i], node, b
                node = 2 * node + b

    for text in train:
        for context, node, b in decisions(text):
            for d in range(ctw.DEPTH + 1):
                key = (context[ctw.DEPTH - d :], node)
                (ones if b else zeros)[key] += 1
                if d < ctw.DEPTH:
                    longer[key].add((context[ctw.DEPTH - d - 1 :], node))

    memo = {}

    def parts(key):
        if key not in memo:
            a, b = zeros[key], ones[key]
            kt = math.lgamma(a + 0.5) + math.lgamma(b + 0.5) - math.lgamma(a + b + 1) - math.log(math.pi)
            below = None if len(key[0]) == ctw.DEPTH else sum(parts(k)[1] for k in longer[key])
            both = kt if below is None else max(kt, below) + math.log1p(math.exp(-abs(kt - below))) - math.log(2)
            memo[key] = (1.0 if below is None else 1 / (1 + math.exp(min(700, below - kt))), both)
        return memo[key]

    out = []
    for text in texts:
        total = 0.0
        for context, node, b in decisions(text):
            left, p, last = 1.0, 0.0, 0.5
            for d in range(ctw.DEPTH + 1):
                key = (context[ctw.DEPTH - d :], node)
                if not zeros[key] + ones[key]:
                    break
                one = (ones[key] + 0.5) / (zeros[key] + ones[key] + 1)
                last = one if b else 1 - one
                p, left = p + left * parts(key)[0] * last, left * (1 - parts(key)[0])
            total += math.log10(p + left * last)
        out.append(total)
    return out


def base(train, text):
    tokens = lambda t: [*t.encode().lower().split(), None]
    c = Counter(w for t in train for w in tokens(t))
    n = sum(c.values())
    return len(tokens(text)), sum(c[w] > 0 for w in tokens(text)), n, sum(math.log10((c[w] + 0.1) / (n + 0.1 * (len(c) + 1))) for w in tokens(text))


@pytest.mark.parametrize("held", [300_000, 2])
def test_against_recursion(spark, monkeypatch, held):
    monkeypatch.setattr(ctw, "WORDS", held)
    rows = [(i, t, "x") for i, t in enumerate(TEXTS)] + [(50, None, "x"), (51, "zzz the cat", "x"), (None, "ABRA", "x"), (51, "zzz the cat", "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, score string")
    found = ctw.likelihoods(docs, F.col("doc_id") < 50).collect()
    assert len(found) == len(rows)
    text = {i: t or "" for i, t, _ in rows}
    expected = dict(zip(text, brute(TEXTS, text.values())))
    for r in found:
        assert r.score == pytest.approx(expected[r.doc_id], rel=1e-9)
        n, known, total, low = base(TEXTS, text[r.doc_id])
        assert (r.n_tokens, r.n_known, r.train_tokens) == (n, known, total)
        assert r.base_score == pytest.approx(low, rel=1e-9)


def test_fewer_nodes_still_make_probabilities(spark, monkeypatch):
    monkeypatch.setattr(ctw, "NODES", 300)
    docs = spark.createDataFrame(list(enumerate(TEXTS * 3)), "doc_id long, text string")
    model, _ = ctw.learned(docs)
    import numpy as np

    context = np.uint64(int.from_bytes(b"adabr", "big") << 8)
    assert (10.0 ** model.byte_logs(context | np.arange(256, dtype=np.uint64))).sum() == pytest.approx(1)


@pytest.mark.parametrize("held", [0, 20])
def test_texts_score_by_the_whole_tree_however_few_grams_are_held(spark, monkeypatch, held):
    monkeypatch.setattr(ctw, "NODES", held)
    texts = [*TEXTS, *TEXTS, "zzz the cat", "abracadabra zz"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    train = texts[: 2 * len(TEXTS)]
    found = {r.doc_id: r.score for r in ctw.likelihoods(docs, F.col("doc_id") < len(train)).collect()}
    assert [found[i] for i in range(len(texts))] == pytest.approx(brute(train, texts), rel=1e-9)


def test_held_out_is_better_than_words(spark):
    found = ctw.op10_context_tree(spark, "/root/testdata/sf0.01").where("held_out").agg(F.sum("score"), F.sum("base_score"), F.count("*")).first()
    ids = [r.doc_id for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id").collect()]
    assert found[2] == sum(zlib.crc32(str(i).encode()) % 10 == 0 for i in ids)
    assert found[0] > found[1]


def test_nothing_to_learn(spark):
    docs = spark.createDataFrame([(1, "ab"), (2, None)], "doc_id long, text string")
    found = {r.doc_id: r for r in ctw.likelihoods(docs, F.lit(False)).collect()}
    assert found[1].score == pytest.approx(24 * math.log10(0.5)) and found[1].base_score == pytest.approx(0)
    assert found[2].n_tokens == 1 and found[2].n_known == 0
    assert ctw.likelihoods(docs.limit(0), F.lit(True)).count() == 0
