import numpy as np
import pytest
from pyspark.sql import functions as F

from motionframes.llm import toxicity as T


def network():
    net = T.Network()
    net.p = {k: v.astype(np.float64) for k, v in net.p.items()}
    net.p["word"] = np.random.default_rng(1).normal(size=net.p["word"].shape)
    return net


WORDS = ["a", "bad", "zyxwv", "ünï", "good"]
WINDOWS = np.array([[0, 1, 2, -1], [3, -1, -1, -1], [4, 4, 1, 0]])


def loss(net, label):
    x, _ = net.word_inputs(WORDS)
    given, mask = x[np.maximum(WINDOWS.T, 0)], WINDOWS.T >= 0
    f, _ = T.gru(given @ net.p["wxf"] + net.p["wbf"], net.p["whf"], mask)
    b, _ = T.gru(given[::-1] @ net.p["wxb"] + net.p["wbb"], net.p["whb"], mask[::-1])
    logit = net.attend(np.concatenate([f, b[::-1]], 2), mask)[0]
    return float(np.mean(np.logaddexp(0, logit) - label * logit))


@pytest.mark.parametrize("name", ["letter", "word", "cxf", "chb", "cbf", "wxb", "whf", "whb", "wbb", "att", "pick", "out", "bias"])
def test_gradients(name, monkeypatch):
    """The first step of Adam goes down each parameter's numeric gradient."""
    net, label = network(), np.array([1.0, 0.0, 1.0])
    net.moments = {k: (np.zeros_like(v), np.zeros_like(v)) for k, v in net.p.items()}
    before = {k: v.copy() for k, v in net.p.items()}
    net.learn(WORDS, WINDOWS, label)
    moved = net.moments[name][0] * 10
    norm = np.sqrt(sum((m * m).sum() for m, _ in net.moments.values())) * 10
    net.p = before
    spots = np.argsort(-np.abs(moved).ravel())[:5]
    slopes = []
    for spot in spots:
        at = np.unravel_index(spot, moved.shape)
        kept = net.p[name][at]
        net.p[name][at] = kept + 1e-5
        up = loss(net, label)
        net.p[name][at] = kept - 1e-5
        down = loss(net, label)
        net.p[name][at] = kept
        slopes.append((up - down) / 2e-5)
    scale = 1.0 if norm < 0.999 else np.linalg.norm(moved.ravel()[spots]) / np.linalg.norm(slopes)
    assert scale <= 1 + 1e-3
    assert moved.ravel()[spots] == pytest.approx(np.array(slopes) * scale, rel=2e-3, abs=1e-7)


def test_windows_cover_all_words(rng):
    sizes = np.array([0, 1, T.WINDOW, T.WINDOW + 1, 0, 1000, int(rng.integers(30, 200))])
    windows, owner = T.windows_of(sizes)
    ends = np.cumsum(sizes)
    for i, n in enumerate(sizes):
        mine = windows[owner == i]
        assert set(mine[mine >= 0].tolist()) == set(range(ends[i] - n, ends[i]))
    assert 0 not in owner and 4 not in owner


def docs(spark, n=400):
    rng = np.random.default_rng(2)
    common = [f"w{i}" for i in range(60)]
    rows = []
    for i in range(n):
        words = [common[k] for k in rng.integers(0, 60, rng.integers(5, 150))]
        if i % 3 == 0:
            words.insert(int(rng.integers(0, len(words))), ["scum", "scumly", "idiot"][i % 9 // 3])
        rows.append((i, " ".join(words), int(i % 3 == 0)))
    frame = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    return frame


def test_learns_planted_words(spark):
    frame = docs(spark)
    model = T.train(frame, frame.select("doc_id", "toxic"), F.col("doc_id") % 4 != 1)
    found = T.judged(frame.where("doc_id % 4 = 1"), model)
    right = found.agg(F.avg(((F.col("tox_score") >= T.THRESHOLD) == (F.col("toxic") == 1)).cast("double"))).first()[0]
    assert right > 0.95


def test_odd_rows(spark):
    frame = docs(spark)
    model = T.train(frame, frame.select("doc_id", "toxic"), F.lit(True))
    rows = [(1, None, "k"), (2, "", "k"), (3, "!? ...", "k"), (4, "w1 " * 40_000 + "scum", "k"), (None, "x" * 5000, "k"), (4, "scum", "k")]
    found = T.judged(spark.createDataFrame(rows, "doc_id long, text string, score string"), model).collect()
    assert len(found) == 6 and all(0 <= r.tox_score <= 1 for r in found)
    assert {r.tox_score for r in found if r.doc_id in (1, 2, 3)} == {model.prior}
    labels = frame.select("doc_id", "toxic")
    for some in (labels.limit(0), labels.where("toxic = 0")):
        one = T.train(frame, some, F.lit(True))
        assert {r.tox_score for r in T.judged(frame.limit(5), one).collect()} == {0.0}
    assert T.judged(frame.limit(0), model).count() == 0
