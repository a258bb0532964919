"""Toxicity: a bidirectional gated recurrent network with attention pooling over windows of words, trained in numpy."""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from motionframes.llm.common import remainder, saved, slices, table

#: Words of a window and the step to the next; letters of a word that are read together (a longer word is several).
WINDOW, STEP, SPAN = 32, 24, 24
WORD = re.compile(rf"[^\W_]{{1,{SPAN}}}")
#: Training documents of each label at most, and bytes of a training text at most (the bound of the sample).
PER_LABEL, LONGEST = 700, 50_000
#: Sizes: letters told apart, letter vector, letter state, word buckets, word vector, word state.
LETTERS, LETTER_DIM, LETTER_STATE, BUCKETS, WORD_DIM, STATE = 256, 12, 12, 1 << 14, 4, 10
#: Batches learned from, of so many windows; the rate of the first, which falls to a twentieth.
BATCHES, BATCH, RATE, SEED = 200, 64, 0.01, 3
#: Score from which a text counts as toxic.
THRESHOLD = 0.7
REMEMBERED = 120_000


def words_of(text: str | None) -> list[str]:
    """Lower-case runs of letters and digits, long ones in pieces of SPAN."""
    return WORD.findall((text or "").lower())


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * np.tanh(0.5 * x) + 0.5


def gru(xp: np.ndarray, wh: np.ndarray, mask: np.ndarray, keep: bool = False) -> tuple[np.ndarray, list]:
    """States (time, row, state) of a gated recurrent layer over its projected inputs; a masked step changes nothing."""
    n = wh.shape[0]
    h, out, steps = np.zeros((xp.shape[1], n), xp.dtype), np.empty((*xp.shape[:2], n), xp.dtype), []
    for t in range(len(xp)):
        a = h @ wh
        gates = _sigmoid(xp[t, :, : 2 * n] + a[:, : 2 * n])
        z, r = gates[:, :n], gates[:, n:]
        c = np.tanh(xp[t, :, 2 * n :] + r * a[:, 2 * n :])
        new = np.where(mask[t][:, None], c + z * (h - c), h)
        if keep:
            steps.append((h, z, r, c, a[:, 2 * n :]))
        h = out[t] = new
    return out, steps


def gru_back(dout: np.ndarray, steps: list, wh: np.ndarray, mask: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Gradients of the projected inputs and of wh, from those of all states."""
    n = wh.shape[0]
    dxp, dwh, dh = np.zeros((*dout.shape[:2], 3 * n), dout.dtype), np.zeros_like(wh), np.zeros(dout.shape[1:], dout.dtype)
    for t in range(len(dout) - 1, -1, -1):
        h, z, r, c, a = steps[t]
        dh = dh + dout[t]
        on = mask[t][:, None]
        dn = np.where(on, dh, 0)
        dc = dn * (1 - z) * (1 - c * c)
        dz, dr = dn * (h - c) * z * (1 - z), dc * a * r * (1 - r)
        dxp[t] = np.concatenate([dz, dr, dc], 1)
        da = np.concatenate([dz, dr, dc * r], 1)
        dwh += h.T @ da
        dh = np.where(on, dn * z, dh) + da @ wh.T
    return dxp, dwh


class Network:
    """Letters of a word, both ways, and a vector of its bucket give the word's input; words of a window, both ways, are pooled by attention."""

    def __init__(self, seed: int = SEED):
        rng = np.random.default_rng(seed)
        full = lambda a, b: (rng.normal(size=(a, b)) / np.sqrt(a)).astype(np.float32)
        width = 2 * LETTER_STATE + WORD_DIM
        self.p = {"letter": full(LETTERS, LETTER_DIM) * 4, "word": np.zeros((BUCKETS, WORD_DIM), np.float32)}
        for d in "fb":
            self.p |= {"cx" + d: full(LETTER_DIM, 3 * LETTER_STATE), "ch" + d: full(LETTER_STATE, 3 * LETTER_STATE), "cb" + d: np.zeros((1, 3 * LETTER_STATE), np.float32)}
            self.p |= {"wx" + d: full(width, 3 * STATE), "wh" + d: full(STATE, 3 * STATE), "wb" + d: np.zeros((1, 3 * STATE), np.float32)}
        self.p |= {"att": full(2 * STATE, STATE), "pick": full(STATE, 1), "out": full(2 * STATE, 1), "bias": np.zeros((1, 1), np.float32)}
        self.moments = {k: (np.zeros_like(v), np.zeros_like(v)) for k, v in self.p.items()}
        self.steps = 0

    @staticmethod
    def spelled(words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Letter numbers (letter, word), where there is a letter, and the words' buckets."""
        width = max(map(len, words))
        codes = np.array(words, dtype=f"U{width}").view(np.uint32).reshape(len(words), width).T
        buckets = np.fromiter((zlib.crc32(w.encode("utf-8", "surrogatepass")) % BUCKETS for w in words), np.int64, len(words))
        return (codes % LETTERS).astype(np.int64), codes > 0, buckets

    def word_inputs(self, words: list[str], keep: bool = False) -> tuple[np.ndarray, tuple]:
        """The input vector of each word; what the way back needs."""
        codes, mask, buckets = self.spelled(words)
        letters, ends, held = self.p["letter"][codes] if keep else None, [], []
        for d in "fb":
            side = slice(None, None, 1 if d == "f" else -1)
            projected = self.p["letter"] @ self.p["cx" + d] + self.p["cb" + d]
            out, steps = gru(projected[codes[side]], self.p["ch" + d], mask[side], keep)
            ends.append(out[-1])
            held.append(steps)
        return np.concatenate([*ends, self.p["word"][buckets]], 1), (codes, mask, buckets, letters, held)

    def attend(self, states: np.ndarray, mask: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Logits of windows from the states (time, window, state), and the parts of the pooling."""
        inner = np.tanh(states @ self.p["att"])
        weight = np.where(mask, (inner @ self.p["pick"])[:, :, 0], -1e9)
        weight = np.exp(weight - weight.max(0))
        weight /= weight.sum(0)
        pooled = np.einsum("tb,tbh->bh", weight, states)
        return (pooled @ self.p["out"])[:, 0] + self.p["bias"][0, 0], inner, weight, pooled

    def learn(self, words: list[str], windows: np.ndarray, label: np.ndarray) -> None:
        """One step of Adam on windows (window, position) of indexes into words, -1 where there is no word."""
        x, (codes, letter_mask, buckets, letters, held) = self.word_inputs(words, keep=True)
        at, mask = np.maximum(windows.T, 0), windows.T >= 0
        given = x[at]
        states, steps = [], []
        for d in "fb":
            side = slice(None, None, 1 if d == "f" else -1)
            out, s = gru(given[side] @ self.p["wx" + d] + self.p["wb" + d], self.p["wh" + d], mask[side], keep=True)
            states.append(out[side])
            steps.append(s)
        both = np.concatenate(states, 2)
        logit, inner, weight, pooled = self.attend(both, mask)
        g, dlogit = {}, ((_sigmoid(logit) - label) / len(label))[:, None].astype(np.float32)
        g["out"], g["bias"] = pooled.T @ dlogit, dlogit.sum(0, keepdims=True)
        dpooled = dlogit @ self.p["out"].T
        dboth = weight[:, :, None] * dpooled
        dweight = np.einsum("tbh,bh->tb", both, dpooled)
        dpre = (weight * (dweight - (weight * dweight).sum(0)))[:, :, None]
        dinner = dpre @ self.p["pick"].T * (1 - inner * inner)
        flat = lambda v: v.reshape(-1, v.shape[-1])
        g["pick"], g["att"] = flat(inner).T @ flat(dpre), flat(both).T @ flat(dinner)
        dboth = dboth + dinner @ self.p["att"].T
        dgiven = np.zeros_like(given)
        for k, d in enumerate("fb"):
            side = slice(None, None, 1 if d == "f" else -1)
            dxp, g["wh" + d] = gru_back(dboth[:, :, k * STATE : (k + 1) * STATE][side], steps[k], self.p["wh" + d], mask[side])
            g["wx" + d], g["wb" + d] = flat(given[side]).T @ flat(dxp), flat(dxp).sum(0, keepdims=True)
            dgiven[side] += dxp @ self.p["wx" + d].T
        dx = np.zeros_like(x)
        np.add.at(dx, at[mask], dgiven[mask])
        g["word"] = np.zeros_like(self.p["word"])
        np.add.at(g["word"], buckets, dx[:, 2 * LETTER_STATE :])
        dletters = np.zeros_like(letters)
        for k, d in enumerate("fb"):
            side = slice(None, None, 1 if d == "f" else -1)
            dout = np.zeros((*codes.shape, LETTER_STATE), np.float32)
            dout[-1] = dx[:, k * LETTER_STATE : (k + 1) * LETTER_STATE]
            dxp, g["ch" + d] = gru_back(dout, held[k], self.p["ch" + d], letter_mask[side])
            g["cx" + d], g["cb" + d] = flat(letters[side]).T @ flat(dxp), flat(dxp).sum(0, keepdims=True)
            dletters[side] += dxp @ self.p["cx" + d].T
        g["letter"] = np.zeros_like(self.p["letter"])
        np.add.at(g["letter"], codes.ravel(), flat(dletters))
        self.steps += 1
        rate = RATE * max(0.05, 1 - self.steps / BATCHES)
        clip = min(1.0, 1.0 / (1e-9 + float(np.sqrt(sum((v * v).sum() for v in g.values())))))
        for k, v in g.items():
            v = v * clip
            m, s = self.moments[k]
            m += 0.1 * (v - m)
            s += 0.001 * (v * v - s)
            self.p[k] -= rate * (m / (1 - 0.9**self.steps)) / (np.sqrt(s / (1 - 0.999**self.steps)) + 1e-8)


def windows_of(sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All windows of texts of so many words: (window, position) of positions in the joined texts, -1 past an end; and each window's text.
    Neighbouring windows share WINDOW - STEP words; a text without words has none."""
    counts = np.where(sizes > 0, 1 + np.maximum(0, -(-(sizes - WINDOW) // STEP)), 0)
    owner = np.repeat(np.arange(len(sizes)), counts)
    ends = np.cumsum(sizes)
    start = (ends - sizes)[owner] + STEP * (np.arange(len(owner)) - (np.cumsum(counts) - counts)[owner])
    at = start[:, None] + np.arange(WINDOW)
    return np.where(at < ends[owner][:, None], at, -1), owner


class Reader:
    """Scores windows with a trained network; inputs of words are remembered in projected form."""

    def __init__(self, network: Network):
        self.net, self.known = network, {}
        self.rows = np.zeros((1024, 6 * STATE), np.float32)

    def numbers(self, split: list[list[str]]) -> np.ndarray:
        new = list(set().union(*split).difference(self.known))
        if len(self.known) + len(new) > REMEMBERED:
            self.known, new = {}, list(set().union(*split))
        if need := max(0, len(self.known) + len(new) - len(self.rows)):
            self.rows = np.concatenate([self.rows, np.zeros((max(need, len(self.rows)), self.rows.shape[1]), np.float32)])
        new.sort(key=len)
        p, first = self.net.p, len(self.known)
        for at in range(0, len(new), 4096):
            x, _ = self.net.word_inputs(new[at : at + 4096])
            self.rows[first + at : first + at + len(x)] = np.concatenate([x @ p["wxf"] + p["wbf"], x @ p["wxb"] + p["wbb"]], 1)
        self.known.update(zip(new, range(first, first + len(new))))
        return np.fromiter(map(self.known.__getitem__, chain.from_iterable(split)), np.int64, sum(map(len, split)))

    def logits(self, split: list[list[str]]) -> tuple[np.ndarray, np.ndarray]:
        """Logit of every window, and its text."""
        flat, p = self.numbers(split), self.net.p
        windows, owner = windows_of(np.array([len(w) for w in split], np.int64))
        out = np.zeros(len(windows), np.float32)
        for at in range(0, len(windows), 2048):
            part = windows[at : at + 2048].T
            mask = part >= 0
            xp = self.rows[flat[np.maximum(part, 0)]]
            f, _ = gru(xp[:, :, : 3 * STATE], p["whf"], mask)
            b, _ = gru(xp[::-1, :, 3 * STATE :], p["whb"], mask[::-1])
            out[at : at + 2048] = self.net.attend(np.concatenate([f, b[::-1]], 2), mask)[0]
        return out, owner


@dataclass
class Model:
    """network: None where only one label was seen; prior: share of label 1; scale: from a text's largest logit and log window count to its score."""

    network: Network | None
    prior: float
    scale: tuple[float, float, float] = (0.0, 0.0, 0.0)

    def scores(self, reader: Reader | None, texts: list[str | None]) -> np.ndarray:
        out = np.full(len(texts), self.prior)
        if reader is not None:
            split = [words_of(t) for t in texts]
            if logit_sets := self._largest(*reader.logits(split), len(texts)):
                rows, most, count = logit_sets
                a, b, c = self.scale
                out[rows] = _sigmoid(a * most + b * np.log(count) + c)
        return out

    @staticmethod
    def _largest(logits: np.ndarray, owner: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray] | None:
        if not len(owner):
            return None
        rows, first, count = np.unique(owner, return_index=True, return_counts=True)
        return rows, np.maximum.reduceat(logits, first).astype(float), count


def _suspicion(split: list[list[str]], label: np.ndarray) -> dict[str, float]:
    """Log odds of words and of their first and last four letters, by documents that hold them: where to look first."""
    seen = [Counter(), Counter()]
    parts = lambda w: {w, w[:4] + "-", "-" + w[-4:]}
    for words, y in zip(split, label):
        seen[int(y)].update(set().union(*map(parts, set(words))) if words else ())
    n = [max(1, int((label == y).sum())) for y in (0, 1)]
    odds = {k: np.log((seen[1][k] + 0.3) / (n[1] + 1)) - np.log((seen[0][k] + 0.3) / (n[0] + 1)) for k in seen[1] if seen[1][k] >= 2}
    return {w: max((odds.get(x, 0.0) for x in parts(w)), default=0.0) for words in split for w in set(words)}


def fit(texts: list[str], label: np.ndarray, prior: float) -> Model:
    """Trains on labelled texts. A label holds for a text, so of a toxic one the windows that look worst are learned as toxic: first by
    log odds of words, then by the network itself; of a clean one the worst and a random one are learned as clean."""
    keep = [i for i, t in enumerate(texts) if words_of(t)]
    texts, label = [texts[i] for i in keep], label[keep].astype(np.float32)
    if len(set(label.tolist())) < 2:
        return Model(None, prior)
    rng, network = np.random.default_rng(SEED), Network()
    order = rng.permutation(len(texts))
    test, train = order[: len(order) // 4], order[len(order) // 4 :]
    if len(set(label[train].tolist())) < 2 or len(set(label[test].tolist())) < 2:
        test = train = order
    split = [words_of(texts[i]) for i in train]
    y, odds = label[train], _suspicion(split, label[train])
    names = sorted(set().union(*split))
    number = {w: i for i, w in enumerate(names)}
    flat = np.fromiter((number[w] for words in split for w in words), np.int64)
    windows, owner = windows_of(np.array([len(w) for w in split]))
    worst = np.array([odds[w] for w in names])[flat]
    look = np.where(windows >= 0, worst[np.maximum(windows, 0)], -9.0).clip(-9).max(1) + 0.01 * np.where(windows >= 0, worst[np.maximum(windows, 0)], 0).clip(0).sum(1)
    while network.steps < BATCHES:
        if network.steps:
            look = Reader(network).logits(split)[0]
        ranked = np.lexsort((-look, owner))
        place = np.arange(len(owner)) - np.searchsorted(owner, owner)
        first, second = ranked[place == 0], ranked[place == 1]
        second = second[(look[second] > 0) & (y[owner[second]] == 1)]
        other = rng.integers(0, len(windows), len(first))
        chosen = np.concatenate([first, second, other[y[owner[other]] == 0]])
        chosen = rng.permutation(chosen)
        for at in range(0, len(chosen), BATCH):
            part = chosen[at : at + BATCH]
            block = np.where(windows[part] >= 0, flat[np.maximum(windows[part], 0)], -1)
            used, back = np.unique(block, return_inverse=True)
            shift = int(used[0] < 0)
            network.learn([names[i] for i in used[shift:]], back.reshape(block.shape) - shift, y[owner[part]])
    network.moments = {}
    return Model(network, prior, _calibrated(network, [texts[i] for i in test], label[test], prior))


def _calibrated(network: Network, texts: list[str], y: np.ndarray, prior: float) -> tuple[float, float, float]:
    """Logistic regression of the label on the largest logit and the log of the window count, at the true share of labels."""
    logits, owner = Reader(network).logits([words_of(t) for t in texts])
    _, most, count = Model._largest(logits, owner, len(texts))
    x = np.stack([most, np.log(count), np.ones(len(most))], 1)
    weight = np.where(y == 1, prior / max(y.mean(), 1e-9), (1 - prior) / max(1 - y.mean(), 1e-9))
    start = w = np.array([1.0, 0.0, 0.0])
    loss = lambda w: (weight * (np.logaddexp(0, x @ w) - y * (x @ w))).sum() + 0.25 * ((w - start) ** 2).sum()
    for _ in range(30):
        p = _sigmoid(x @ w)
        grad = x.T @ (weight * (p - y)) + 0.5 * (w - start)
        step = np.linalg.solve((x * (weight * p * (1 - p))[:, None]).T @ x + 0.5 * np.eye(3), grad)
        while loss(w - step) > loss(w) and np.abs(step).max() > 1e-9:
            step = step / 2
        w = w - step
    return (max(float(w[0]), 0.05), float(w[1]), float(w[2]))


def train(docs: DataFrame, labels: DataFrame, usable: Column) -> Model:
    """Fits on usable rows of docs (doc_id, text) by labels (doc_id, toxic): at most PER_LABEL documents of each label, of at most LONGEST
    bytes, in the order of a hash of their id. A document with both labels counts as toxic; rows without a label aren't used."""
    known = labels.where("doc_id is not null and toxic is not null").where(usable).groupBy("doc_id").agg(F.max("toxic").alias("y"))
    known = known.join(docs.where(F.octet_length("text") <= LONGEST).select("doc_id").distinct(), "doc_id", "left_semi")
    known = saved(known.select("doc_id", "y", F.xxhash64("doc_id", F.lit(5)).alias("order")), "toxic-labels")
    n = {r["y"]: r["n"] for r in known.groupBy((F.col("y") > 0).cast("int").alias("y")).agg(F.count("*").alias("n")).collect()}
    prior = n.get(1, 0) / max(1, sum(n.values()))
    if len(n) < 2:
        return Model(None, prior)
    some = {r["doc_id"]: int(y) for y in (0, 1) for r in known.where((F.col("y") > 0) == bool(y)).orderBy("order").limit(PER_LABEL).collect()}
    # The list of ids has a fixed bound, so it can go along with the scan.
    rows = docs.where(F.col("doc_id").isin(*some) & (F.octet_length("text") <= LONGEST)).select("doc_id", "text").limit(4 * PER_LABEL).collect()
    texts = sorted({(r["doc_id"], r["text"]) for r in rows})
    return fit([t for _, t in texts], np.array([some[i] for i, _ in texts]), prior)


def scorer(docs: DataFrame, model: Model):
    """A column function: text -> score."""
    held = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        m = held.value
        reader = Reader(m.network) if m.network else None
        for batch in batches:
            yield pd.Series(np.concatenate([np.zeros(0), *(m.scores(reader, texts) for texts in slices(batch.tolist(), 1 << 20))]))

    return score


def judged(docs: DataFrame, model: Model) -> DataFrame:
    """docs plus tox_score: how likely label 1 is, from the worst of all overlapping windows of the whole text. Null texts and those without a word
    have the share of label 1 in training (0 if nothing was learned). tox_score is a reserved column name."""
    return docs.withColumn("tox_score", scorer(docs, model)(F.col("text").cast("string")))


def op1_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    found = judged(docs, train(docs, table(spark, folder, "labels"), remainder(F.col("doc_id"), 3) != 1))
    return found.select(
        "doc_id", (remainder(F.col("doc_id"), 3) == 1).alias("held_out"), F.col("tox_score").alias("score"), (F.col("tox_score") >= THRESHOLD).cast("int").alias("predicted")
    )
