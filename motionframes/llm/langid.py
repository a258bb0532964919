"""Language identification: per-language piece probabilities, texts scored over all their segmentations."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from motionframes.llm.common import Lookup, remainder, slices, table

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
MARK = "▁"
LETTERS = re.compile(r"[^\W\d_]+")
#: Letters of a word that are segmented together; a longer word is several (none is dropped).
SPAN = 32
#: Training documents a language at most, and bytes of a training text at most (the bound of the sample).
PER_LANGUAGE, LONGEST = 300, 50_000
ROUNDS, SMOOTHING, UNKNOWN = 3, 0.05, 1e-7
#: Makes probabilities of long words stay within double precision: every letter counts this factor.
SCALE = 64.0
#: Words that a task remembers.
REMEMBERED = 400_000
_BASE = np.uint64(0x100000001B3)
_INVERSE = np.uint64(pow(0x100000001B3, -1, 1 << 64))


def words_of(text: str | None) -> list[str]:
    """Lower-case runs of letters; numeric signs such as fractions and Roman numerals end a run."""
    runs = LETTERS.findall((text or "").lower())
    if all(map(str.isalpha, runs)):
        return runs
    return [word for run in runs for word in ([run] if run.isalpha() else "".join(c if c.isalpha() else " " for c in run).split())]


def spans(word: str) -> list[str]:
    """The marked word; a long one goes on unmarked after SPAN letters."""
    return [MARK + word[:SPAN], *(word[i : i + SPAN] for i in range(SPAN, len(word), SPAN))]


class Lattice:
    """All pieces inside many words at once: for each end, the pieces that end there."""

    def __init__(self, pieces: list[str]):
        self.pieces, self.longest = pieces, max(map(len, pieces))
        codes = self._codes(pieces)
        prefix, _ = self._prefix(codes)
        sizes = np.array([len(p) for p in pieces])
        self.find = Lookup(self._key(prefix[np.arange(len(pieces)), sizes], sizes.astype(np.uint64)))

    @staticmethod
    def _codes(words: list[str]) -> np.ndarray:
        width = max(map(len, words))
        return np.array(words, dtype=f"U{width}").view(np.uint32).reshape(len(words), width).astype(np.uint64)

    @staticmethod
    def _prefix(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        with np.errstate(over="ignore"):
            power = np.concatenate([[np.uint64(1)], np.cumprod(np.full(codes.shape[1], _BASE))])
            sums = np.cumsum((codes + np.uint64(7)) * power[:-1], axis=1, dtype=np.uint64)
        return np.concatenate([np.zeros((len(codes), 1), np.uint64), sums], 1), power

    @staticmethod
    def _key(sums: np.ndarray, length: np.ndarray | np.uint64) -> np.ndarray:
        with np.errstate(over="ignore"):
            x = sums * np.uint64(0xD6E8FEB86659FD93) + length * np.uint64(0x9E3779B97F4A7C15)
            return x ^ (x >> np.uint64(32))

    def arcs(self, words: list[str]) -> tuple[np.ndarray, list]:
        """Lengths of the words, and for each end a list of (start, rows, pieces)."""
        codes, sizes = self._codes(words), np.array([len(w) for w in words])
        prefix, _ = self._prefix(codes)
        with np.errstate(over="ignore"):
            back = np.concatenate([[np.uint64(1)], np.cumprod(np.full(codes.shape[1], _INVERSE))])
            ends = []
            for end in range(1, codes.shape[1] + 1):
                here, rows = [], np.flatnonzero(sizes >= end)
                for start in range(max(0, end - self.longest), end):
                    found = self.find(self._key((prefix[rows, end] - prefix[rows, start]) * back[start], np.uint64(end - start)))
                    hit = found >= 0
                    if hit.any():
                        here.append((start, rows[hit], found[hit]))
                ends.append(here)
        return sizes, ends


def forward(sizes: np.ndarray, ends: list, p: np.ndarray) -> np.ndarray:
    """Sums over all segmentations of every prefix: (word, end, language). p: (piece, language), scaled by length.

    A letter may always also be an unknown piece, so every word has a segmentation.
    """
    a = np.zeros((len(sizes), len(ends) + 1, p.shape[1]))
    a[:, 0] = 1.0
    for end, here in enumerate(ends, 1):
        a[:, end] = a[:, end - 1] * (UNKNOWN * SCALE)
        for start, rows, piece in here:
            a[rows, end] += a[rows, start] * p[piece]
    return a


def expected(sizes: np.ndarray, ends: list, p: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Expected number of uses of each piece in words that occur weight (word, language) times."""
    a = forward(sizes, ends, p)
    b = np.zeros_like(a)
    b[np.arange(len(sizes)), sizes] = 1.0
    total = weight / a[np.arange(len(sizes)), sizes]
    used = np.zeros_like(p)
    for end in range(len(ends), 0, -1):
        b[:, end - 1] += b[:, end] * (UNKNOWN * SCALE)
        for start, rows, piece in ends[end - 1]:
            gain = p[piece] * b[rows, end]
            b[rows, start] += gain
            share = a[rows, start] * gain * total[rows]
            for k in range(p.shape[1]):
                used[:, k] += np.bincount(piece, share[:, k], len(p))
    return used


@dataclass
class Model:
    languages: list[str]
    lattice: Lattice
    scaled: np.ndarray
    prior: np.ndarray

    def score_words(self, words: list[str]) -> np.ndarray:
        """Log probability of each word in each language."""
        parts = sorted(((len(s), i, s) for i, w in enumerate(words) for s in spans(w)), key=lambda x: x[0])
        out = np.zeros((len(words), len(self.languages)))
        for at in range(0, len(parts), 20_000):
            block = parts[at : at + 20_000]
            sizes, ends = self.lattice.arcs([s for _, _, s in block])
            a = forward(sizes, ends, self.scaled)
            np.add.at(out, [i for _, i, _ in block], np.log(a[np.arange(len(sizes)), sizes]) - (sizes * np.log(SCALE))[:, None])
        return out


def fit(texts: list[tuple[str, str]], prior: dict[str, int], pieces: list[str]) -> Model:
    """Piece probabilities a language by expectation maximisation over (lang, text); prior: documents a language."""
    languages = sorted(prior)
    counts = {lang: Counter() for lang in languages}
    for lang, text in texts:
        for word in words_of(text):
            counts[lang].update(spans(word))
    words = sorted(set().union(*counts.values()), key=len)
    weight = np.array([[counts[lang][w] for lang in languages] for w in words], float).reshape(len(words), len(languages))
    lattice = Lattice(pieces)
    lengths = np.array([len(p) for p in pieces], float)
    p = np.full((len(pieces), len(languages)), 1.0 / len(pieces))
    for _ in range(ROUNDS):
        used = np.full(p.shape, SMOOTHING)
        # In blocks, whose arcs are found anew in each round: the driver holds one block's.
        for at in range(0, len(words), 4_000):
            sizes, ends = lattice.arcs(words[at : at + 4_000])
            used += expected(sizes, ends, p * SCALE ** lengths[:, None], weight[at : at + len(sizes)])
        p = used / used.sum(0)
    total = np.array([prior[x] for x in languages], float)
    return Model(languages, lattice, p * SCALE ** lengths[:, None], np.log(total / total.sum()) if len(languages) else total)


def vocabulary(path: str = MODEL) -> list[str]:
    """The distinct lower-case forms of the vocabulary's ordinary pieces that hold a letter or mark."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    ordinary = (model.id_to_piece(i) for i in range(model.vocab_size()) if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i)))
    return sorted({t.lower() for t in ordinary if t == MARK or LETTERS.fullmatch(t.lower().removeprefix(MARK))})


def train(docs: DataFrame, usable: Column) -> Model:
    """Fits on the usable rows of docs (doc_id, text, lang) with a language: at most about PER_LANGUAGE of each, of
    at most LONGEST bytes, chosen by a hash of their id. The prior counts all usable rows."""
    known = docs.where(usable & F.col("lang").isNotNull())
    prior = {r["lang"]: r["n"] for r in known.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    if not prior:
        return Model([], Lattice([MARK]), np.zeros((1, 0)), np.zeros(0))
    share = F.element_at(F.create_map(*[F.lit(x) for k, n in prior.items() for x in (k, min(1.0, PER_LANGUAGE / n))]), F.col("lang"))
    drawn = F.pmod(F.xxhash64("doc_id", F.lit(3)), F.lit(1_000_000)) < share * 1_000_000
    rows = known.where(drawn & (F.octet_length("text") <= LONGEST)).select("lang", "text", "doc_id").limit(2 * PER_LANGUAGE * len(prior)).collect()
    return fit(sorted((r["lang"], r["text"]) for r in rows), prior, vocabulary())


def scorer(docs: DataFrame, model: Model):
    """A column function: text -> struct(lang_pred string, score double)."""
    held = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("lang_pred string, score double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        m = held.value
        known, rows = {}, np.zeros((REMEMBERED, len(m.languages)))
        for batch in batches:
            names, best = [], []
            for texts in slices(batch.tolist()):
                split = [words_of(t) for t in texts] if m.languages else [[]] * len(texts)
                new = list(set().union(*split).difference(known))
                if len(known) + len(new) > REMEMBERED:
                    new, known = list(set().union(*split)), {}
                    rows = rows if len(new) <= len(rows) else np.zeros((len(new), len(m.languages)))
                if new:
                    rows[len(known) : len(known) + len(new)] = m.score_words(new)
                    known.update(zip(new, range(len(known), len(known) + len(new))))
                for words in split:
                    if not words:
                        names.append("und"), best.append(0.0)
                        continue
                    total = m.prior + rows[np.fromiter(map(known.__getitem__, words), np.int64, len(words))].sum(0)
                    k = int(total.argmax())
                    names.append(m.languages[k]), best.append(float(1 / np.exp(total - total[k]).sum()))
            yield pd.DataFrame({"lang_pred": names, "score": best})

    return score


def identified(docs: DataFrame, model: Model) -> DataFrame:
    """docs plus lid (lang_pred, score). Null texts and those without a letter are `und` with score 0, as is everything
    if there was nothing to learn from; ties go to the first language by name. Whole texts are scored, however long;
    repeated rows and ids get an answer each, an empty table none. lid is a reserved column name."""
    return docs.withColumn("lid", scorer(docs, model)(F.col("text").cast("string")))


def trainable() -> Column:
    return remainder(F.col("doc_id"), 3) != 1


def op5_language(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text", "lang")
    found = identified(docs, train(docs, trainable()))
    return found.select("doc_id", (remainder(F.col("doc_id"), 3) == 1).alias("held_out"), "lid.lang_pred", "lid.score")
