"""LM scoring by context-tree weighting over bytes, with a unigram word baseline."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from motionframes.llm.common import Lookup, remainder, saved, slices, table

#: Bytes of context; a text begins after zero bytes.
DEPTH = 5
#: What the model that tasks hold is bounded by: grams with their log probabilities and words with their counts, the most
#: frequent first. Grams and words beyond are joined by shuffle, so the bounds change no result.
NODES, WORDS = 1_500_000, 300_000
#: Contexts of SPLIT bytes and more are weighted within tasks, dealt by their last SPLIT bytes; the tree above is bounded by the alphabet.
SPLIT = 3
#: Characters whose grams a task holds at once, while it counts (about 60 bytes each) and while it scores (about 100).
COUNTED, SCORED = 1 << 22, 1 << 18
_BYTE = np.uint64(8)


def grams(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of the texts, each packed below its DEPTH bytes of context, and their number in each text.

    A text ends with a zero byte, so that the probabilities of all texts sum to one.
    """
    data = [(t or "").encode("utf-8", "surrogatepass") + b"\0" for t in texts]
    raw = np.frombuffer(bytes(DEPTH).join([b"", *data]), np.uint8)
    packed = np.zeros(max(0, len(raw) - DEPTH), np.uint64)
    for i in range(DEPTH + 1):
        packed = (packed << _BYTE) | raw[i : len(raw) - DEPTH + i]
    sizes = np.array([len(d) for d in data], np.int64)
    starts = np.cumsum(sizes + DEPTH) - sizes - DEPTH
    keep = np.arange(sizes.sum()) + np.repeat(starts - (np.cumsum(sizes) - sizes), sizes)
    return packed[keep], sizes


def tokens(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").lower().split()


class _Hashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) > 400_000:
            self.clear()
        self[word] = value = xxhash.xxh3_64_intdigest(word)
        return value


def _hashed(words: list[bytes], hashes: dict) -> np.ndarray:
    return np.fromiter(map(hashes.__getitem__, words), np.uint64, len(words))


def counted(docs: DataFrame) -> DataFrame:
    """(kind, key, n, uses) of docs (text, trained): byte grams (kind 0), 64-bit word hashes (1), texts (2).

    n counts the trained texts, uses all texts. Words and texts are those of the trained only.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hashes = _Hashes()
        for batch in batches:
            for trained, part in batch.groupby("trained"):
                for texts in slices(part["text"].tolist(), COUNTED):
                    gram, n = np.unique(grams(texts)[0], return_counts=True)
                    words = np.concatenate([_hashed(tokens(t), hashes) for t in texts]) if trained else np.zeros(0, np.uint64)
                    word, m = np.unique(words, return_counts=True)
                    uses = np.concatenate([n, m, [len(texts)]]).astype(np.int64)
                    yield pd.DataFrame(
                        {
                            "kind": np.repeat([0, 1, 2], [len(gram), len(word), 1]).astype(np.int32),
                            "key": np.concatenate([gram, word, np.zeros(1, np.uint64)]).view(np.int64),
                            "n": uses if trained else 0 * uses,
                            "uses": uses,
                        }
                    )

    parts = docs.select(F.col("text").cast("string"), "trained").mapInPandas(run, "kind int, key long, n long, uses long")
    return parts.groupBy("kind", "key").agg(F.sum("n").alias("n"), F.sum("uses").alias("uses"))


def _lgamma(x, log):
    """Log gamma for x >= 0.5, a column or an array: Stirling's series at x + 8."""
    y = x + 8
    series = (y - 0.5) * log(y) - y + 0.9189385332046727 + 1 / (12 * y) - 1 / (360 * y * y * y) + 1 / (1260 * y * y * y * y * y)
    product = 1.0
    for k in range(8):
        product = (x + k) * product
    return series - log(product)


def _kt(zeros, ones, log):
    return _lgamma(zeros + 0.5, log) + _lgamma(ones + 0.5, log) - _lgamma(zeros + ones + 1, log) - 1.1447298858494002


def _deep(gram: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, pd.DataFrame]:
    """Both directions of the tree from SPLIT bytes of context on, for all grams that share their last SPLIT: the
    probability of each gram's eight decisions under these contexts (NaN where none was counted), and the nodes
    of SPLIT bytes, summed by the context one byte shorter.

    A gram that was never counted makes nodes without visits, which weigh nothing and end a walk.
    """
    bits = np.stack([(gram >> np.uint64(7 - bit)) & np.uint64(1) for bit in range(8)]).astype(bool)
    levels, longer = [], [None] * 8
    for depth in range(DEPTH, SPLIT - 1, -1):
        key = gram & np.uint64((1 << 8 * (depth + 1)) - 1)
        order = np.argsort(key)
        level = []
        for bit in range(8):
            node = key[order] >> np.uint64(8 - bit)
            first = np.flatnonzero(np.concatenate([[True], node[1:] != node[:-1]]))
            group = np.empty(len(gram), np.int64)
            group[order] = np.repeat(np.arange(len(first)), np.diff(np.append(first, len(gram))))
            ones = np.add.reduceat((n * bits[bit])[order], first).astype(float)
            zeros = np.add.reduceat((n * ~bits[bit])[order], first).astype(float)
            weighted, stop = _kt(zeros, ones, np.log), np.ones(len(first))
            if longer[bit] is not None:
                at, parts = longer[bit]
                below = np.bincount(group[at], parts, len(first))
                gap = weighted - below
                stop = 1 / (1 + np.exp(np.minimum(-gap, 700)))
                weighted = np.maximum(weighted, below) + np.log1p(np.exp(-np.abs(gap))) - np.log(2)
            longer[bit] = order[first], weighted
            level.append((group, zeros, ones, stop))
        levels.append(level)
    found, tops = np.full((len(gram), 8), np.nan), []
    for bit in range(8):
        left, p, last = np.ones(len(gram)), np.zeros(len(gram)), np.full(len(gram), np.nan)
        for group, zeros, ones, stop in (level[bit] for level in reversed(levels)):
            chance = ((ones + 0.5) / (zeros + ones + 1))[group]
            there = (zeros + ones > 0)[group]
            last = np.where(there, np.where(bits[bit], chance, 1 - chance), last)
            share = np.where(there, stop[group] * left, 0.0)
            p, left = p + np.where(there, share * last, 0.0), left - share
        found[:, bit] = p + left * last
        _, zeros, ones, _ = levels[-1][bit]
        at, weighted = longer[bit]
        context = (gram[at] >> _BYTE) & np.uint64((1 << 8 * (SPLIT - 1)) - 1)
        node = np.uint64(1 << bit) | ((gram[at] & np.uint64(255)) >> np.uint64(8 - bit))
        tops.append(pd.DataFrame({"context": context.view(np.int64), "node": node.astype(np.int32), "zeros": zeros, "ones": ones, "sum": weighted}))
    top = pd.concat(tops).groupby(["context", "node"], as_index=False).sum()
    return found, top[top["zeros"] + top["ones"] > 0].astype({"zeros": np.int64, "ones": np.int64})


def _dealt(counts: DataFrame) -> DataFrame:
    suffix = F.shiftrightunsigned("key", 8).bitwiseAND(F.lit((1 << 8 * SPLIT) - 1)).alias("suffix")
    return counts.where("kind = 0").select("key", "n", "uses", suffix).repartition("suffix").sortWithinPartitions("suffix")


def _whole(batches: Iterator[pd.DataFrame], least: int = 1 << 18) -> Iterator[pd.DataFrame]:
    """The sorted rows in frames of about `least`, cut where the suffix changes."""
    held, size, enough = [], 0, least
    for batch in batches:
        held.append(batch)
        size += len(batch)
        if size >= enough:
            rows = pd.concat(held, ignore_index=True)
            suffix = rows["suffix"].to_numpy()
            cut = int(np.searchsorted(suffix, suffix[-1]))
            if cut:
                yield rows.iloc[:cut]
            held, size = [rows.iloc[cut:]], size - cut
            enough = max(least, 2 * size)
    if size:
        yield pd.concat(held, ignore_index=True)


def tree(counts: DataFrame) -> DataFrame:
    """(depth, context, node, zeros, ones, stop) of the nodes with less than SPLIT bytes of context, from all gram counts (kind, key, n, uses).

    A byte is eight binary decisions along a node (1 to 255) of its context. A context's KT estimate codes its
    decisions at exp(kt); weighting sets exp(weighted) = (exp(kt) + product over the longer contexts) / 2, and stop is
    the share of the first in that sum, by which a prediction mixes the depths.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in _whole(batches):
            yield _deep(rows["key"].to_numpy().view(np.uint64), rows["n"].to_numpy())[1]

    sums = lambda level, context: level.groupBy(context, "node").agg(*[F.sum(c).alias(c) for c in ("zeros", "ones", "sum")])
    level, out = sums(_dealt(counts).mapInPandas(run, "context long, node int, zeros long, ones long, sum double"), F.col("context")), None
    for depth in range(SPLIT - 1, -1, -1):
        kt = _kt(F.col("zeros").cast("double"), F.col("ones").cast("double"), F.log)
        gap = F.col("kt") - F.col("sum")
        level = level.withColumn("kt", kt)
        # log((e^kt + e^sum) / 2), and the share of e^kt in it.
        level = level.withColumn("weighted", F.greatest("kt", "sum") + F.log1p(F.exp(-F.abs(gap))) - 0.6931471805599453)
        level = saved(level.withColumn("stop", 1 / (1 + F.exp(F.least(-gap, F.lit(700.0))))), "ctw-level")
        part = level.select(F.lit(depth).alias("depth"), "context", "node", "zeros", "ones", "stop")
        out = part if out is None else out.unionByName(part)
        if depth:
            shorter = F.col("context").bitwiseAND(F.lit((1 << 8 * (depth - 1)) - 1)).alias("context")
            level = sums(level.select("context", "node", "zeros", "ones", F.col("weighted").alias("sum")), shorter)
    return out


def _key(depth: int, context: np.ndarray, node: np.ndarray) -> np.ndarray:
    return (((context << np.uint64(8)) | node) << np.uint64(3)) | np.uint64(depth)


@dataclass
class Top:
    """The nodes with less than SPLIT bytes of context: probability of a one, share that stops."""

    find: Lookup
    ones: np.ndarray
    stop: np.ndarray

    def byte_logs(self, gram: np.ndarray, deep: np.ndarray | None = None) -> np.ndarray:
        """log10 probability of the last byte of each gram in the context of the bytes before it; deep has what the
        longer contexts give each of its decisions, or NaN. Without it the tree ends here."""
        out = np.zeros(len(gram))
        byte, context = gram & np.uint64(255), gram >> np.uint64(8)
        for bit in range(8):
            node = np.uint64(1 << bit) | (byte >> np.uint64(8 - bit))
            one = ((byte >> np.uint64(7 - bit)) & np.uint64(1)) == 1
            # From the root down: what is left to mix, and the last estimate for what a missing node would take.
            left, p, last = np.ones(len(gram)), np.zeros(len(gram)), np.full(len(gram), 0.5)
            rows = np.arange(len(gram))
            for depth in range(SPLIT):
                mask = np.uint64((1 << 8 * depth) - 1)
                at = self.find(_key(depth, context[rows] & mask, node[rows]))
                rows, at = rows[at >= 0], at[at >= 0]
                last[rows] = np.where(one[rows], self.ones[at], 1 - self.ones[at])
                share = self.stop[at] * left[rows]
                p[rows] += share * last[rows]
                left[rows] -= share
            rest = last if deep is None else np.where(np.isnan(deep[:, bit]), last, deep[:, bit])
            out += np.log10(p + left * rest)
        return out


@dataclass
class Model:
    """What tasks hold: the tree's top, the most frequent grams with their log probabilities, the most frequent words."""

    top: Top
    gram: Lookup
    gram_log: np.ndarray
    all_grams: bool
    word: Lookup
    word_n: np.ndarray
    all_words: bool
    texts: int
    total: int
    distinct: int

    def byte_logs(self, gram: np.ndarray) -> np.ndarray:
        """As Top's: a distribution over the last byte in any context, also of grams that no text has."""
        return self.top.byte_logs(gram)


@dataclass
class Shuffled:
    """What tasks may lack: all words (word, c), and all grams of the texts (gram, log)."""

    words: DataFrame
    logs: DataFrame


def gram_logs(counts: DataFrame, top: Top) -> DataFrame:
    """(gram, log, uses): the exact log10 probability of each counted gram under the whole tree."""
    held = counts.sparkSession.sparkContext.broadcast(top)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in _whole(batches):
            gram = rows["key"].to_numpy().view(np.uint64)
            logs = held.value.byte_logs(gram, _deep(gram, rows["n"].to_numpy())[0])
            yield pd.DataFrame({"gram": rows["key"], "log": logs, "uses": rows["uses"]})

    return _dealt(counts).mapInPandas(run, "gram long, log double, uses long")


def learned(docs: DataFrame, train: Column | None = None) -> tuple[Model, Shuffled]:
    """The model of the docs (text) where train holds, by default all, for scoring all of them."""
    counts = saved(counted(docs.select("text", (F.lit(True) if train is None else train).alias("trained"))), "ctw-counts")
    nodes = saved(tree(counts), "ctw-nodes")
    words = counts.where("kind = 1").select(F.col("key").alias("word"), F.col("n").alias("c"))
    sums = {r["kind"]: (r["n"], r["kinds"]) for r in counts.groupBy("kind").agg(F.sum("n").alias("n"), F.count("*").alias("kinds")).collect()}
    texts, (tokens_, distinct) = sums.get(2, (0, 0))[0], sums.get(1, (0, 0))

    packed = F.shiftleft(F.shiftleft(F.col("context"), 8).bitwiseOR(F.col("node").cast("long")), 3).bitwiseOR(F.col("depth").cast("long"))
    number = lambda t, c: t.column(c).to_numpy()
    nodes = nodes.select(packed.alias("key"), ((F.col("ones") + 0.5) / (F.col("zeros") + F.col("ones") + 1)).alias("p"), "stop").toArrow()
    top = Top(Lookup(number(nodes, "key").view(np.uint64)), number(nodes, "p"), number(nodes, "stop"))
    logs = saved(gram_logs(counts, top), "ctw-grams")
    met = _most(logs, "uses", NODES).select("gram", "log").toArrow()
    often = _most(words, "c", WORDS).toArrow()
    model = Model(
        top, Lookup(number(met, "gram").view(np.uint64)), number(met, "log"), len(met) == sums.get(0, (0, 0))[1],
        Lookup(number(often, "word").view(np.uint64)), number(often, "c"), len(often) == distinct,
        # The end is one more token a text, and one more distinct token.
        texts, tokens_ + texts, distinct + (texts > 0),
    )
    return model, Shuffled(words, logs.select("gram", "log"))


def _most(rows: DataFrame, by: str, most: int) -> DataFrame:
    """At most `most` rows: all with the largest values, from a histogram of the values in steps of a twentieth."""
    step = F.floor(F.log2(F.greatest(F.col(by), F.lit(1)).cast("double")) * 14).cast("int")
    held = 0
    for s, n in sorted(((r["s"], r["n"]) for r in rows.groupBy(step.alias("s")).agg(F.count("*").alias("n")).collect()), reverse=True):
        if held + n > most:
            return rows.where(step > s)
        held += n
    return rows


def _sums(values: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The sum of each stretch of the values."""
    owner = np.repeat(np.arange(len(sizes)), sizes)
    return np.bincount(owner, values, len(sizes))


def scored(docs: DataFrame, model: Model) -> DataFrame:
    """docs (row, text, ...) plus ctw (n_bytes, n_tokens, n_known, base, rest, score, grams): rest holds the words whose
    counts the tasks don't have, grams those whose logs they don't have; base, n_known and score leave them out."""
    held = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("n_bytes long, n_tokens long, n_known long, base double, score double, rest array<long>, grams array<long>")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        m = held.value
        hashes = _Hashes()
        end = np.log10(m.texts + 0.1)
        for batch in batches:
            out = []
            for texts in slices(batch.tolist(), SCORED):
                gram, sizes = grams(texts)
                at = m.gram(gram)
                missed = at < 0
                logs = _sums(np.where(missed, 0.0, m.gram_log[at] if len(m.gram_log) else 0.0), sizes)
                far = _split(gram.view(np.int64), missed, sizes)
                split = [tokens(t) for t in texts]
                n = np.array([len(w) for w in split], np.int64)
                hashed = _hashed([w for words in split for w in words], hashes)
                at = m.word(hashed)
                c = np.where(at >= 0, m.word_n[at] if len(m.word_n) else 0, 0)
                left = (at < 0) & (not m.all_words)
                base = _sums(np.where(left, 0.0, np.log10(c + 0.1)), n) + end
                known = _sums(c > 0, n) + (m.texts > 0)
                rest = _split(hashed.view(np.int64), left, n)
                out.append(pd.DataFrame({"n_bytes": sizes, "n_tokens": n + 1, "n_known": known.astype(int), "base": base, "score": logs, "rest": rest, "grams": far}))
            yield pd.concat(out) if out else pd.DataFrame({k: [] for k in ("n_bytes", "n_tokens", "n_known", "base", "score", "rest", "grams")})

    return docs.withColumn("ctw", score(F.col("text").cast("string")))


def _split(values: np.ndarray, pick: np.ndarray, sizes: np.ndarray) -> list[np.ndarray]:
    """The picked values of each stretch."""
    return np.split(values[pick], np.cumsum(_sums(pick, sizes).astype(int))[:-1])


def likelihoods(docs: DataFrame, train: Column) -> DataFrame:
    """(doc_id, trained, n_tokens, n_known, train_tokens, base_score, score, bits_per_byte) for every row of docs (doc_id, text).

    score is the log10 probability of the text and its end under a context tree of all texts where train holds. A null
    text is an empty one. Without any text to learn from every bit has an even chance.

    Counts are summed in tasks before they are shuffled, by gram and by word. Documents never move: tasks hold a
    model of bounded size, and grams and words that it doesn't hold go by shuffle to their logs and counts.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.coalesce(train, F.lit(False)).alias("trained"))
    model, more = learned(rows, F.col("trained"))
    scale = float(np.log10(model.total + 0.1 * (model.distinct + 1)))
    found = scored(rows, model).select("doc_id", "trained", "ctw.*").withColumn("row", F.monotonically_increasing_id())
    if not (model.all_words and model.all_grams):
        found = saved(found, "ctw-scored")
    if model.all_words:
        found = found.withColumns({"base_rest": F.lit(0.0), "known_rest": F.lit(0)})
    else:
        rare = found.select("row", F.explode("rest").alias("word")).join(more.words, "word", "left")
        rare = rare.groupBy("row").agg(F.sum(F.log10(F.coalesce("c", F.lit(0)) + 0.1)).alias("base_rest"), F.count("c").alias("known_rest"))
        found = found.join(rare, "row", "left")
    if model.all_grams:
        found = found.withColumn("score_rest", F.lit(0.0))
    else:
        far = found.select("row", F.explode("grams").alias("gram")).join(more.logs, "gram", "left")
        found = found.join(far.groupBy("row").agg(F.sum("log").alias("score_rest")), "row", "left")
    found = found.withColumn("score", F.col("score") + F.coalesce("score_rest", F.lit(0.0)))
    base = F.col("base") + F.coalesce("base_rest", F.lit(0.0)) - F.col("n_tokens") * scale
    return found.select(
        "doc_id", "trained", "n_tokens", (F.col("n_known") + F.coalesce("known_rest", F.lit(0))).alias("n_known"),
        F.lit(model.total).cast("long").alias("train_tokens"), base.alias("base_score"), "score",
        (-F.col("score") * float(np.log2(10)) / F.col("n_bytes")).alias("bits_per_byte"),
    )


def op10_context_tree(spark: SparkSession, folder: str) -> DataFrame:
    found = likelihoods(table(spark, folder, "documents").select("doc_id", "text"), remainder(F.col("doc_id"), 10) != 0)
    return found.withColumn("held_out", ~F.col("trained")).drop("trained")
