"""Encoding with a SentencePiece vocabulary by one walk over a trie of marked words, and decoding."""

from __future__ import annotations

import re
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from motionframes.llm.common import slices, table

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
#: Fixed by the format: the mark that stands for a space, and text in units that no piece crosses.
MARK = "▁"
UNIT = re.compile(f"{MARK}+[^{MARK}]*")
#: Encoded words that a task remembers.
REMEMBERED = 400_000


class Vocabulary:
    """Pieces with their rank (order of merging; -1: a character) and the two parts each is merged from."""

    def __init__(self, path: str = MODEL):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        n = model.vocab_size()
        self.text = [model.id_to_piece(i) for i in range(n)]
        self.byte = {int(t[3:5], 16): i for i, t in enumerate(self.text) if model.is_byte(i)}
        special = {i for i in range(n) if model.is_byte(i) or model.is_control(i) or model.is_unknown(i) or model.is_unused(i)}
        self.hidden = special - set(self.byte.values())
        self.id = {t: i for i, t in enumerate(self.text) if i not in special}
        order = sorted((i for i in self.id.values() if len(self.text[i]) > 1), key=lambda i: (-model.get_score(i), i))
        self.rank = [-1] * n
        for r, i in enumerate(order):
            self.rank[i] = r
        self.left, self.right = [-1] * n, [-1] * n
        for i in order:
            parts = self._merged(self.text[i])
            if parts is None:
                del self.id[self.text[i]]
            else:
                self.left[i], self.right[i] = parts
        # Pieces from their last character backwards; under 0 the piece that begins there.
        self.ends: dict = {}
        for text, i in self.id.items():
            node = self.ends
            for letter in reversed(text):
                node = node.setdefault(letter, {})
            node[0] = i

    def _merged(self, text: str) -> tuple[int, int] | None:
        """The parts of the last merge that makes this piece, None if merging never makes it."""
        now = list(text)
        while len(now) > 2:
            pairs = [(self.rank[self.id[a + b]], k) for k, (a, b) in enumerate(zip(now, now[1:])) if a + b in self.id]
            if not pairs:
                return None
            k = min(pairs)[1]
            now[k : k + 2] = [now[k] + now[k + 1]]
        return (self.id[now[0]], self.id[now[1]]) if len(now) == 2 and now[0] in self.id and now[1] in self.id else None

    def fits(self, a: int, b: int) -> bool:
        """Whether merging leaves piece a beside piece b.

        Undo the merges at their border, latest first (of equal ones the right one): if what then meets there
        is itself a piece of a rank that comes before the merge undone last, it would have been merged.
        """
        limit = len(self.rank)
        text, rank, find = self.text, self.rank, self.id.get
        while True:
            met = find(text[a] + text[b])
            if met is not None and rank[met] < limit:
                return False
            if rank[a] < 0 and rank[b] < 0:
                return True
            if rank[a] > rank[b]:
                limit, a = rank[a], self.right[a]
            else:
                limit, b = rank[b] + 1, self.left[b]


class Encoder:
    """Forward states over a trie of marked words, met depth first: words in order, each from where it leaves the one before.

    The state of a prefix is the last piece of its best path and where that piece starts. A piece may follow a
    state only if merging leaves the two side by side, and exactly one arc into each prefix passes, so a path
    is what the vocabulary's own merge order gives. A character without a piece is its bytes.
    """

    def __init__(self, vocabulary: Vocabulary):
        self.v, self.allowed, self.held = vocabulary, {}, {}

    def learn(self, words: set[str]) -> None:
        """Remembers the encodings (32-bit ids as bytes) of unmarked words, in one walk."""
        if len(self.held) + len(words) > REMEMBERED:
            self.held = {}
        ends, allowed, fits, n = self.v.ends, self.allowed, self.v.fits, len(self.v.text)
        before, last, back = "", [-1], [0]
        for word in sorted(words):
            marked = word if word[:1] == MARK else MARK + word
            at = 0
            for a, b in zip(before, marked):
                if a != b:
                    break
                at += 1
            del last[at + 1 :], back[at + 1 :]
            for end in range(at + 1, len(marked) + 1):
                piece, start = -1, end - 1
                node, begin = ends, end
                while begin:
                    begin -= 1
                    node = node.get(marked[begin])
                    if node is None:
                        break
                    found = node.get(0)
                    if found is None:
                        continue
                    earlier = last[begin]
                    if earlier >= 0:
                        key = earlier * n + found
                        ok = allowed.get(key)
                        if ok is None:
                            ok = allowed[key] = fits(earlier, found)
                        if not ok:
                            continue
                    piece, start = found, begin
                    break
                last.append(piece)
                back.append(start)
            before, ids, end = marked, [], len(marked)
            while end:
                if last[end] < 0:
                    ids += [self.v.byte[x] for x in reversed(marked[end - 1].encode("utf-8", "surrogatepass"))]
                else:
                    ids.append(last[end])
                end = back[end]
            self.held[word] = array("i", ids[::-1]).tobytes()
        if len(allowed) > 250_000:
            allowed.clear()

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """The ids of each text; the distinct new words of all texts are learned together."""
        split = []
        for text in texts:
            if not text:
                split.append([])
            elif "  " in text or text[0] == " " or text[-1] == " " or MARK in text:
                split.append(UNIT.findall(MARK + text.replace(" ", MARK)))
            else:
                split.append(text.split(" "))
        new = set().union(*split) if split else set()
        self.learn(new - self.held.keys() if len(self.held) + len(new) <= REMEMBERED else new)
        return [b"".join(map(self.held.__getitem__, words)) for words in split]


class Decoder:
    def __init__(self, vocabulary: Vocabulary):
        self.bytes = [t.replace(MARK, " ").encode() for t in vocabulary.text]
        for value, i in vocabulary.byte.items():
            self.bytes[i] = bytes([value])
        for i in vocabulary.hidden:
            self.bytes[i] = b""

    def decode(self, ids: np.ndarray) -> str:
        data = b"".join(map(self.bytes.__getitem__, ids.tolist()))
        return data[1 if data[:1] == b" " else 0 :].decode("utf-8", "replace")


def encoded(docs: DataFrame, path: str = MODEL) -> DataFrame:
    """(doc_id, ids, n_ids, round_trip) for every row of docs (doc_id, text).

    ids are those the vocabulary's own library gives. A null or empty text has none. round_trip says that decoding
    gives the text back (null: the empty text; U+2581 comes back as the space it stands for).
    Tasks work on slices of about a million characters and share nothing but the vocabulary, which has a fixed size.
    """
    held = docs.sparkSession.sparkContext.broadcast(Vocabulary(path))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, decoder = Encoder(held.value), Decoder(held.value)
        for batch in batches:
            ids, at = batch.column(0), 0
            for texts in slices(batch.column(1).to_pylist(), 1 << 20):
                codes = encoder.encode(texts)
                same = [decoder.decode(np.frombuffer(c, np.int32)) == (t or "").replace(MARK, " ") for c, t in zip(codes, texts)]
                sizes = np.array([len(c) // 4 for c in codes], np.int32)
                values = pa.array(np.frombuffer(b"".join(codes), np.int32))
                lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)), values)
                yield pa.RecordBatch.from_arrays([ids.slice(at, len(texts)), lists, pa.array(sizes), pa.array(same)], ["doc_id", "ids", "n_ids", "round_trip"])
                at += len(texts)

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, "doc_id long, ids array<int>, n_ids int, round_trip boolean")


def decoded(frame: DataFrame, path: str = MODEL) -> DataFrame:
    """(doc_id, text) for every row of frame (doc_id, ids); null ids, a null among them or one outside the vocabulary give a null text."""
    held = frame.sparkSession.sparkContext.broadcast(Vocabulary(path))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decoder = Decoder(held.value)
        for batch in batches:
            known = range(len(decoder.bytes))
            lists = [x if x is None or all(i in known for i in x) else None for x in batch.column(1).to_pylist()]
            texts = [None if x is None else decoder.decode(np.array(x, np.int32)) for x in lists]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], ["doc_id", "text"])

    return frame.select(F.col("doc_id").cast("long"), F.col("ids").cast("array<int>")).mapInArrow(run, "doc_id long, text string")


def op6_pieces(spark: SparkSession, folder: str) -> DataFrame:
    return encoded(table(spark, folder, "documents"))
