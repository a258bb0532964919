"""Near-duplicate documents: an LSH forest over MinHash signatures, links confirmed on whole shingle sets."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from motionframes.llm.common import checkpointed, components, local_roots, saved, slices, table

#: Words of a shingle; a link needs 100 * intersection >= LINK * union.
SHINGLE, LINK = 5, 75
#: Orders of the forest; each sorts by LEVELS values of 16 bits. Two documents at the link limit share the
#: first MIN_DEPTH values in some order except in 2 of a million cases.
TREES, LEVELS, MIN_DEPTH = 16, 4, 2
#: Documents of a region that are compared in one task.
REGION = 256
#: Estimated similarity below which a candidate isn't confirmed: 4.6 standard errors under the limit.
LEAST_ESTIMATE = 0.5
#: Bits of the fixed-size filter that says which sets are needed (2 MB).
FILTER_BITS = 1 << 24
_STEP = np.uint64(0x9FB21C651E98DF25)


class _Hashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) > 400_000:
            self.clear()
        self[word] = value = xxhash.xxh3_64_intdigest(word)
        return value


def shingles(text: str | None, hashes: dict) -> np.ndarray:
    """Distinct hashed shingles, sorted; a text of fewer words is one shingle, one without words none."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return np.empty(0, np.uint64)
    w = np.fromiter(map(hashes.__getitem__, words), np.uint64, len(words))
    n = min(SHINGLE, len(w))
    with np.errstate(over="ignore"):
        h = np.full(len(w) - n + 1, n, np.uint64)
        for j in range(n):
            h = (h ^ w[j : len(w) - n + 1 + j]) * _STEP
            h ^= h >> np.uint64(29)
    return np.unique(h)


def _family() -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(20)
    a, b = rng.integers(1, 1 << 63, (2, TREES * LEVELS), dtype=np.uint64)
    return (a | np.uint64(1))[:, None], b[:, None]


def signature(held: np.ndarray, family: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """A 64-bit key for each order: 16 bits of each of its LEVELS minima."""
    low = np.full(TREES * LEVELS, np.iinfo(np.uint64).max, np.uint64)
    with np.errstate(over="ignore"):
        for at in range(0, len(held), 4096):
            low = np.minimum(low, (held[None, at : at + 4096] * family[0] + family[1]).min(1))
        bits = (low * _STEP) >> np.uint64(48)
    keys = np.zeros(TREES, np.uint64)
    for level in range(LEVELS):
        keys = (keys << np.uint64(16)) | bits[level::LEVELS]
    return keys.view(np.int64)


def signatures(docs: DataFrame) -> DataFrame:
    """(doc_id, n_shingles, h1, h2, sig): h1 and h2 are equal for equal sets only."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hashes, family = _Hashes(), _family()
        for batch in batches:
            rows = []
            for text in batch["text"]:
                s = shingles(text, hashes)
                with np.errstate(over="ignore"):
                    mixed = (s ^ (s >> np.uint64(31))) * _STEP
                    h = [int(x.view(np.int64)) for x in (s.sum(dtype=np.uint64), (mixed ^ (mixed >> np.uint64(27))).sum(dtype=np.uint64))]
                rows.append((len(s), *h, signature(s, family)))
            out = pd.DataFrame(rows, columns=["n_shingles", "h1", "h2", "sig"])
            out.insert(0, "doc_id", batch["doc_id"].to_numpy())
            yield out.astype({"doc_id": "Int64"})

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInPandas(run, "doc_id long, n_shingles long, h1 long, h2 long, sig array<long>")


def regions(reps: DataFrame) -> DataFrame:
    """(tree, prefix, crowd, key, rep, region): who meets whom in each order.

    A region is what shares MIN_DEPTH values in an order; where more than REGION documents do, it is what shares
    one value more, and so on; the deepest regions are dealt by hash. Documents alone in a region are left out.
    """
    order = F.posexplode("sig").alias("tree", "key")
    rows = reps.select("rep", order).withColumn("prefix", F.shiftrightunsigned("key", 64 - 16 * MIN_DEPTH))
    sizes = rows.groupBy("tree", "prefix").agg(F.count("*").alias("crowd")).where("crowd > 1")
    met = saved(rows.join(sizes, ["tree", "prefix"]), "forest-rows")
    found = met.where(F.col("crowd") <= REGION).withColumn("region", F.struct(F.lit(MIN_DEPTH).alias("depth"), "prefix", F.lit(0).alias("part")))
    left = met.where(F.col("crowd") > REGION)
    for depth in range(MIN_DEPTH + 1, LEVELS + 1):
        left = left.withColumn("at", F.shiftrightunsigned("key", 64 - 16 * depth))
        left = left.join(left.groupBy("tree", "at").agg(F.count("*").alias("n")), ["tree", "at"])
        parts = F.ceil(F.col("n") / REGION).cast("int") if depth == LEVELS else F.lit(1)
        here = left if depth == LEVELS else left.where(F.col("n") <= REGION)
        part = F.pmod(F.xxhash64("rep"), parts).cast("int").alias("part")
        here = here.withColumn("region", F.struct(F.lit(depth).alias("depth"), F.col("at").alias("prefix"), part))
        found = found.unionByName(here.drop("at", "n"))
        left = left.where(F.col("n") > REGION).drop("at", "n")
    return found


def _estimates(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Share of equal values for all of a against all of b, as 16-bit matrices."""
    return np.stack([(row == b).mean(1) for row in a]) if len(a) else np.zeros((0, len(b)))


def _values(sigs: pd.Series) -> np.ndarray:
    return np.ascontiguousarray(np.stack(sigs.to_numpy()).astype(np.int64)).view(np.uint16)


def _grouped(batches: Iterator[pd.DataFrame], key: str) -> Iterator[pd.DataFrame]:
    """Whole groups from batches sorted by a key."""
    open_ = None
    for batch in batches:
        if open_ is not None:
            batch = pd.concat([open_, batch])
        if batch.empty:
            continue
        last = batch[key].to_numpy() == batch[key].iloc[-1]
        open_ = batch[last]
        for _, group in batch[~last].groupby(key, sort=False):
            yield group
    if open_ is not None:
        yield open_


def _neighbours(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Neighbours in the order: the longest common prefixes."""
    for rows in _grouped(batches, "cell"):
        if len(rows) > 1:
            v, ids = _values(rows["sig"]), rows["rep"].to_numpy()
            near = (v[1:] == v[:-1]).mean(1)
            yield pd.DataFrame({"a": np.minimum(ids[1:], ids[:-1]), "b": np.maximum(ids[1:], ids[:-1]), "estimate": near})[near >= LEAST_ESTIMATE]


def _likely(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Members of a cell that look similar enough to a member of another component; with sides, of the other side."""
    for rows in _grouped(batches, "cell"):
        comp, side = rows["component"].to_numpy(), rows["side"].to_numpy()
        left, right = np.flatnonzero(side <= 1), np.flatnonzero(side != 1)
        if len(rows) < 2 or (comp == comp[0]).all() or not len(left) or not len(right):
            continue
        v = _values(rows["sig"])
        hit = (_estimates(v[left], v[right]) >= LEAST_ESTIMATE) & (comp[left][:, None] != comp[right][None, :])
        keep = np.zeros(len(rows), bool)
        keep[left[hit.any(1)]] = True
        keep[right[hit.any(0)]] = True
        if keep.any():
            yield rows.loc[keep, ["cell", "rep"]].drop_duplicates()


def similar(sets: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Places (i, j), i < j, of the sets that are similar enough. Whole intersections, from products over the shingles that two sets or more hold."""
    sizes, n = np.array([len(s) for s in sets]), len(sets)
    shingle, owner = np.concatenate(sets), np.repeat(np.arange(n), sizes)
    order = np.argsort(shingle, kind="stable")
    shingle, owner = shingle[order], owner[order]
    number = np.cumsum(np.concatenate([[True], shingle[1:] != shingle[:-1]])) - 1
    shared = np.bincount(number)[number] > 1
    owner, number = owner[shared], np.unique(number[shared], return_inverse=True)[1]
    both = np.zeros((n, n), np.int64)
    for at in range(0, int(number[-1]) + 1 if len(number) else 0, 4096):
        a, b = np.searchsorted(number, [at, at + 4096])
        held = np.zeros((n, 4096), np.float32)
        held[owner[a:b], number[a:b] - at] = 1
        both += (held @ held.T).astype(np.int64)
    union = sizes[:, None] + sizes[None, :] - both
    return np.nonzero(np.triu((100 * both >= LINK * union) & (both > 0), 1))


def _joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each member of a cell with the first that confirmed links of the cell lead to, from batches sorted by cell. Sets are read in place."""

    def links(cell: list[pa.RecordBatch]) -> tuple[np.ndarray, np.ndarray]:
        ids = np.concatenate([part["rep"].to_numpy() for part in cell])
        root = local_roots(len(ids), *similar([_held(s) for part in cell for s in part["shingles"]]))
        differ = ids != ids[root]
        return ids[differ], ids[root][differ]

    open_, last = [], None
    for batch in batches:
        cells, out = batch["cell"].to_numpy(), []
        starts = np.flatnonzero(np.concatenate([[True], cells[1:] != cells[:-1]])) if len(cells) else np.zeros(0, int)
        for a, b in zip(starts, np.append(starts[1:], len(cells))):
            if open_ and cells[a] != last:
                out.append(links(open_))
                open_ = []
            open_.append(batch.slice(a, b - a))
            last = cells[a]
        yield _links(out)
    if open_:
        yield _links([links(open_)])


def _links(found: list[tuple[np.ndarray, np.ndarray]]) -> pa.RecordBatch:
    return pa.record_batch({c: np.concatenate([np.zeros(0, np.int64), *[f[k] for f in found]]) for k, c in enumerate(("src", "dst"))})


def _held(shingles: pa.BinaryScalar) -> np.ndarray:
    return np.frombuffer(shingles.as_buffer(), np.uint64)


def _in_cells(rows: DataFrame, reps: DataFrame, *order: str) -> DataFrame:
    held = rows.join(reps.select("rep", "sig"), "rep")
    return held.repartition("cell").sortWithinPartitions("cell", *order)


def sets_of(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """(id, shingles) of every different set under the given ids, written.

    A fixed-size bit filter keeps the sets of other documents from being made.
    """
    spot = lambda c: F.pmod(F.xxhash64(c), F.lit(FILTER_BITS))
    word = F.expr("spot div 32768").alias("word")
    marks = ids.select(spot("id").alias("spot")).groupBy(word).agg(F.bitmap_construct_agg(F.col("spot") % 32768).alias("bits"))
    packed = np.zeros((FILTER_BITS // 32768, 4096), np.uint8)
    for at, held in marks.collect():
        packed[at] = np.frombuffer(held, np.uint8)
    flags = docs.sparkSession.sparkContext.broadcast(packed.ravel())

    def sets(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hashes, wanted = _Hashes(), np.unpackbits(flags.value, bitorder="little")
        for batch in batches:
            batch = batch[wanted[batch["spot"].to_numpy()] > 0]
            for texts in slices(batch["text"].tolist()):
                part, batch = batch.iloc[: len(texts)], batch.iloc[len(texts) :]
                yield pd.DataFrame({"id": part["doc_id"].to_numpy(), "shingles": [shingles(t, hashes).tobytes() for t in texts]})

    texts = docs.where("doc_id is not null").select(F.col("doc_id").cast("long"), F.col("text").cast("string")).withColumn("spot", spot("doc_id"))
    made = texts.mapInPandas(sets, "id long, shingles binary").where(F.octet_length("shingles") > 0)
    kept = made.join(ids, "id", "left_semi").withColumn("hash", F.xxhash64("shingles")).dropDuplicates(["id", "hash"])
    return saved(kept.drop("hash"), "forest-sets")


def confirmed(docs: DataFrame, pairs: DataFrame) -> DataFrame:
    """The pairs (a, b) of which two whole shingle sets are similar enough."""
    pairs = checkpointed(pairs)
    held = sets_of(docs, pairs.select(F.explode(F.array("a", "b")).alias("id")).distinct())

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y in zip(batch["x"], batch["y"]):
                p, q = _held(x), _held(y)
                both = len(np.intersect1d(p, q, assume_unique=True))
                keep.append(100 * both >= LINK * (len(p) + len(q) - both))
            yield batch.select(["src", "dst"]).filter(pa.array(keep, pa.bool_()))

    one = pairs.join(held.select(F.col("id").alias("a"), F.col("shingles").alias("x")), "a")
    two = one.join(held.select(F.col("id").alias("b"), F.col("shingles").alias("y")), "b")
    return saved(two.select(F.col("a").alias("src"), F.col("b").alias("dst"), "x", "y").mapInArrow(check, "src long, dst long"), "forest-links")


def within_cells(docs: DataFrame, members: DataFrame) -> DataFrame:
    """(src, dst): members (cell, rep) that links of a cell lead from one to the other. A set travels once a cell, and no pair leaves a task."""
    members = saved(members, "forest-likely")
    held = sets_of(docs, members.select(F.col("rep").alias("id")).distinct())
    rows = members.join(held.withColumnRenamed("id", "rep"), "rep").repartition("cell").sortWithinPartitions("cell")
    return saved(rows.mapInArrow(_joined, "src long, dst long"), "forest-joined")


def near_duplicates(docs: DataFrame) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) for every row of docs (doc_id, text).

    Equal sets are one node from the start. First each node's likeliest neighbours in the orders are confirmed
    and joined. Then those that share a region, look similar enough and are still apart bring their whole sets
    to the region, where all of them are compared; where a region was too crowded to be compared whole, those
    outside its largest component meet all of it, in blocks. So a large group of copies costs a few
    confirmations a member, not its pairs, and no link between components is lost but by the forest's own
    rate of misses.

    Null or empty texts and texts without words have an empty set and stand alone. Rows with a null doc_id stand alone, with a null
    component_id, and are kept. Rows that share a doc_id are one node with the links of all their texts. Long texts are whole sets like
    others. An empty table gives an empty result. Other columns of docs are not read.
    """
    signed = saved(signatures(docs), "forest-signatures")
    usable = signed.where("doc_id is not null and n_shingles > 0")
    classes = usable.groupBy("h1", "h2").agg(F.min("doc_id").alias("rep"), F.count("*").alias("copies"), F.first("sig").alias("sig"))
    classes = saved(classes, "forest-classes")
    same = classes.where("copies > 1").select("h1", "h2", "rep")
    placed = signed.join(same, ["h1", "h2"], "left").select("doc_id", "n_shingles", F.when(F.col("doc_id").isNotNull(), F.coalesce("rep", "doc_id")).alias("rep"))

    met = saved(regions(classes).withColumn("cell", F.xxhash64("tree", "region")).drop("region"), "forest-regions")
    near = _in_cells(met.select("cell", "key", "rep"), classes, "key", "rep").mapInPandas(_neighbours, "a long, b long, estimate double")
    near = checkpointed(near.where("a <> b").distinct())
    ends = near.select(F.explode(F.array("a", "b")).alias("end"), "a", "b", "estimate")
    best = Window.partitionBy("end").orderBy(F.desc("estimate"), "a", "b")
    first = ends.withColumn("rank", F.row_number().over(best)).where("rank <= 2").select("a", "b").distinct()
    links = confirmed(docs, first)

    # Two texts under one doc_id tie their classes together.
    twice = placed.where("doc_id <> rep").select(F.col("doc_id").alias("src"), F.col("rep").alias("dst")).join(classes.select(F.col("rep").alias("src")), "src", "left_semi")
    joined = components(links.unionByName(twice)).select(F.col("id").alias("rep"), "component")
    known = checkpointed(met.join(joined, "rep", "left").withColumn("component", F.coalesce("component", "rep")))
    rest = known.select("cell", "component", "rep", F.lit(0).alias("side"))
    every = [_in_cells(rows, classes).mapInPandas(_likely, "cell long, rep long") for rows in (rest, _crowded(known))]
    second = within_cells(docs, every[0].unionByName(every[1]))
    final = components(links.unionByName(twice).unionByName(second)).select(F.col("id").alias("rep"), F.col("component").alias("root"))
    component = F.coalesce("root", "rep")
    return placed.join(final, "rep", "left").select(
        "doc_id", "n_shingles", component.alias("component_id"), F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept")
    )


def _crowded(known: DataFrame) -> DataFrame:
    """Cells in which those outside a crowded region's largest component (side 1) meet a block of the whole region (side 2)."""
    rows = known.where(F.col("crowd") > REGION)
    sizes = rows.groupBy("tree", "prefix", "component").agg(F.count("*").alias("n"))
    largest = sizes.groupBy("tree", "prefix").agg(F.max_by("component", "n").alias("largest"), (F.sum("n") - F.max("n")).alias("others"))
    rows = rows.join(largest.where("others > 0"), ["tree", "prefix"])
    n, m = F.ceil(F.col("crowd") / REGION).cast("int"), F.ceil(F.col("others") / REGION).cast("int")
    deal = lambda k: F.pmod(F.xxhash64("rep", F.lit(3)), k).cast("int")
    every = lambda k: F.explode(F.sequence(F.lit(0), k - 1))
    cell = F.xxhash64("tree", "prefix", "i", "j", F.lit("crowd")).alias("cell")
    one = rows.where("component <> largest").withColumn("j", deal(m)).withColumn("i", every(n)).select(cell, "component", "rep", F.lit(1).alias("side"))
    two = rows.withColumn("i", deal(n)).withColumn("j", every(m)).select(cell, "component", "rep", F.lit(2).alias("side"))
    return one.unionByName(two)


def op8_near_duplicates(spark: SparkSession, folder: str) -> DataFrame:
    return near_duplicates(table(spark, folder, "documents").select("doc_id", "text"))
