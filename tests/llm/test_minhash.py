import random

import pytest

from motionframes.llm import minhash


def brute(rows):
    sets, root = {}, {}
    for i, text, *_ in rows:
        w = [x.decode() for x in (text or "").encode().lower().split()]
        sets[i] = {tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} if w else set()
        root[i] = i

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    ids = sorted(sets)
    for n, a in enumerate(ids):
        for b in ids[n + 1 :]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= 75 * len(sets[a] | sets[b]):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {(i, len(sets[i]), find(i), i == find(i)) for i in ids}


def texts(seed):
    r = random.Random(seed)
    rows, at = [], 0
    for size in [1] * 60 + [2] * 20 + [3] * 10 + [40, 25]:
        words = [f"w{r.randrange(900)}" for _ in range(r.randrange(30, 120))]
        for _ in range(size):
            own = list(words)
            for _ in range(r.randrange(0, 4)):
                own[r.randrange(len(own))] = f"x{r.randrange(10**6)}"
            rows.append((at * 7 % 1009, " ".join(own)))
            at += 1
    return rows


@pytest.mark.parametrize("region", [256, 8])
def test_against_brute_force(spark, monkeypatch, region):
    monkeypatch.setattr(minhash, "REGION", region)
    rows = texts(region)
    rows += [(2000, None), (2001, ""), (2002, " \t\n"), (2003, "a b"), (2004, "A\tB"), (2005, "word " * 30_000), (2006, "word " * 29_000)]
    rows += [(2100 + i, "the same text in many copies of it") for i in range(40)]
    frame = spark.createDataFrame([(*x, "k") for x in rows], "doc_id long, text string, rep string")
    assert {tuple(r) for r in minhash.near_duplicates(frame).collect()} == brute(rows)


def test_odd_rows(spark):
    schema = "doc_id long, text string"
    assert minhash.near_duplicates(spark.createDataFrame([], schema)).count() == 0
    rows = [(None, "one two three"), (4, "one two three"), (4, "one two three"), (9, "one two three"), (5, "ä Ä")]
    found = sorted(map(tuple, minhash.near_duplicates(spark.createDataFrame(rows, schema)).collect()), key=str)
    assert found == sorted([(None, 1, None, True), (4, 1, 4, True), (4, 1, 4, True), (9, 1, 4, False), (5, 1, 5, True)], key=str)


def by_rows(rows):
    """Components over ids from all pairs of rows, whatever their ids."""
    root, held = {i: i for i, _ in rows}, []
    for i, text in rows:
        w = text.split()
        held.append((i, {tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))}))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for n, (a, s) in enumerate(held):
        for b, t in held[n + 1 :]:
            both = len(s & t)
            if 100 * both >= 75 * (len(s) + len(t) - both):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {i: find(i) for i in root}


@pytest.mark.parametrize("region", [256, 40])
def test_a_large_group_that_starts_in_many_components(spark, monkeypatch, region):
    """Near copies of one text, most pairs about as similar as the limit: many components in one crowded region."""
    monkeypatch.setattr(minhash, "REGION", region)
    r = random.Random(5)
    words, rows = [f"w{i}" for i in range(120)], []
    for i in range(600):
        own = list(words)
        for _ in range(r.choice([1, 2, 3, 4, 4, 5])):
            own[r.randrange(len(own))] = f"x{i}-{r.random()}"
        rows.append((i, " ".join(own)))
    expected = by_rows(rows)
    found = {x["doc_id"]: x["component_id"] for x in minhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert 10 < len(set(expected.values())) < 590
    assert found == expected


def test_texts_of_a_repeated_id_keep_their_links(spark):
    rows = [(7, "a b c d e f g h i j"), (7, "q r s t u v w x y z"), (9, "q r s t u v w x y z k"), (11, "a b c d e f g h i j k"), (4, "q r s t u v w x y z k l")]
    found = minhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {x["component_id"] for x in found} == {4} and len(found) == 5
    assert set(by_rows(rows).values()) == {4}


def test_whole_intersections(rng):
    import numpy as np

    pool = rng.integers(0, 1 << 62, 9000, dtype=np.uint64)
    sets = [np.unique(rng.choice(pool[:m], k)) for m, k in [(60, 50), (60, 55), (9000, 6000), (9000, 7000), (60, 1), (50, 300), (50, 300)]] + [pool[:1], pool[:1]]
    expected = []
    for i, s in enumerate(sets):
        for j in range(i + 1, len(sets)):
            both = len(np.intersect1d(s, sets[j]))
            if 100 * both >= 75 * (len(s) + len(sets[j]) - both):
                expected.append((i, j))
    assert list(zip(*minhash.similar(sets))) == expected
