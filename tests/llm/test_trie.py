import hashlib
import random
import zlib

import numpy as np
import pyarrow as pa
import pytest

from motionframes.llm import trie

SCHEMA = "conv_id long, turn long, role string, text string, part int, depth string, member string"


def rebuilt(rows):
    held = {}
    for c, turn, role, text, *_ in rows:
        if c is not None:
            role, text = role or "", text or ""
            name = hashlib.sha256(f"{len(role)}:{role}{text}".encode()).digest()
            held.setdefault(c, []).append((turn is not None, turn or 0, role, name, text))
    held = {c: [(r[2], r[4]) for r in sorted(v)] for c, v in held.items()}
    out = {}
    for c, own in held.items():
        h = zlib.crc32(str(c).encode()) % 9
        base = c - int(np.fmod(c, 5))
        out[c] = held.get(base, [])[:h] + own[h:]
    return out


def nodes_of(paths):
    """Every node with its members, from whole prefixes."""
    members = {}
    for c, turns in paths.items():
        for d in range(len(turns) + 1):
            members.setdefault(tuple(turns[:d]), []).append(c)
    below = {k: [o for o in members if o[: len(k)] == k] for k in members}
    children = {k: [o for o in below[k] if len(o) == len(k) + 1] for k in members}
    out = []
    for k, m in members.items():
        ends = ",".join(str(c) for c in sorted(c for c in m if len(paths[c]) == len(k)))
        saved = sum((len(members[o]) - 1) * len(o[-1][1].encode()) for o in below[k] if o)
        parent = min(members[k[:-1]]) if k else None
        leaves = sum(not children[o] for o in below[k])
        out.append((min(m), len(k), parent, len(m), len(children[k]), leaves, saved, hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


def conversations(seed):
    r = random.Random(seed)
    stems = [[(r.choice(["user", "bot"]), f"t{r.randrange(4)}é") for _ in range(12)] for _ in range(3)]
    rows = []
    for c in [*range(0, 60), *range(-12, 0), 1000, 1007]:
        if c % 7 == 5:
            continue
        stem = r.choice(stems)
        turns = stem[: r.randrange(0, 12)] + [("user", f"t{r.randrange(3)}") for _ in range(r.randrange(0, 5))]
        rows += [(c, None if i == 0 else i, *t, 0, "x", "y") for i, t in enumerate(turns)]
    rows += [(200 + k, i, "user", f"same {i}", 0, "x", "y") for k in range(0, 150, 5) for i in range(3)]
    rows += [(500, i, "user", f"long {i % 9}", 0, "x", "y") for i in range(130)] + [(501, i, "user", f"long {i % 9}", 0, "x", "y") for i in range(90)]
    rows += [(600, 4, "b", "tie", 0, "", ""), (600, 4, "a", "tie", 0, "", ""), (600, 4, None, None, 0, "", ""), (None, 1, "user", "lost", 0, "", "")]
    r.shuffle(rows)
    return rows


@pytest.fixture
def many_partitions(spark):
    was = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    spark.conf.set("spark.sql.shuffle.partitions", "13")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield
    for k, v in was.items():
        spark.conf.set(k, v)


@pytest.mark.parametrize("size", [3, 50])
def test_against_whole_prefixes(spark, many_partitions, size):
    rows = conversations(size)
    turns = trie.ordered(spark.createDataFrame(rows, SCHEMA))
    assert sorted(map(tuple, trie.trie(trie.rebuilt(turns), size).collect()), key=str) == nodes_of(rebuilt(rows))


def test_query_on_one_partition(spark, tmp_path):
    rows = conversations(9)
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.parquet(f"{tmp_path}/conversations.parquet")
    found = trie.op13_prefix_trie(spark, str(tmp_path))
    assert sorted(map(tuple, found.collect()), key=str) == nodes_of(rebuilt(rows))


@pytest.mark.parametrize("rows", [[], [(None, 1, "user", "x", 0, "", "")], [(5, None, None, None, 0, "", "")], [(7, 0, "user", "x", 0, "", "")]])
def test_few_rows(spark, rows):
    found = trie.trie(trie.rebuilt(trie.ordered(spark.createDataFrame(rows, SCHEMA)))).collect()
    assert sorted(map(tuple, found), key=str) == nodes_of(rebuilt(rows))


@pytest.mark.parametrize("n", [1, 2, 63, 64, 65, 1000, 9000])
def test_findclose_against_a_stack(rng, n):
    for share in (0.3, 0.5, 0.8):
        bits = (rng.random(n) < share).astype(np.int8)
        stack, expected = [], {}
        for i, b in enumerate(bits.tolist()):
            if b:
                stack.append(i)
            elif stack:
                expected[stack.pop()] = i
        opens = np.flatnonzero(bits)
        assert trie.Parentheses(bits).findclose(opens).tolist() == [expected.get(i, -1) for i in opens.tolist()]


def test_long_lists_of_ids_are_hashed_in_pieces():
    ids = list(range(100, 350))
    batch = lambda part: pa.record_batch({"conv_id": pa.array(part), **{c: pa.array([7] * len(part)) for c in ("depth", "s1", "s2")}, "part": pa.array([0] * len(part), pa.int32())})
    listed = list(trie._listed(iter([batch(ids[:90]), batch(ids[90:])]), 40))
    assert [b.num_rows for b in listed] == [3, 4]
    out = [r for b in trie._hashed(iter(listed)) for r in b.to_pylist()]
    assert [r["ends"] for r in out] == [hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()]
