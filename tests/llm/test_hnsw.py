import numpy as np
import pytest

from motionframes.llm import hnsw


def brute(rows, least=0.9):
    ok = {}
    for i, v in rows:
        if i is not None and v is not None and len(v) and all(x is not None and np.isfinite(x) for x in v) and any(v):
            ok[i] = np.array(v, float) / np.linalg.norm(np.array(v, float))
    ids = sorted({i for i, _ in rows})
    links = {i: [j for j in ids if i != j and i in ok and j in ok and len(ok[i]) == len(ok[j]) and ok[i] @ ok[j] >= least] for i in ids}
    root = {}
    for i in ids:
        if i not in root:
            todo = [i]
            while todo:
                j = todo.pop()
                if j not in root:
                    root[j] = i
                    todo += links[j]
    return {(i, len(links[i]), root[i], root[i] == i) for i in ids}


@pytest.mark.parametrize("tasks", [1, 3])
def test_against_brute_force(spark, rng, monkeypatch, tasks):
    monkeypatch.setattr(hnsw, "TASK_QUERIES", 500 // tasks)
    base = rng.normal(size=(300, 16))
    rows = [(i, [float(x) for x in v]) for i, v in enumerate(base)]
    for c, size in ((0, 120), (5, 30), (9, 2)):
        rows += [(1000 * (c + 1) + k, [float(x) for x in base[c] + rng.normal(size=16) * 0.15]) for k in range(size)]
    rows += [(90_000 + k, rows[7][1]) for k in range(25)]
    rows += [(91_000, None), (91_001, [0.0] * 16), (91_002, [float("nan")] * 16), (91_003, [None] * 16), (91_004, []), (91_005, [1.0]), (91_006, [2.0])]
    frame = spark.createDataFrame([(*r, "x") for r in rows], "vec_id long, embedding array<double>, id string")
    assert {tuple(r) for r in hnsw.near_vectors(frame, 0.9).collect()} == brute(rows)


def test_odd_rows(spark):
    schema = "vec_id long, embedding array<float>"
    assert hnsw.near_vectors(spark.createDataFrame([], schema), 0.9).count() == 0
    found = hnsw.near_vectors(spark.createDataFrame([(None, [1.0, 0.0]), (3, [1.0, 0.0]), (5, [1.0, 0.0])], schema), 0.9).collect()
    assert sorted(map(tuple, found), key=str) == sorted([(None, 0, None, True), (3, 1, 3, True), (5, 1, 3, False)], key=str)


def test_graph_recall(rng):
    unit = rng.normal(size=(4000, 24))
    unit /= np.linalg.norm(unit, axis=1, keepdims=True)
    unit[2000:] = unit[:2000] + rng.normal(size=(2000, 24)) * 0.05
    unit /= np.linalg.norm(unit, axis=1, keepdims=True)
    graph = hnsw.Graph(unit)
    i, j = graph.within(unit.astype(np.float32), 0.9, graph.audited_width(0.9))
    assert len(i) >= 0.99 * (unit @ unit.T >= 0.9).sum()


def test_no_pair_is_missed_beside_a_large_group():
    """The group has 490,000 of the links, the 1,000 pairs 2,000: a share of all links says nothing about the pairs."""
    import pandas as pd

    rng = np.random.default_rng(7)
    group = rng.normal(size=(1, 64)) + rng.normal(size=(700, 64)) * 0.001
    single = rng.normal(size=(1000, 64))
    vectors = np.concatenate([group, single, single + rng.normal(size=(1000, 64)) * 0.3])
    frame = lambda kind: pd.DataFrame({"cell": 1, "kind": kind, "id": np.arange(len(vectors)), "copies": 1, "vector": list(vectors)})
    found = pd.concat(hnsw._linker(0.9)(iter([frame(0), frame(1)])))
    counts = found[found["other"].isna()].set_index("id")["n"].reindex(range(len(vectors)), fill_value=0)
    unit = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
    assert counts.tolist() == ((unit @ unit.T >= 0.9).sum(1) - 1).tolist()
