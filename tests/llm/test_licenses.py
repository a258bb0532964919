import random
import re

import pytest

from motionframes.llm import licenses

NOTICES = (("a", "alpha beta gamma delta epsilon"), ("b", "the of and to zeta eta theta iota"), ("c", "the of and alpha"))


def cut(text):
    lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return [w for w in re.split(licenses.BETWEEN, lowered) if w]


def brute(text, notices, percent):
    words, step = cut(text), max(len(t.split()) for _, t in notices)
    found = set()
    for first in range(0, max(1, len(words) - step), step):
        block = set(words[first : first + 2 * step])
        for label, notice in notices:
            wanted = set(notice.split())
            if 100 * len(wanted & block) >= percent * len(wanted):
                found.add((first, label, len(wanted & block) / len(wanted)))
    return found


def frame(spark, texts):
    return spark.createDataFrame([(i, t, -1, "x") for i, t in enumerate(texts)], "doc_id long, text string, row int, words string")


@pytest.mark.parametrize("percent", [60, 80, 100])
def test_blocks_against_every_pair(spark, percent):
    r = random.Random(percent)
    vocabulary = sorted({w for _, t in NOTICES for w in t.split()}) + [f"x{i}" for i in range(8)]
    texts = [" ".join(r.choices(vocabulary, k=r.randrange(0, 90))) for _ in range(150)]
    texts += [None, "", " .,;\n", "Alpha-BETA,gamma\tdelta (epsilon)", "the " * 5000 + NOTICES[1][1]]
    rows, found = licenses.scanned(frame(spark, texts), NOTICES, percent)
    ids = {x["row"]: x["doc_id"] for x in rows.select("row", "doc_id").collect()}
    pairs = [(ids[x["row"]], x["first"], x["label"], x["share"]) for x in found.collect()]
    assert len(pairs) == len(set(pairs))
    assert set(pairs) == {(i, *x) for i, t in enumerate(texts) for x in brute(t, NOTICES, percent)}


def test_places(spark, tmp_path):
    texts = ["mit license MIT  License", "the general\npublic license; Apache-License", "mitK license", "licenses mit", None, "é mit license"]
    docs = frame(spark, texts).unionByName(frame(spark, texts[:1]))
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    rows = licenses.op11_license_blocks(spark, str(tmp_path)).orderBy("doc_id").collect()
    got = [tuple(r[c] for c in ("doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "score")) for r in rows]
    none = (0, None, None, "", 0.0)
    assert got[:2] == [(0, 4, 2, 0, 2, "mit", 1.0)] * 2
    assert got[2:] == [(1, 6, 2, 1, 4, "apache,gpl", 1.0), (2, 2, *none), (3, 2, *none), (4, 0, *none), (5, 3, 1, 1, 1, "mit", 1.0)]


def test_notices_are_found_where_they_wrap(spark, tmp_path):
    bsd = dict(licenses.NOTICES)["bsd"].upper().replace(" ", "\n# ")
    texts = ["word " * n + bsd + " more" * 7 for n in range(0, 45, 7)] + ["redistribution and use in source", "Licensed under CC BY-NC 4.0."]
    frame(spark, texts).write.parquet(f"{tmp_path}/documents.parquet")
    rows = licenses.op11_license_blocks(spark, str(tmp_path)).orderBy("doc_id").collect()
    assert [r["labels"] for r in rows] == ["bsd"] * 7 + ["", "cc-by-nc"]
    assert all(r["base_labels"] == "" for r in rows)


def test_empty_table_and_no_python(spark, tmp_path):
    frame(spark, ["x"]).where("false").write.parquet(f"{tmp_path}/documents.parquet")
    found = licenses.op11_license_blocks(spark, str(tmp_path))
    assert found.collect() == []
    assert "Python" not in found._jdf.queryExecution().toString() and "Pandas" not in found._jdf.queryExecution().toString()
