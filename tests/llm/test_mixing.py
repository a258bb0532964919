import hashlib
from collections import defaultdict

import pytest

from motionframes.llm.mixing import Mix, leaf_budgets, mixed


def water(budget, nodes):
    """Budgets of {name: (weight, holds)}: everyone rises together until full."""
    got, open_ = dict.fromkeys(nodes, 0.0), {n for n, (w, h) in nodes.items() if w > 0 and h > 0}
    left = min(budget, sum(nodes[n][1] for n in open_))
    while open_ and left > 1e-9:
        step = min([left / sum(nodes[n][0] for n in open_)] + [(nodes[n][1] - got[n]) / nodes[n][0] for n in open_])
        for n in open_:
            got[n] += step * nodes[n][0]
        left -= step * sum(nodes[n][0] for n in open_)
        open_ = {n for n in open_ if nodes[n][1] - got[n] > 1e-9}
    return got


def test_budgets_against_rising_water(spark, rng):
    leaves = [(f"d{d}", lang, f"s{s}", int(rng.integers(0, 500))) for d in range(3) for lang in ("en", "de", "") for s in range(4)]
    frame = spark.createDataFrame(leaves, "mix_domain string, mix_lang string, mix_source string, tokens long")
    mix = Mix()
    found = {tuple(r)[:3]: r.budget for r in leaf_budgets(frame, mix).collect()}
    holds = {k[:3]: 2.0 * k[3] for k in leaves}
    top = water(0.8 * sum(k[3] for k in leaves), {d: (w, sum(h for k, h in holds.items() if k[0] == d)) for d, w in (("d0", 0.5), ("d1", 0.3), ("d2", 0.2))})
    for d, b in top.items():
        langs = water(b, {lang: (0.55 if lang == "en" else 0.15, sum(h for k, h in holds.items() if k[:2] == (d, lang))) for lang in ("en", "de", "")})
        for lang, c in langs.items():
            for s, leaf in water(c, {k[2]: (1.0, h) for k, h in holds.items() if k[:2] == (d, lang)}).items():
                assert found[d, lang, s] == pytest.approx(leaf, abs=0.51)


@pytest.mark.parametrize("bucket_rows", [5, 50_000])
def test_prefix_of_the_epoch(spark, bucket_rows):
    rows = [(i, "w " * (1 + i % 7), "en" if i % 3 else "de", f"src{i % 2}", "x") for i in range(300)]
    mix = Mix(bucket_rows=bucket_rows)
    found = mixed(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, epoch string"), mix).collect()
    by = defaultdict(list)
    for r in found:
        by[r.mix_domain, r.mix_lang, r.mix_source, r.mix_epoch].append((r.doc_id, r.mix_tokens, r.budget, r.tokens))
    assert {r.epoch for r in found} == {"x"}
    for (_, lang, source, epoch), got in by.items():
        all_ = [(i, 1 + i % 7) for i, _, la, so, _ in rows if (la, so) == (lang, source)]
        left = got[0][2] - epoch * got[0][3]
        want, start = set(), 0
        for i, n in sorted(all_, key=lambda x: hashlib.md5(f"{x[0]}|17|{epoch}".encode()).hexdigest()):
            if start < left:
                want.add(i)
            start += n
        assert {g[0] for g in got} == want


def test_odd_rows(spark):
    schema = "doc_id long, text string, lang string, source string"
    assert mixed(spark.createDataFrame([], schema), Mix()).count() == 0
    rows = [(None, None, None, None), (1, "", "en", "a"), (2, "one two", None, None), (2, "one two", None, None), (3, "x " * 5000, "en", "a")]
    found = mixed(spark.createDataFrame(rows, schema), Mix()).collect()
    assert {r.doc_id for r in found} >= {2, 3}
