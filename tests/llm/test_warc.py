import base64
import hashlib

import pytest

from motionframes.llm import warc

SCHEMA = "page_id long, url string, html string, part string"


def round_trip(spark, tmp_path, rows):
    pages = spark.createDataFrame(rows, SCHEMA)
    warc.write_warc(warc.records(pages), f"{tmp_path}/w")
    return warc.merged_index(warc.read_warc(spark, f"{tmp_path}/w")).orderBy("position").collect()


@pytest.mark.parametrize("small", [False, True])
def test_round_trip(spark, tmp_path, monkeypatch, small):
    if small:
        monkeypatch.setattr(warc, "MERGE_ROWS", 20)
        monkeypatch.setattr(warc, "ARCHIVE_ROWS", 7)
    rows = [(i, f"http://h{i % 5}.example.com/p{i % 11}?q={i % 2}", ["<p>é\r\n\r\nWARC/1.1\r\n</p>", "", None, f"<b>{i}</b>"][i % 4], "x") for i in range(120)]
    rows += [(500, None, "a" * 300_000, None), (501, "http://x/\r\nWARC-Type: warcinfo", "z", None), (502, "http://[broken", "y", None)]
    found = round_trip(spark, tmp_path, rows)
    assert [r.position for r in found] == list(range(len(rows)))
    keys = [(r.url_key, r.captured, r.page_id) for r in found]
    assert keys == sorted(keys)
    last = {}
    for i, _, html, _ in rows:
        last[html or ""] = max(i, last.get(html or "", -1))
    html = {i: h or "" for i, _, h, _ in rows}
    for r in found:
        data = html[r.page_id].encode()
        assert (r.payload_bytes, r.payload_digest) == (len(data), base64.b32encode(hashlib.sha1(data).digest()).decode())
        assert r.digest_ok
        want = last[html[r.page_id]]
        assert (r.record_type, r.refers_to) == (("response", None) if want == r.page_id else ("revisit", want))


def test_null_ids_and_repeated_rows(spark, tmp_path):
    found = round_trip(spark, tmp_path, [(None, "http://a/", "p", None), (3, "http://a/", "p", None), (3, "http://a/", "p", None), (1, "http://b/", "p", None)])
    assert sorted((r.page_id or 0, r.record_type, r.refers_to) for r in found) == [(0, "response", None), (1, "revisit", 3), (3, "response", None), (3, "response", None)]


def test_no_pages(spark, tmp_path):
    assert round_trip(spark, tmp_path, []) == []


def test_loser_tree(rng):
    for k in range(10):
        runs = [sorted((int(x), int(y)) for x, y in rng.integers(0, 9, (rng.integers(0, 12), 2))) for _ in range(k)]
        assert list(warc.loser_tree_merge(runs)) == sorted(sum(runs, []))


def test_url_keys():
    assert warc.url_key("HTTP://Blog.Example.com:80/A?b=1#c") == "com,example,blog)/a?b=1"
    assert warc.url_key("http://a.b") == "b,a)/"
    assert warc.url_key("no host") == "no host"
