from motionframes.llm.sharding import contiguous_shards

def place(spark, rows, shards):
    frame = spark.createDataFrame(rows, "doc_id long, size long, lang string")
    return [tuple(r) for r in contiguous_shards(frame, ["doc_id"], shards).orderBy("shard", "slot").collect()]


def test_contiguous_and_balanced(spark, rng):
    rows = [(int(i), int(s), "x") for i, s in enumerate(rng.integers(16, 400, 3000))]
    found = place(spark, rows, 7)
    assert [r[:2] for r in found] == [r[:2] for r in rows]
    total, before = sum(r[1] for r in rows), 0
    for doc_id, size, _, shard, slot in found:
        assert shard == (2 * before + size) * 7 // (2 * total)
        before += size
    for s in range(7):
        assert [r[4] for r in found if r[3] == s] == list(range(sum(r[3] == s for r in found)))


def test_repeated_rows_are_split(spark):
    """One id with most rows, nulls, and identical rows: every shard still gets its share."""
    found = place(spark, [(5, 20, "a")] * 900 + [(None, 20, None)] * 100, 4)
    assert len(found) == 1000
    assert [sum(r[3] == s for r in found) for s in range(4)] == [250] * 4


def test_one_long_row_and_empty_tables(spark):
    found = place(spark, [(1, 16, "a"), (2, 10_000, "a"), (3, 16, "a")], 5)
    assert [(r[0], r[3], r[4]) for r in found] == [(1, 0, 0), (2, 2, 0), (3, 4, 0)]
    assert place(spark, [], 5) == []
    assert {r[3] for r in place(spark, [(i, 0, "z") for i in range(4)], 5)} == {0}


def test_query_with_null_and_empty_text(spark, tmp_path):
    import zlib

    from motionframes.llm.sharding import op9_prefix_sum_shards

    rows = [(1, None, "a"), (2, "", "b"), (3, "é" * 50, "c"), (3, "é" * 50, "c")]
    spark.createDataFrame(rows, "doc_id long, text string, shard string").write.parquet(f"{tmp_path}/documents.parquet")
    found = {(r.doc_id, r["size"], r.text_crc32) for r in op9_prefix_sum_shards(spark, str(tmp_path)).collect()}
    assert found == {(1, 16, 0), (2, 16, 0), (3, 116, zlib.crc32(("é" * 50).encode()))}


def test_names_that_clash_and_null_sizes(spark):
    rows = [(1, 16, "a", 7, 8, 9), (2, None, "b", 7, 8, 9), (3, 16, "c", 7, 8, 9)]
    frame = spark.createDataFrame(rows, "doc_id long, size long, salt string, part int, shard int, row int")
    found = contiguous_shards(frame, ["doc_id"], 2)
    assert found.columns == ["doc_id", "size", "salt", "part", "row", "shard", "slot"]
    assert [tuple(r) for r in found.orderBy("doc_id").collect()] == [(1, 16, "a", 7, 9, 0, 0), (2, None, "b", 7, 9, 1, 0), (3, 16, "c", 7, 9, 1, 1)]
