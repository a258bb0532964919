"""File readers and sinks on temporary files."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from motionframes.sources import archives, files, tidy


def test_archive_headers(spark, tmp_path):
    np.savez(tmp_path / "a.npz", time=np.arange(5.0), acc=np.zeros((5, 8, 3), np.float32), names=np.array(["x", "yy"]), ok=np.ones(5, bool))
    rows = {r.key: (list(r["shape"]), r.dtype) for r in archives.archive_headers(spark, str(tmp_path)).collect()}
    assert rows == {"time": ([5], "f8"), "acc": ([5, 8, 3], "f4"), "names": ([2], "U"), "ok": ([5], "bool")}


def test_broken_archives_and_other_members(spark, tmp_path):
    import zipfile

    np.savez(tmp_path / "whole.npz", time=np.arange(3.0))
    with zipfile.ZipFile(tmp_path / "whole.npz", "a") as archive:
        archive.writestr("readme.txt", "no array")
        archive.writestr("cut.npy", b"\x93NUMPY\x01\x00")
    (tmp_path / "torn.npz").write_bytes((tmp_path / "whole.npz").read_bytes()[:60])
    found = archives.archive_headers(spark, str(tmp_path)).collect()
    rows = {(r.path.rsplit("/", 1)[1], r.key, r.dtype, (r.problem or "").split(":")[0]) for r in found}
    assert rows == {
        ("whole.npz", "time", "f8", ""), ("whole.npz", "cut", None, "unreadable array"),
        ("torn.npz", None, None, "unreadable archive"),
    }


def test_digests_of_files_in_pieces(spark, tmp_path):
    import hashlib

    held = {"a.bin": b"", "b.bin": b"x" * 1000, "c.bin": bytes(range(256)) * 5}
    for name, data in held.items():
        (tmp_path / name).write_bytes(data)
    listed = files.list_files(spark, str(tmp_path)).select("path")
    listed = listed.unionByName(spark.createDataFrame([(f"file:{tmp_path}/gone",), (f"{tmp_path}/a.bin",), (None,)], "path string"))
    found = {r.path.rsplit("/", 1)[1]: (r.sha256, r.bytes, r.problem) for r in files.file_checksums(listed, path="path", chunk=7).collect()}
    assert found.pop("gone") == (None, None, "FileNotFoundError")
    assert found == {name: (hashlib.sha256(data).hexdigest(), len(data), None) for name, data in held.items()}


def test_marker_and_orientation_files(spark, tmp_path):
    (tmp_path / "m.csv").write_text("time,A_x,A_y,A_z\n0.0,1000,2000,\n0.01,1,2,3\n")
    rows = tidy.read_markers(spark, str(tmp_path / "m.csv"), time="time").orderBy("time").collect()
    assert [(r.marker, r.x, r.y, r.z) for r in rows] == [("A", 1.0, 2.0, None), ("A", 0.001, 0.002, 0.003)]
    (tmp_path / "q.csv").write_text("time,S_Qz,S_Qw,S_Qx,S_Qy\n0.0,4,1,2,3\n")
    r = tidy.read_orientations(spark, str(tmp_path / "q.csv"), time="time").first()
    assert (r.w, r.x, r.y, r.z) == (1.0, 2.0, 3.0, 4.0)


def test_incomplete_and_repeated_axes_are_refused(spark):
    df = spark.createDataFrame([("0", "1", "2")], "time string, A_x string, A_y string")
    with pytest.raises(ValueError, match="needs"):
        tidy.tidy_components(df, keys=["time"], pattern=r"^(.+)_([xyz])$", components="xyz", name="marker")
    with pytest.raises(ValueError, match="twice"):
        tidy.split_columns(["A_x", "A_X"], r"^(.+)_([xX])$")


def test_listing_and_bundle(spark, tmp_path):
    (tmp_path / "d").mkdir()
    for name in ("b.txt", "a.txt", "Thumbs.db", ".a.x1.staging"):
        (tmp_path / "d" / name).write_text("x")
    listed = files.source_files(files.list_files(spark, str(tmp_path / "d")), path="path").collect()
    assert [r.path.rsplit("/", 1)[1] for r in listed] == ["a.txt", "b.txt"]
    df = spark.createDataFrame([("s1", "v1", 1.0), ("s2", "v1", float("nan"))], "source string, lineage string, x double")
    archives.write_bundle({"small": df}, str(tmp_path / "out"), partition_by=["source", "lineage"])
    back = archives.load_frames(spark, str(tmp_path / "out" / "small"), df.schema)
    assert {(r.source, r.x) for r in back.collect()} == {("s1", 1.0), ("s2", None)}
    with pytest.raises(ValueError):
        archives.write_bundle({"small": df}, str(tmp_path / "no"), partition_by=["source"], problems=df)
    assert not (tmp_path / "no").exists()


def test_unreadable_manifest_is_empty(spark):
    df = spark.createDataFrame([(1, '{"source": {"source_name": "s"}}'), (2, '{"sou'), (3, None)], "take int, text string")
    out = files.manifests(df, keys=["take"], text="text", fields={"name": "$.source.source_name"}).orderBy("take").collect()
    assert [(r.readable, r.name) for r in out] == [(True, "s"), (False, None), (False, None)]


def test_escaped_checksum_names_round_trip(spark):
    names = ["plain", "back\\slash", "line\nbreak", "mixed\\n\r", "trailing\\"]
    df = spark.createDataFrame([(n,) for n in names], "n string").withColumn("d", F.sha2("n", 256))
    lines = df.withColumn("line", files.sums_line(F.col("d"), F.col("n")))
    for r in files.parse_sums(lines, line="line").collect():
        assert (r.valid, r.digest, r.name) == (True, r.d, r.n)


def test_json_leaves_against_a_walk(spark):
    import json

    from pyspark.sql import functions as F

    from motionframes.functions.text import json_leaves

    def walk(node, path=""):
        inner = node.items() if isinstance(node, dict) else enumerate(node) if isinstance(node, list) else None
        if inner is None:
            kind = {str: "string", bool: "bool", int: "int", float: "float"}.get(type(node), "null")
            yield (path, kind, node if kind == "string" else json.dumps(node))
        else:
            for key, child in inner:
                yield from walk(child, f"{path}.{key}" if path else str(key))

    deep = {"a": {"b": {"c": {"d": {"e": [[], {}, [{"f": "end"}]]}}}}}
    docs = [deep, {"x": [1, 2.5, True, None, "é \"q\"", ""], "y": {}, "z": -12345678901}, [], "text", 7, None, {"k.l": {"m n": [[["z"]]]}}, {"long": "w" * 100_000}]
    rows = [(i, json.dumps(d)) for i, d in enumerate(docs)] + [(90, None), (91, ""), (92, '{"a": 1'), (93, '{"a": 1, "a": 2}')]
    found = json_leaves(spark.createDataFrame(rows, "id int, doc string"), "id", document=F.col("doc"))
    assert "Python" not in found._jdf.queryExecution().toString()
    assert sorted(map(tuple, found.collect())) == sorted((i, *leaf) for i, d in enumerate(docs) for leaf in walk(d))
    assert json_leaves(spark.createDataFrame([], "id int, doc string"), "id", document=F.col("doc")).collect() == []
