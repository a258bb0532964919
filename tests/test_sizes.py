"""Shuffles take as many tasks as their rows ask for, with the same rows."""

from pyspark.sql import functions as F

from motionframes.functions import text as X
from motionframes.operators import catalog, diff
from motionframes.operators.blocks import dealt, task_count
from motionframes.plans import quality


def test_tasks_follow_the_rows(spark):
    rows = spark.range(10_000).select((F.col("id") % 997).alias("k"))
    assert task_count(rows, rows=10_000) == 0 and dealt(rows, 0, "k") is rows
    assert task_count(rows, rows=100) == 100 and task_count(rows, per_row=3, rows=100) == 300
    spread = dealt(rows, 100, "k").withColumn("part", F.spark_partition_id()).groupBy("part").agg(F.count("*").alias("n"))
    sizes = [r.n for r in spread.collect()]
    assert len(sizes) > 50 and sum(sizes) == 10_000 and max(sizes) < 600


def test_structure_findings_are_the_same_however_dealt(spark, monkeypatch):
    index = spark.createDataFrame([(i, "ok" if i % 5 else "failed", ["c"] if i % 2 else []) for i in range(40)], "take int, status string, capabilities array<string>")
    stored = spark.range(3, 45).selectExpr("cast(id as int) as take")
    files = stored.selectExpr("take", "explode(array('a', 'b')) as file").where("file = 'a' or take % 3 = 0")
    found = lambda **more: sorted(map(tuple, quality.structure_findings(index, stored, files, {"a": None, "b": "c"}, take="take", **more).collect()), key=str)
    plain = found()
    monkeypatch.setattr(quality, "task_count", lambda df, **_: task_count(df, rows=4))
    assert found() == plain == found(sized_by=stored) and len(plain) > 10


def test_leaves_of_spread_documents_come_from_checkpointed_levels(spark, monkeypatch):
    docs = spark.createDataFrame([(i, f'{{"a": {{"b": [{i}, null]}}, "c": "x{i}"}}' if i % 7 else "{") for i in range(60)], "id long, doc string")
    plain = sorted(map(tuple, X.json_leaves(docs, "id", document=F.col("doc")).collect()))
    assert [r[1:] for r in plain if r[0] == 1] == [("a.b.0", "int", "1"), ("a.b.1", "null", "null"), ("c", "string", "x1")]
    monkeypatch.setattr(X, "DOCUMENTS", 10)
    spread = X.json_leaves(docs, "id", document=F.col("doc"))
    assert sorted(map(tuple, spread.collect())) == plain
    assert "parse_json" not in spread._jdf.queryExecution().optimizedPlan().toString()


def test_differing_subtrees_open_only_documents_that_differ(spark, monkeypatch):
    docs = [f'{{"a": {{"b": {{"c": {{"d": {i % 7}, "e": [1, {i}]}}}}, "f": "x"}}, "g": null}}' for i in range(40)]
    old = [(i if i else None, d) for i, d in enumerate(docs)] + [(3, '{"h": 1}'), (3, '{"h": 1}'), (41, '{"p": {"q": 1}}'), (42, "{")]
    new = [(i if i else None, d.replace('"d": 3', '"d": 4').replace('"f": "x"', '"f": "y"' if i % 5 == 1 else '"f":  "x"')) for i, d in enumerate(docs) if i != 9]
    new += [(3, '{"h": 1}'), (43, '{"g": []}'), (44, '{"g": [true]}')]
    a, b = (spark.createDataFrame(rows, "k int, doc string") for rows in (old, new))
    sides = [diff.subtree_digests(X.json_leaves(side, "k", document=F.col("doc")), keys=["k"], depth=3) for side in (a, b)]
    by_digest = diff.compare_snapshots(*sides, keys=["k", "subtree"], values=["digest"]).where("verdict <> 'same' and k is not null")
    opened = []
    monkeypatch.setattr(diff, "json_leaves", lambda df, *keep, document: opened.append(df.count()) or X.json_leaves(df, *keep, document=document))
    found = [tuple(r) for r in diff.differing_subtrees(a, b, keys=["k"], document="doc", depth=3).collect()]
    assert len(set(found)) == len(found) and set(found) == {(r.k, r.subtree) for r in by_digest.collect()}
    assert {(1, "a.f"), (3, "h"), (9, "a.b.c"), (10, "a.b.c"), (44, "g.0")} <= set(found) and (2, "a") not in found
    same = spark.createDataFrame(old, "k int, doc string")
    assert diff.differing_subtrees(a, same, keys=["k"], document="doc", depth=3).collect() == [] and opened[1] == 0


def test_a_journal_is_told_once_and_the_same_for_large_files(spark, monkeypatch):
    digest = lambda n: None if n % 11 == 5 else f"d{n}"
    lines, state = [], dict.fromkeys(range(8), 1)
    for file, n in ((file, n) for file in range(6) for n in range(1, 9 + 3 * file)):
        lines.append((file, 3 * n, digest(state[file]), digest(state[file] + 1) if (n + file) % 9 else "lost"))
        state[file] += (n + file) % 4 > 0
    records = spark.createDataFrame(lines, "file int, sequence long, before string, after string")
    digests = spark.createDataFrame([(f, "other" if f == 2 else digest(state[f])) for f in (0, 1, 2, 3, 5, 7)], "file int, digest string")
    told = lambda **more: sorted(map(str, catalog.journal_story(records, digests, file="file", rows=7, **more).collect()))
    assert told() == told(hot_rows=9) == told(hot_rows=0) and len(told()) == len(lines)
    stories = {story for story in ("applied", "unapplied", "unexplained") if any(f"'{story}'" in row for row in told())}
    assert stories == {"applied", "unapplied", "unexplained"}

    calls, tell = [], catalog.journal_story
    monkeypatch.setattr(catalog, "journal_story", lambda *given, **named: calls.append(1) or tell(*given, **named))
    changes = records.selectExpr("file", "sequence", "sequence % 2 as slot", "named_struct('v', sequence - 6) as old", "named_struct('v', sequence) as new")
    now = changes.groupBy("file", "slot").agg(F.max("new.v").alias("v"))
    for sequence in (0, 6, 9):
        calls.clear()
        options = {"file": "file", "sequence": sequence, "rows": 7}
        then = {(r.file, r.slot): r.v for r in catalog.as_of_story(now, changes, records, digests, key="slot", value=["v"], **options).collect()}
        assert len(calls) == 1
        bad = {r.file for r in catalog.as_of_problems(records, digests, **options).collect()}
        story = {(r.file, r.sequence): r.story for r in tell(records, digests, file="file", rows=7).collect()}
        wanted = {(r.file, r.slot): r.v for r in now.collect() if r.file not in bad}
        for (file, at), what in sorted(story.items(), reverse=True):
            if file not in bad and at > sequence and what == "applied":
                wanted[file, at % 2] = at - 6
        assert then == wanted


def test_entries_in_one_partition_are_checked_by_many_tasks(spark, monkeypatch):
    rows = [(i // 9, i, f'{{"id": "L{i % 4}", "kind": "data"}}' if i % 11 else "[") for i in range(90)]
    entries = spark.createDataFrame(rows, "file long, position long, entry string").coalesce(1)
    options = {"required": ["id", "kind"], "optional": [], "scope_lists": {}, "kinds": ["data"], "severities": [], "statuses": [], "levels": []}
    check = lambda: quality.entry_problems(entries, file="file", position="position", entry="entry", **options)
    plain = sorted(map(tuple, check().collect()))
    monkeypatch.setattr(quality, "ENTRIES", 10)
    many = check()
    assert sorted(map(tuple, many.collect())) == plain
    assert many.select(F.spark_partition_id().alias("p")).distinct().count() > 3
