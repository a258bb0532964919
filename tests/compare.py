"""Run registered queries on Spark and their SQL on DuckDB and compare whole results."""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

import duckdb  # noqa: E402

from motionframes.session import build_session  # noqa: E402

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def session():
    spark = build_session(
        "motionframes-tests",
        master="local[8]",
        **{"spark.sql.shuffle.partitions": "8", "spark.driver.memory": "8g", "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false"},
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def database(folder: str) -> duckdb.DuckDBPyConnection:
    db = duckdb.connect()
    for name in TABLES:
        db.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return db


def cell(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return "NULL"
    if isinstance(value, bool):
        return str(value)
    if isinstance(value, (int, float)) or hasattr(value, "as_tuple"):
        return repr(float(value))
    return str(value)


def rows_of(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return [names[i] for i in order], sorted(tuple(cell(r[i]) for i in order) for r in rows)


def compare(spark, db, folder, fn, sql):
    """(problem or None, rows, seconds)."""
    started = time.time()
    frame = fn(spark, folder)
    found = [tuple(r) for r in frame.collect()]
    seconds = time.time() - started
    if sql is None:
        return (None if found else "no rows"), len(found), seconds
    result = db.execute(sql)
    names = [d[0] for d in result.description]
    mine, theirs = rows_of(frame.columns, found), rows_of(names, result.fetchall())
    if mine[0] != theirs[0]:
        return f"columns {mine[0]} != {theirs[0]}", len(found), seconds
    if mine[1] == theirs[1]:
        return (None if found else "no rows"), len(found), seconds
    left, right = set(mine[1]) - set(theirs[1]), set(theirs[1]) - set(mine[1])
    sample = f"{len(found)} rows vs {len(theirs[1])}; spark only {len(left)}: {sorted(left)[:2]}; sql only {len(right)}: {sorted(right)[:2]}"
    return f"{mine[0]} {sample}", len(found), seconds


def main(argv: list[str]) -> int:
    import __spark_entry__ as entry

    folder = "/root/testdata/sf0.01"
    wanted = argv
    spark, db = session(), database(folder)
    oracle, failed = entry.oracle_sql(), 0
    for name, fn in entry.queries().items():
        if wanted and not any(name == w or (w.endswith("*") and name.startswith(w[:-1])) for w in wanted):
            continue
        try:
            problem, n, seconds = compare(spark, db, folder, fn, oracle.get(name))
        except Exception as error:  # noqa: BLE001
            problem, n, seconds = f"{type(error).__name__}: {str(error)[:1500]}", 0, 0.0
        failed += problem is not None
        kind = "sql" if name in oracle else "rows"
        print(f"{'FAIL' if problem else 'ok  '} {name:36s} {kind} {n:7d} rows {seconds:6.2f}s {problem or ''}", flush=True)
    print("failed:", failed)
    return failed


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
