"""Every registered query against DuckDB on the smallest tables."""

import pytest
from compare import compare, database

import __spark_entry__ as entry

FOLDER = "/root/testdata/sf0.001"
ORACLE = entry.oracle_sql()


@pytest.fixture(scope="module")
def db():
    return database(FOLDER)


@pytest.mark.parametrize("name", sorted(entry.queries()))
def test_query(spark, db, name):
    problem, _, _ = compare(spark, db, FOLDER, entry.queries()[name], ORACLE.get(name))
    assert problem in (None, "no rows"), problem


def test_every_oracle_has_a_query():
    assert set(ORACLE) <= set(entry.queries())


def test_entry(spark):
    assert entry.entry(spark).count() > 0
