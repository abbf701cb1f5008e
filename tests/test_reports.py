"""Every report must run, and must agree with its SQL twin where it has one."""

import glob
import os

import duckdb
import pytest

import __spark_entry__ as entry_module

FOLDER = "/root/testdata/sf0.001"
QUERIES = entry_module.queries()
SQL = entry_module.oracle_sql()


@pytest.fixture(scope="module")
def engine():
    connection = duckdb.connect()
    for path in glob.glob(f"{FOLDER}/*.parquet"):
        connection.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    return connection


def plain(value):
    if isinstance(value, (list, tuple)):
        return [plain(v) for v in value]
    return repr(value) if isinstance(value, float) else str(value)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_report(spark, engine, name):
    found = QUERIES[name](spark, FOLDER)
    columns = sorted(found.columns)
    rows = sorted([plain(v) for v in r] for r in found.select(*[f"`{c}`" for c in columns]).collect())
    if name not in SQL:
        assert rows
        return
    answer = engine.sql(SQL[name])
    assert sorted(answer.columns) == columns
    order = [answer.columns.index(c) for c in columns]
    assert rows == sorted([plain(r[i]) for i in order] for r in answer.fetchall())


def test_entry_is_the_filtered_search(spark):
    assert entry_module.entry(spark).columns == ["vec_id", "label", "vector_distance"]
