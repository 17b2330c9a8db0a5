"""Every registered query against its SQL twin on the smallest tables."""

import os

import duckdb
import pytest

import __spark_entry__ as entry_points
from tallyweave.registry import ORACLE_SQL, QUERIES

FOLDER = "/root/testdata/sf0.001"
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()
TYPES = {"boolean": "BOOLEAN", "bigint": "BIGINT", "string": "VARCHAR", "double": "DOUBLE", "int": "INTEGER", "timestamp_ntz": "TIMESTAMP"}

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="test tables are not here")


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{FOLDER}/{table}.parquet'")
    return connection


def _sorted(rows):
    return sorted(rows, key=lambda row: tuple(map(repr, row)))


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_equals_sql(spark, duck, name):
    result = entry_points.queries()[name](spark, FOLDER)
    columns = sorted(result.columns)
    got = [tuple(row) for row in result.select(columns).collect()]
    cursor = duck.execute(entry_points.oracle_sql()[name])
    names = [column[0] for column in cursor.description]
    kinds = dict(zip(names, (str(column[1]) for column in cursor.description)))
    assert sorted(names) == columns
    assert {c: TYPES[kind] for c, kind in result.dtypes} == kinds
    places = [names.index(column) for column in columns]
    expected = [tuple(row[place] for place in places) for row in cursor.fetchall()]
    assert _sorted(got) == _sorted(expected)


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLE_SQL)))
def test_query_without_sql_runs(spark, name):
    assert entry_points.queries()[name](spark, FOLDER).count() > 0


def test_entry(spark):
    result = entry_points.entry(spark)
    assert result.columns == ["u1", "u2", "sim"]
    assert result.count() > 0
