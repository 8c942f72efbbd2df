"""Every registered query against its SQL on the smallest tables."""

import os

import duckdb
import pytest

from engagement_lake.suite.queries import ORACLES, QUERIES

FOLDER = "/root/testdata/sf0.001"
TABLES = ("region", "nation", "customer", "part", "events")

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="needs the generic tables")


@pytest.fixture(scope="module")
def database():
    connection = duckdb.connect()
    for table in TABLES:
        connection.sql(f"CREATE VIEW {table} AS SELECT * FROM '{FOLDER}/{table}.parquet'")
    return connection


def ordered(rows):
    return sorted((tuple(r) for r in rows), key=repr)


@pytest.mark.parametrize("name", QUERIES)
def test_query_equals_sql(spark, database, name):
    found = QUERIES[name](spark, FOLDER)
    columns = sorted(found.columns)
    expected = database.sql(f"SELECT {', '.join(columns)} FROM ({ORACLES[name]})")
    assert sorted(database.sql(ORACLES[name]).columns) == columns
    assert ordered(found.select(*columns).collect()) == ordered(expected.fetchall())


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)
