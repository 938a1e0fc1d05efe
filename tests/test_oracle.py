"""Every registered query against its SQL, on the given tables."""

import glob
import os

import duckdb
import pytest

from __spark_entry__ import entry, oracle_sql, queries
from talmir.plans.registry import QUERIES
from tests.conftest import TESTDATA

FOLDER = os.path.join(TESTDATA, "sf0.01")


@pytest.fixture(scope="module")
def database():
    connection = duckdb.connect()
    for path in glob.glob(f"{FOLDER}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return connection


def _sorted(rows):
    return sorted(rows, key=lambda row: tuple((v is None, v) for v in row))


def assert_matches_sql(spark, database, name):
    result = queries()[name](spark, FOLDER)
    columns = sorted(result.columns)
    actual = [tuple(row) for row in result.select(*columns).collect()]
    assert actual
    relation = database.sql(oracle_sql()[name])
    assert sorted(relation.columns) == columns
    order = [relation.columns.index(c) for c in columns]
    expected = [tuple(row[i] for i in order) for row in relation.fetchall()]
    assert len(actual) == len(expected)
    for mine, theirs in zip(_sorted(actual), _sorted(expected)):
        assert mine == theirs


@pytest.mark.parametrize("name", sorted(n for n in oracle_sql() if n in QUERIES))
def test_query_matches_sql(spark, database, name):
    assert_matches_sql(spark, database, name)


def test_entry_has_rows(spark):
    assert entry(spark).columns == ["product", "max_norm"]
    assert entry(spark).count() == 10


def test_every_core_query_has_sql():
    assert not QUERIES.keys() - oracle_sql().keys()
    assert not oracle_sql().keys() - queries().keys()
