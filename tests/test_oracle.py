"""Every registered query against its DuckDB statement on the same tables."""

import duckdb
import pytest

import __spark_entry__ as driver
from fieldseason.plans import oracle
from fieldseason.plans import queries as registered

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages"
    " benchmark labels conversations"
).split()
TYPES = {
    "string": "VARCHAR", "double": "DOUBLE", "int": "INTEGER", "bigint": "BIGINT",
    "date": "DATE", "boolean": "BOOLEAN",
}
QUERIES, SQL = registered.registry(), oracle.texts()


@pytest.fixture(scope="module")
def duck(sf):
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"create view {name} as select * from '{sf}/{name}.parquet'")
    return connection


def test_every_query_has_a_statement():
    assert set(QUERIES) == set(SQL)
    assert set(QUERIES) <= set(driver.queries()) and set(driver.oracle_sql()) <= set(driver.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_statement(spark, duck, sf, name):
    df = QUERIES[name](spark, sf)
    result = duck.execute(SQL[name])
    expected_types = {d[0]: str(d[1]) for d in result.description}
    assert {f.name: TYPES[f.dataType.simpleString()] for f in df.schema} == expected_types
    columns, order = sorted(expected_types), [d[0] for d in result.description]
    expected = sorted(repr([row[order.index(c)] for c in columns]) for row in result.fetchall())
    actual = sorted(repr([row[c] for c in columns]) for row in df.collect())
    assert len(actual) > 0
    assert actual == expected


def test_entry_is_the_flagship_query(spark):
    df = driver.entry(spark)
    assert df.columns[:3] == ["stationId", "year", "window"]
    assert df.count() > 0
