"""Every registered query against its SQL, on the smallest tables."""

import duckdb
import pytest

import __spark_entry__ as contract
import registry.oracles
import registry.queries

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()
QUERIES, SQL = registry.queries.QUERIES, registry.oracles.ORACLES


@pytest.fixture(scope="module")
def database(tables):
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{tables}/{name}.parquet'")
    return connection


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)
    assert set(QUERIES) <= set(contract.queries()) and set(SQL) <= set(contract.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, tables, database, name):
    found = QUERIES[name](spark, tables)
    result = database.execute(SQL[name])
    columns = [c[0] for c in result.description]
    assert sorted(found.columns) == sorted(columns)
    expected = sorted(result.fetchall(), key=repr)
    assert sorted((tuple(r) for r in found.select(*columns).collect()), key=repr) == expected
    assert expected


def test_entry(spark):
    assert contract.entry(spark).count() > 0
