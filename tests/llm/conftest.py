import cases
import duckdb
import pytest

TABLES = "documents embeddings labels".split()


@pytest.fixture(scope="session")
def awkward(spark):
    """Documents with nulls, empty and long texts, repeated rows and clashing columns."""
    return spark.createDataFrame(cases.awkward_rows(), cases.SCHEMA)


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], cases.SCHEMA)


@pytest.fixture(scope="session")
def corpus(spark):
    return spark.read.parquet("/root/testdata/sf0.01/documents.parquet")


@pytest.fixture(scope="session")
def database(tables):
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{tables}/{name}.parquet'")
    return connection
