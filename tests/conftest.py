import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

TEST_TABLES = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    builder = (
        SparkSession.builder.master("local[4]")
        .appName("bucketlens-tests")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
    )
    session = builder.getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def tables():
    return TEST_TABLES


@pytest.fixture(scope="session")
def prepared(spark, tables):
    """The sample requests, stored once."""
    from bucketlens.session import staged
    from registry.tables import prepared as derive

    return staged(derive(spark, tables), "test-prepared")


@pytest.fixture(scope="session")
def geo(spark, tables):
    from registry.tables import geo as derive

    return derive(spark, tables)
