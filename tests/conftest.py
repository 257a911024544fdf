import os
import sys

import pytest

sys.path[:0] = [os.path.dirname(os.path.dirname(os.path.abspath(__file__)))]

from pyspark.sql import SparkSession  # noqa: E402

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[8]")
        .appName("realmwatch-tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "America/New_York")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.maxMetadataStringLength", "10000")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def log(spark):
    from realmwatch.sources import bridge

    return bridge.log_events(bridge.read_events(spark, SF_DIR))


@pytest.fixture(scope="session")
def success(log):
    from realmwatch.sources import bridge

    return bridge.success_events(log)


@pytest.fixture(scope="session")
def failure(log):
    from realmwatch.sources import bridge

    return bridge.failure_events(log)


def rows(df):
    """Rows as a sorted list of tuples, columns in name order."""
    names = sorted(df.columns)
    return sorted((tuple(r) for r in df.select(*names).collect()), key=repr)


@pytest.fixture(scope="session")
def same():
    def check(left, right):
        assert sorted(left.columns) == sorted(right.columns)
        assert rows(left) == rows(right)

    return check
