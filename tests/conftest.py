import os
import sys

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[4]")
        .appName("tests")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "4g")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.warehouse.dir", str(tmp_path_factory.mktemp("warehouse")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def trades(spark):
    """Build trades from ``(symbol, seconds, price, volume)``; the list order is the arrival order."""

    def build(rows):
        data = [(s, float(p), float(v), round(t * 1000), i) for i, (s, t, p, v) in enumerate(rows)]
        return spark.createDataFrame(data, "s string, p double, v double, t bigint, seq bigint")

    return build
