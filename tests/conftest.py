import os
import sys

import pytest
from pyspark.sql import SparkSession

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path[:0] = [ROOT, os.path.join(ROOT, "tests")]

from millrace.session import prepare  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[8]")
        .appName("tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
        .config("spark.sql.warehouse.dir", str(tmp_path_factory.mktemp("warehouse")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield prepare(session)
    session.stop()


@pytest.fixture(scope="session")
def raw(spark):
    """Attempted sales: odd keys, odd amounts, odd times, and several faults at once."""
    rows = [
        ("a1", " t7 ", "12.50", "2031-03-04 09:15:00"),
        ("a2", "T7", " 7.25 ", "2031-03-04 23:59:59"),
        ("a3", "k2", "100", "2031-03-05 00:00:00"),
        ("a4", "Z9", "-3.10", "2031-03-05 12:00:00"),
        ("a5", "T7", "twelve", "2031-03-05 12:00:00"),
        ("a6", "K2", None, "2031-03-05 12:00:00"),
        ("a7", "K2", "5.00", "2031-02-30 12:00:00"),
        ("a8", "K2", "5.00", None),
        ("a9", "  ", "five", "never"),
        ("b1", None, "5.00", "2031-03-05 12:00:00"),
        ("b2", "T7", "1,000.00", "2031-03-05 12:00"),
    ]
    return spark.createDataFrame(
        rows, "sale_id STRING, product_id STRING, amount_raw STRING, sold_at_raw STRING"
    )


@pytest.fixture(scope="session")
def products(spark):
    rows = [(" t7", " Tools "), ("K2 ", "KITCHEN"), ("q1", "garden")]
    return spark.createDataFrame(rows, "product_id STRING, category STRING")
