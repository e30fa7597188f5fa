from __future__ import annotations

import os
import sys

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from deskstar.session import RUNTIME_CONF  # noqa: E402

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark():
    builder = SparkSession.builder.master("local[8]").appName("tests")
    settings = {
        **RUNTIME_CONF, "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false",
        "spark.sql.shuffle.partitions": "8", "spark.driver.memory": "8g",
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    session = builder.getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return SF_DIR


@pytest.fixture
def values(spark):
    """Evaluate a column expression over hand-written rows, in row order."""

    def run(rows, schema, column):
        df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], f"_i int, {schema}")
        return [r[0] for r in df.orderBy("_i").select(column.alias("v")).collect()]

    return run
