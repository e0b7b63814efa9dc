import os
import sys

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[4]")
        .config("spark.driver.memory", "6g")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def one(spark):
    """Evaluate expressions over a single row given as keyword values."""

    def evaluate(column, schema="v string", *values):
        rows = [tuple(values)] if values else [(None,)]
        return spark.createDataFrame(rows, schema).select(column.alias("r")).first()["r"]

    return evaluate


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()
