import os
import sys

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session


@pytest.fixture(scope="session")
def sf():
    return "/root/testdata/sf0.001"


@pytest.fixture
def evaluate(spark):
    """Value of an expression text over one row given as SQL literals."""
    def run(text: str, **row: str):
        source = spark.range(1).selectExpr(*[f"{v} as {k}" for k, v in row.items()] or ["id"])
        return source.selectExpr(f"{text} as result").first()["result"]

    return run


@pytest.fixture
def obs(spark):
    """Observations from (station, date, element, value[, attributes]) tuples."""
    from fieldseason.schemas import OBSERVATIONS

    def make(*rows):
        return spark.createDataFrame([(*r, None)[:5] for r in rows], OBSERVATIONS)

    return make
