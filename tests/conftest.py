from __future__ import annotations

import datetime as dt
import pathlib
import sys

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(pathlib.Path(__file__).resolve().parent.parent))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from tidemark.session import configure

    shared = str(tmp_path_factory.mktemp("shared"))
    session = (
        configure(SparkSession.builder.master("local[4]").appName("tests"), shared)
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.driver.memory", "4g")
        .config("spark.sql.warehouse.dir", str(tmp_path_factory.mktemp("warehouse")))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def frame(spark):
    """Rows with a DDL schema to a DataFrame."""

    def build(schema: str, *rows):
        return spark.createDataFrame(list(rows), schema)

    return build


def ts(text: str) -> dt.datetime:
    return dt.datetime.fromisoformat(text)


def rows(df, *order):
    return [tuple(r) for r in (df.orderBy(*order) if order else df).collect()]


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()
