from __future__ import annotations

import sys
from datetime import date, datetime
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from userlake import RunContext, tables_from_raw
from userlake.sources.fixture import users_of_customers
from userlake.sources.records import RAW_COLUMNS, RAW_SCHEMA

DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[8]")
        .appName("tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.warehouse.dir", str(tmp_path_factory.mktemp("warehouse")))
        .config("spark.driver.memory", "4g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def ctx():
    return RunContext(as_of=date(2025, 1, 1), run_ts=datetime(2025, 1, 1), job_name="tests")


@pytest.fixture(scope="session")
def raw(spark):
    return users_of_customers(spark, DATA)


@pytest.fixture
def tables(raw, ctx):
    return tables_from_raw(raw, ctx)


@pytest.fixture(scope="session")
def users_like(spark):
    """Raw users of which only the given columns are set."""

    def make(*records: dict):
        rows = [tuple(record.get(column) for column in RAW_COLUMNS) for record in records]
        return spark.createDataFrame(rows, RAW_SCHEMA)

    return make
