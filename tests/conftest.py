from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from pyspark.sql import SparkSession

    session = (
        SparkSession.builder.master("local[4]")
        .appName("tablesync-tests")
        .config("spark.sql.shuffle.partitions", "2")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("OFF")
    yield session
    session.stop()


@pytest.fixture
def rows(spark):
    """``rows(ddl, *tuples)``: a small frame."""
    return lambda ddl, *values: spark.createDataFrame(list(values), ddl)


@pytest.fixture
def write(rows):
    """``write(path, ddl, *tuples)``: a small Parquet directory, one file."""

    def go(path, ddl, *values, mode="errorifexists"):
        rows(ddl, *values).coalesce(1).write.mode(mode).parquet(str(path))
        return str(path)

    return go
