"""Every catalogue query against its oracle on the smallest tables."""

from __future__ import annotations

from pathlib import Path

import pytest
from compare import connect, difference

import __spark_entry__ as entry
from tablesync.catalogue import audits, loads, scans

SF = "/root/testdata/sf0.001"
NAMES = [*scans.QUERIES, *loads.QUERIES, *audits.QUERIES]
pytestmark = pytest.mark.skipif(not Path(SF).is_dir(), reason="needs the test tables")


@pytest.fixture(scope="module")
def connection():
    return connect(SF)


def test_every_query_has_an_oracle():
    assert set(NAMES) <= entry.queries().keys()
    assert set(NAMES) <= entry.oracle_sql().keys() <= entry.queries().keys()


def test_entry(spark):
    frame = entry.entry(spark)
    assert frame.count() == 1500 and "o_orderkey" in frame.columns


@pytest.mark.parametrize("name", NAMES)
def test_query(spark, connection, name):
    frame = entry.queries()[name](spark, SF)
    assert difference(frame, connection, entry.oracle_sql()[name]) is None
