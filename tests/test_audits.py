from __future__ import annotations

import os
from datetime import UTC, date, datetime, timedelta

import pytest
from frames import bag
from pyspark.sql import functions as F

from tablesync import SpecError
from tablesync.functions import json_field
from tablesync.operators.catalog import CatalogView
from tablesync.operators.reconcile import differing_slices
from tablesync.operators.runlog import (
    RUN_LOG_SCHEMA, append_run, latest_run, merge_days, read_runs,
)
from tablesync.operators.store import ManagedTable
from tablesync.session import engine_session


@pytest.fixture(scope="module")
def engine(spark):
    return engine_session(spark)


# --- reconciliation -------------------------------------------------------------------

DDL = "k int, a int, b int, s struct<x:int,y:int>, m map<string,int>, l array<double>"


def row(k, a=1, b=None, s=(1, None), m=None, values=(1.0,)):
    return (k, a, b, s, m or {"p": 1}, list(values))


@pytest.mark.parametrize(
    "changed, wanted",
    [
        ([], []),
        ([row(1, a=None, b=1)], [(1, 1, 1)]),  # a NULL in another column
        ([row(1, s=(None, 1))], [(1, 1, 1)]),  # a NULL in another nested field
        ([row(1, m={"p": 2})], [(1, 1, 1)]),
        ([row(1, values=(1.0, 1.0))], [(1, 1, 1)]),
        ([row(1), row(1)], [(1, 1, 2)]),
        ([row(1), row(1), row(1)], [(1, 1, 3)]),  # an even number of copies more
    ],
)
def test_differing_slices(rows, changed, wanted):
    left = rows(DDL, row(1), row(2), row(2), row(None))
    right = rows(DDL, *(changed or [row(1)]), row(2), row(2), row(None))
    assert bag(differing_slices(left, right, F.col("k"))) == wanted
    assert bag(differing_slices(right, left, F.col("k"))) == [(k, m, n) for k, n, m in wanted]


def test_slices_of_one_side(rows):
    left, right = rows("k int, v int", (1, 1), (None, 2)), rows("k int, v bigint", (2, 1))
    assert bag(differing_slices(left, right, F.col("k"))) == [(1, 1, 0), (2, 0, 1), (None, 1, 0)]
    empty = rows("k int, v int")
    assert bag(differing_slices(empty, empty, F.col("k"))) == []
    # The order of the rows does not matter, columns that are not compared neither.
    one, other = rows("k int, v int", (1, 1), (1, 2)), rows("v int, k int, z int", (2, 1, 9), (1, 1, 8))
    assert bag(differing_slices(one, other, F.col("k"))) == []


# --- JSON -----------------------------------------------------------------------------


def test_json_fields(rows):
    texts = rows("t string", ('{"a": {"b": [1, "x"]}}',), ('{"a": ',), (None,), ("[]",), ("",), ('{"a": 1}',))
    got = texts.select(
        json_field(F.col("t"), "$.a.b[0]", "bigint").alias("n"),
        json_field(F.col("t"), "$.a.b[1]", "string").alias("s"),
        json_field(F.col("t"), "$.a.b[1]", "int").alias("bad"),
    ).collect()
    assert [tuple(r) for r in got] == [(1, "x", None), *[(None, None, None)] * 5]


# --- run log --------------------------------------------------------------------------


def _log(engine, location, run_id, day, target="t"):
    values = dict.fromkeys(RUN_LOG_SCHEMA.names) | {
        "run_id": run_id, "target_view": target, "status": "success",
        "finished_at": datetime(day.year, day.month, day.day, 23, 59, tzinfo=UTC),
    }
    append_run(engine, location, values)


def test_days_are_pruned_and_merged(engine, tmp_path):
    location, first = str(tmp_path / "log"), date(2026, 3, 1)
    assert read_runs(engine, location).count() == 0 and merge_days(engine, location) == 0
    for offset in range(4):
        for run in range(3):
            _log(engine, location, f"{offset}-{run}", first + timedelta(days=offset), f"t{run}")
    week = read_runs(engine, location, first + timedelta(days=1), first + timedelta(days=2))
    assert sorted(r.run_id for r in week.collect()) == [f"{d}-{r}" for d in (1, 2) for r in range(3)]
    assert {path.split("day=")[1][:10] for path in week.inputFiles()} == {"2026-03-02", "2026-03-03"}
    assert merge_days(engine, location, first + timedelta(days=3)) == 3
    days = sorted(os.listdir(location))
    assert [len(os.listdir(f"{location}/{day}")) for day in days] == [1, 1, 1, 3]
    assert read_runs(engine, location).count() == 12
    assert merge_days(engine, location, first + timedelta(days=3)) == 0
    # A merge that was cut short after its rename: both copies are there, each run counts once.
    _log(engine, location, "0-0", first, "t0")
    assert read_runs(engine, location).count() == 12
    assert merge_days(engine, location, first + timedelta(days=3)) == 1
    assert read_runs(engine, location, until=first).count() == 3
    assert latest_run(engine, location, "t1").first()["run_id"] == "3-1"
    assert latest_run(engine, location, "none").count() == 0


# --- catalog view ---------------------------------------------------------------------


def test_catalog_partitions_that_no_record_names_go(spark, engine, tmp_path):
    from tablesync import PrefixSource, SyncSpec, sync

    for name, rows in (("one", "SELECT 1 AS id, 'a' AS v"), ("two", "SELECT 2 AS id, 'b' AS v")):
        engine.sql(rows).write.parquet(str(tmp_path / f"lake/{name}"))
    try:
        for path in ("one", "two", "one"):
            source = PrefixSource(str(tmp_path / "lake"), full_refresh_paths=(path,))
            spec = SyncSpec(
                "db.seen", source, location=str(tmp_path / "t"), strategy="full_refresh",
                catalog_schema="catalog_test",
            )
            result = sync(spark, spec)
            assert result.catalog_view == "catalog_test.seen"
            found = spark.newSession().table("catalog_test.seen").collect()
            assert [tuple(r) for r in found] == [(1, "a") if path == "one" else (2, "b")]
        table = ManagedTable(engine, str(tmp_path / "t"))
        view = CatalogView(table, "catalog_test", "db.seen")
        assert view.forget() == 0  # earlier records still name them
        assert table.expire(retention_days=0)["slices"] == 2
        assert view.forget() == 2
        assert spark.newSession().table("catalog_test.seen").count() == 1
    finally:
        spark.sql("DROP SCHEMA IF EXISTS catalog_test CASCADE")


def test_a_catalog_view_of_an_empty_table(spark, engine, tmp_path):
    table = ManagedTable(engine, str(tmp_path / "t"))
    table.create(engine.sql("SELECT 1 AS `a b`, named_struct('x y', 1) AS s").schema, "run")
    from tablesync.operators.views import view_columns

    try:
        CatalogView(table, "catalog_empty", "empty").create_or_replace(view_columns(table.head().schema))
        found = spark.newSession().table("catalog_empty.empty")
        assert found.columns == ["a_b", "s"] and found.count() == 0
    finally:
        spark.sql("DROP SCHEMA IF EXISTS catalog_empty CASCADE")


def test_unknown_options_are_refused():
    from tablesync import SyncSpec

    with pytest.raises(SpecError, match="unknown"):
        SyncSpec.from_dict({"target": "t", "source": None, "location": "/x", "sliced_by": "a"})
