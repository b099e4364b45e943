from __future__ import annotations

import itertools

import time

import pytest

from tablesync import (
    ColumnSpec,
    PrefixSource,
    RangePartition,
    RetryPolicy,
    SpecError,
    SqlSource,
    SyncSpec,
    TableSource,
    TimePartition,
)
from tablesync.plans.modes import effective_mode, retry_delay, slices_for
from tablesync.plans.slices import (
    disjoint_layers,
    partition_condition,
    resolve_sql_predicates,
    resolve_table_predicates,
    suffix_containers,
)


def spec(**changes):
    values = {"target": "db.s.orders", "warehouse": "/w", "source": PrefixSource("/lake")}
    return SyncSpec(**(values | changes))


def test_defaults():
    s = spec()
    assert s.table_location == "/w/db/s/orders"
    assert s.source.full_refresh_slices == ("",) and s.source.infer_max_files is None
    assert s.retry == RetryPolicy(3, 5, 60, 2.0, 3)
    assert TableSource("/d", "t").compression == "ZSTD"
    assert SqlSource("select 1", "/s").staging_hours == 24


@pytest.mark.parametrize(
    "given, wanted",
    [
        (None, ("",)), ("", ("",)), ([], ("",)), ("/a/b/", ("a/b",)),
        ([" /a/ ", "b"], ("a", "b")), (["/"], ("",)),
    ],
)
def test_path_suffixes(given, wanted):
    assert PrefixSource("/lake", full_refresh_paths=given).full_refresh_paths == wanted


def test_text_predicate_is_one_item():
    source = TableSource("/d", "events_*", full_refresh_predicates="20260101")
    assert source.full_refresh_slices == ("20260101",)


@pytest.mark.parametrize(
    "make, message",
    [
        (lambda: PrefixSource("/l", full_refresh_paths=["s3://x"]), "relative"),
        (lambda: PrefixSource("/l", incremental_paths=["@stage/x"]), "relative"),
        (lambda: PrefixSource("/l", incremental_paths=[None]), "null"),
        (lambda: PrefixSource("/l", file_pattern=""), "file_pattern"),
        (lambda: PrefixSource("/l", infer_max_files=0), "infer_max_files"),
        (lambda: PrefixSource("/l", load_mode="append"), "load_mode"),
        (lambda: PrefixSource(""), "location"),
        (lambda: TableSource("/d", "t", predicate_type="where"), "predicate_type"),
        (lambda: TableSource("/d", "t", compression="LZO"), "compression"),
        (lambda: TableSource("/d", ""), "table"),
        (lambda: SqlSource(" ", "/s"), "sql is required"),
        (lambda: SqlSource("select 1", ""), "staging_location"),
        (lambda: SqlSource("select 1", "/s", predicate_type="table_suffix"), "predicate_type"),
        (lambda: spec(strategy="append"), "strategy"),
        (lambda: spec(incremental_strategy="merge"), "incremental_strategy"),
        (lambda: spec(target=""), "target"),
        (lambda: spec(warehouse=None), "location or warehouse"),
        (lambda: spec(partition_by=("a",)), "partition_by"),
        (lambda: spec(cluster_by=("a",)), "cluster_by"),
        (lambda: spec(retention_days=-1), "retention_days"),
        (lambda: spec(incremental_predicate="a = 1"), "both"),
        (lambda: spec(source=PrefixSource("/l", incremental_paths=["a"])), "both"),
        (lambda: spec(source=TableSource("/d", "t_*", incremental_predicates=["1"])), "both"),
        (lambda: spec(columns=[ColumnSpec("a", "int"), ColumnSpec("a", "int")]), "duplicate"),
        (lambda: ColumnSpec(" ", "int"), "name"),
        (lambda: ColumnSpec("a", ""), "type"),
        (lambda: ColumnSpec("a", "int", alias=" "), "alias"),
        (lambda: ColumnSpec("a", "int", expression=""), "expression"),
        (lambda: ColumnSpec("a", "int", nullable="yes"), "nullable"),
        (lambda: RetryPolicy(max_attempts=0), "max_attempts"),
        (lambda: RetryPolicy(backoff_multiplier=0.5), "backoff"),
        (lambda: RetryPolicy(jitter_seconds=-1), "jitter"),
    ],
)
def test_rejected(make, message):
    with pytest.raises(SpecError, match=message):
        make()


def test_from_dict():
    s = SyncSpec.from_dict(
        {
            "target": "t",
            "location": "/w/t",
            "source": {
                "kind": "table",
                "dataset": "/d",
                "table": "orders",
                "partition": {"column": "k", "start": 0, "end": 100, "interval": 10},
                "incremental_predicates": "20",
            },
            "incremental_predicate": "k >= 20 and k < 30",
            "columns": [{"name": "k", "type": "bigint"}],
            "retry": {"max_attempts": 5},
        }
    )
    assert s.source.partition == RangePartition("k", 0, 100, 10)
    assert s.retry.max_attempts == 5 and s.columns[0].name == "k"
    timed = {"kind": "table", "dataset": "/d", "table": "t", "partition": {"column": "ts"}}
    assert SyncSpec.from_dict(
        {"target": "t", "location": "/w", "source": timed}
    ).source.partition == TimePartition("ts")


@pytest.mark.parametrize(
    "payload, message",
    [
        ({"source": {"kind": "csv"}}, "kind"),
        ({"source": {"kind": "prefix", "location": "/l", "password": "x"}}, "unknown"),
        ({"source": {"kind": "prefix"}}, "location"),
        ({"colour": 1}, "unknown"),
        ({"columns": []}, "empty"),
        ({"columns": [{"name": "a"}]}, "type"),
    ],
)
def test_from_dict_rejects(payload, message):
    base = {"target": "t", "location": "/w", "source": {"kind": "prefix", "location": "/l"}}
    with pytest.raises(SpecError, match=message):
        SyncSpec.from_dict(base | payload)


# --- modes ----------------------------------------------------------------------


@pytest.mark.parametrize(
    "strategy, flag, table, view",
    list(itertools.product(("incremental", "full_refresh"), *[(False, True)] * 3)),
)
def test_effective_mode(strategy, flag, table, view):
    only = (strategy, flag, table, view) == ("incremental", False, True, True)
    assert effective_mode(strategy, flag, table, view) == (
        "incremental" if only else "full_refresh"
    )


def test_slices_follow_the_mode():
    source = PrefixSource("/l", full_refresh_paths=["a", "b"], incremental_paths=["b"])
    assert slices_for(source, "full_refresh") == ("a", "b")
    assert slices_for(source, "incremental") == ("b",)


def test_retry_delay():
    policy = RetryPolicy(5, 5, 60, 2.0, 3)
    assert [retry_delay(policy, n, 0) for n in (1, 2, 3, 4, 5)] == [5, 10, 20, 40, 60]
    assert retry_delay(policy, 1, 2.5) == 7.5
    assert retry_delay(policy, 5, 3) == 60


# --- predicate types: shape x type x predicates -----------------------------------

SHAPES = {
    "plain": ("orders", False),
    "time": ("orders_by_date", True),
    "range": ("orders_by_bucket", True),
    "wildcard": ("events_*", False),
}
LEGAL = {
    ("plain", "auto", False): "none",
    ("plain", "none", False): "none",
    ("time", "auto", False): "none",
    ("time", "auto", True): "partition_decorator",
    ("time", "none", False): "none",
    ("time", "partition_decorator", True): "partition_decorator",
    ("range", "auto", False): "none",
    ("range", "auto", True): "partition_decorator",
    ("range", "none", False): "none",
    ("range", "partition_decorator", True): "partition_decorator",
    ("wildcard", "auto", False): "none",
    ("wildcard", "auto", True): "table_suffix",
    ("wildcard", "none", False): "none",
    ("wildcard", "table_suffix", True): "table_suffix",
}


@pytest.mark.parametrize(
    "shape, kind, given",
    list(
        itertools.product(
            SHAPES, ("auto", "none", "partition_decorator", "table_suffix", "where"), (False, True)
        )
    ),
)
def test_table_predicates(shape, kind, given):
    table, partitioned = SHAPES[shape]
    predicates = ("20260101",) if given else ()
    wanted = LEGAL.get((shape, kind, given))
    if wanted:
        assert resolve_table_predicates(kind, table, predicates, lambda: partitioned) == wanted
    else:
        with pytest.raises(SpecError):
            resolve_table_predicates(kind, table, predicates, lambda: partitioned)


@pytest.mark.parametrize(
    "kind, given, wanted",
    [
        ("auto", False, "none"), ("auto", True, "where"), ("none", False, "none"),
        ("none", True, None), ("where", False, None), ("where", True, "where"),
        ("table_suffix", False, None), ("table_suffix", True, None),
        ("partition_decorator", False, None), ("partition_decorator", True, None),
    ],
)
def test_sql_predicates(kind, given, wanted):
    predicates = ("event_date = DATE '2026-01-01'",) if given else ()
    if wanted:
        assert resolve_sql_predicates(kind, predicates) == wanted
    else:
        with pytest.raises(SpecError):
            resolve_sql_predicates(kind, predicates)


@pytest.mark.parametrize("table", ["a_*_*", "*_x_*"])
def test_one_wildcard_only(table):
    with pytest.raises(SpecError):
        resolve_table_predicates("auto", table, ("1",), lambda: False)


# --- partition ids ----------------------------------------------------------------


@pytest.mark.parametrize(
    "name, low, high",
    [
        ("2024", "2024-01-01 00:00:00", "2025-01-01 00:00:00"),
        ("202412", "2024-12-01 00:00:00", "2025-01-01 00:00:00"),
        ("20240229", "2024-02-29 00:00:00", "2024-03-01 00:00:00"),
        ("2024022923", "2024-02-29 23:00:00", "2024-03-01 00:00:00"),
    ],
)
def test_time_bounds(name, low, high):
    assert TimePartition("ts").span(name) == (low, high)


@pytest.mark.parametrize("name", ["20240230", "2024-01", "24", "abcd", "202413"])
def test_time_id_rejected(name):
    with pytest.raises(SpecError):
        TimePartition("ts").span(name)


@pytest.mark.parametrize("name", ["x", "5", "100", "-10"])
def test_range_id_rejected(name):
    with pytest.raises(SpecError):
        RangePartition("k", 0, 100, 10).span(name)


def test_adjacent_ranges_merge(spark):
    days = [f"202401{day:02d}" for day in (3, 1, 2, 9)]
    text = str(partition_condition(TimePartition("ts"), [*days, "__NULL__"])._jc)
    assert text.count(">=") == 2 and "2024-01-04" in text and "2024-01-02" not in text
    with pytest.raises(SpecError):
        partition_condition(TimePartition("ts"), ["__UNPARTITIONED__"])


def test_layers():
    assert disjoint_layers(["a", "b"], suffix_containers) == [["a", "b"]]
    assert disjoint_layers(["a", "a/b", "a"], suffix_containers) == [["a"], ["a"], ["a/b"]]
    assert disjoint_layers(["m=1", "m=12"], suffix_containers) == [["m=1", "m=12"]]
    assert disjoint_layers(["", "a"], suffix_containers) == [[""], ["a"]]
    days = ["202601", "20260105", "2025", "20260105", "__NULL__"]
    assert disjoint_layers(days, TimePartition("ts").containers) == [
        ["202601", "2025", "__NULL__"], ["20260105"], ["20260105"],
    ]


def test_layers_are_linear():
    started = time.time()
    names = [f"events_{number}" for number in range(100_000)]
    assert disjoint_layers([*names, "events_7"]) == [names, ["events_7"]]
    assert time.time() - started < 2
