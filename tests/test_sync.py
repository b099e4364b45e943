from __future__ import annotations

import json

import pytest
from frames import bag
from pyspark.sql import functions as F

from tablesync import (
    ColumnSpec,
    ManagedTable,
    PrefixSource,
    PublishConflict,
    RetryPolicy,
    SchemaError,
    SourceError,
    SourcePlan,
    SqlSource,
    SyncSpec,
    TableSource,
    evolve,
    plan,
    read_table,
    read_view,
    register_source,
    register_view,
    sync,
)
from tablesync.operators.runlog import latest_runs, mode_history, read_runs, status_counts
from tablesync.operators.views import View
from tablesync.session import engine_session


@pytest.fixture
def setup(spark, write, tmp_path):
    """Two dated slices and a spec maker."""
    write(tmp_path / "src/dt=2026-01-01", "OrderID int, EventDate string", (1, "2026-01-01"))
    write(tmp_path / "src/dt=2026-01-02", "OrderID int, EventDate string", (2, "2026-01-02"))

    def make(**changes):
        source = {"location": str(tmp_path / "src"), "incremental_paths": ["dt=2026-01-02"]}
        source |= changes.pop("source", {})
        values = {
            "target": "db.orders",
            "warehouse": str(tmp_path / "wh"),
            "source": PrefixSource(**source),
            "incremental_predicate": "\"EventDate\" = '2026-01-02'",
            "run_log": str(tmp_path / "log"),
        }
        return SyncSpec(**(values | changes))

    return make


@pytest.fixture
def log(spark, tmp_path):
    return lambda: read_runs(engine_session(spark), str(tmp_path / "log"))


def test_full_then_incremental(spark, setup, log):
    spec = setup()
    results = [sync(spark, spec) for _ in range(3)]
    assert [r.effective_mode for r in results] == ["full_refresh", "incremental", "incremental"]
    assert [r.rows_deleted for r in results] == [None, 1, 1]
    assert bag(read_view(spark, spec.table_location)) == [(1, "2026-01-01"), (2, "2026-01-02")]
    assert read_view(spark, spec.table_location).columns == ["order_id", "event_date"]
    runs = mode_history(log(), "db.orders").collect()
    assert [run["effective_mode"] for run in runs] == [
        "full_refresh", "incremental", "incremental",
    ]
    assert json.loads(runs[1]["predicate_json"]) == ["dt=2026-01-02"]
    (segment,) = json.loads(runs[1]["export_segments"])
    assert segment["path_suffix"] == "dt=2026-01-02" and segment["file_count"] == 1
    assert json.loads(runs[2]["publish_ids"]) == ["v3"]
    assert runs[0]["started_at"] <= runs[0]["finished_at"]
    assert len(log().columns) == 18


def test_caller_settings_cannot_loosen_a_run(spark, setup):
    """Non-ANSI casts and skipped corrupt files stay the caller's own business."""
    loose = spark.newSession()
    for key in ("spark.sql.files.ignoreCorruptFiles", "spark.sql.files.ignoreMissingFiles"):
        loose.conf.set(key, "true")
    loose.conf.set("spark.sql.ansi.enabled", "false")
    columns = (ColumnSpec("EventDate", "int"),)
    source = {"load_mode": "full_ingest", "incremental_paths": [""]}
    spec = setup(columns=columns, source=source, incremental_predicate=None)
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        sync(loose, spec)
    assert engine_session(loose).conf.get("spark.sql.files.ignoreCorruptFiles") == "false"


def test_caller_session_is_untouched(spark, setup):
    before = dict(spark.conf.getAll)
    sync(spark, setup())
    assert dict(spark.conf.getAll) == before


def test_reload_is_idempotent_and_source_stays(spark, setup, write, tmp_path):
    spec = setup()
    sync(spark, spec)
    write(
        tmp_path / "src/dt=2026-01-02", "OrderID int, EventDate string", (9, "2026-01-02"),
        mode="overwrite",
    )
    for _ in range(2):
        sync(spark, spec)
        assert bag(read_table(spark, spec.table_location)) == [
            (1, "2026-01-01"), (9, "2026-01-02"),
        ]


def test_view_missing_means_full_refresh(spark, setup):
    spec = setup()
    sync(spark, spec)
    View(ManagedTable(engine_session(spark), spec.table_location)).drop()
    assert sync(spark, spec).effective_mode == "full_refresh"
    assert sync(spark, spec).effective_mode == "incremental"
    assert sync(spark, setup(full_refresh=True)).effective_mode == "full_refresh"
    assert sync(spark, setup(strategy="full_refresh")).effective_mode == "full_refresh"


def test_rows_outside_the_predicate_accumulate(spark, setup):
    spec = setup(source={"incremental_paths": ["dt=2026-01-01"]})
    for _ in range(3):
        sync(spark, spec)
    assert [row[0] for row in bag(read_table(spark, spec.table_location))] == [1, 1, 1]


def test_additive_column(spark, setup, write, tmp_path):
    spec = setup()
    sync(spark, spec)
    write(
        tmp_path / "src/dt=2026-01-02", "OrderID int, EventDate string, Name string",
        (2, "2026-01-02", "bob"), mode="overwrite",
    )
    result = sync(spark, spec)
    assert result.cleanup["altered_internal_table_schema"]
    assert bag(read_table(spark, spec.table_location)) == [
        (1, "2026-01-01", None), (2, "2026-01-02", "bob"),
    ]
    assert read_view(spark, spec.table_location).columns[-1] == "name"


def test_schema_change_is_refused_and_nothing_changes(spark, setup, write, tmp_path, log):
    spec = setup()
    sync(spark, spec)
    write(
        tmp_path / "src/dt=2026-01-02", "OrderID string, EventDate string", ("2", "2026-01-02"),
        mode="overwrite",
    )
    with pytest.raises(SchemaError, match="incompatible type change"):
        sync(spark, spec)
    assert bag(read_table(spark, spec.table_location)) == [(1, "2026-01-01"), (2, "2026-01-02")]
    assert ManagedTable(engine_session(spark), spec.table_location).head().number == 1
    assert [run["status"] for run in mode_history(log(), "db.orders").collect()] == [
        "success", "failure",
    ]


def test_failed_write_leaves_the_old_version(spark, setup, tmp_path):
    import os

    columns = (ColumnSpec("OrderID", "int", nullable=False), ColumnSpec("EventDate", "string"))
    spec = setup(columns=columns)
    sync(spark, spec)
    engine_session(spark).sql("SELECT CAST(NULL AS int) AS OrderID, '2026-01-02' AS EventDate").write.mode(
        "overwrite"
    ).parquet(str(tmp_path / "src/dt=2026-01-02"))
    before = sorted(os.listdir(f"{spec.table_location}/data"))
    with pytest.raises(Exception, match="NULL in NOT NULL column OrderID"):
        sync(spark, spec)
    assert bag(read_table(spark, spec.table_location)) == [(1, "2026-01-01"), (2, "2026-01-02")]
    assert sorted(os.listdir(f"{spec.table_location}/data")) == before


def test_bad_predicate_fails_before_anything_is_published(spark, setup):
    sync(spark, setup())
    spec = setup(incremental_predicate='"missing" = 1')
    with pytest.raises(Exception, match="missing"):
        sync(spark, spec)
    assert read_table(spark, spec.table_location).count() == 2


@pytest.mark.parametrize("existed", [False, True])
def test_skipped_run_touches_only_the_log(spark, setup, log, existed):
    import os

    if existed:
        sync(spark, setup())
    missing = {
        "full_refresh_paths": ["dt=1999"], "incremental_paths": ["dt=1999"], "skip_missing": True,
    }
    spec = setup(source=missing)
    result = sync(spark, spec)
    assert result.status == "skipped" and result.version is None and result.view_columns == []
    assert os.path.exists(spec.table_location) == existed
    counts = status_counts(log()).first()
    assert (counts["runs"], counts["skipped"]) == (1 + existed, 1)
    with pytest.raises(SourceError):
        sync(spark, setup(source={**missing, "skip_missing": False}))


def test_partly_missing_slices_are_fine(spark, setup):
    spec = setup(source={"full_refresh_paths": ["dt=2026-01-01", "dt=1999"]})
    result = sync(spark, spec)
    assert [segment["file_count"] for segment in result.segments] == [1, 0]
    assert read_table(spark, spec.table_location).count() == 1


def test_first_run_that_fails_drops_its_table(spark, setup, log):
    import os

    columns = (ColumnSpec("OrderID", "int", expression="no_such_function(1)"),)
    spec = setup(columns=columns)
    with pytest.raises(Exception, match="no_such_function"):
        sync(spark, spec)
    assert not os.path.exists(spec.table_location)
    assert json.loads(log().first()["cleanup"])["dropped_created_internal_table"]
    kept = setup(columns=columns, drop_created_on_failure=False)
    with pytest.raises(Exception, match="no_such_function"):
        sync(spark, kept)
    assert os.path.exists(kept.table_location)


def test_existing_table_is_not_dropped(spark, setup):
    sync(spark, setup())
    columns = (
        ColumnSpec("OrderID", "int", expression="no_such_function(1)"),
        ColumnSpec("EventDate", "string"),
    )
    with pytest.raises(Exception, match="no_such_function"):
        sync(spark, setup(columns=columns))
    assert read_table(spark, setup().table_location).count() == 2


def test_error_is_redacted_in_the_log(spark, setup, log):
    secret = "s3://bucket/key token=abc123"
    spec = setup(incremental_predicate=f"no_such_function('{secret}')")
    sync(spark, spec)
    with pytest.raises(Exception, match="no_such_function"):
        sync(spark, spec)
    (message,) = [r["error_message"] for r in log().where("status = 'failure'").collect()]
    assert message.startswith("AnalysisException: ")
    assert "bucket" not in message and "abc123" not in message
    assert len(message) <= len("AnalysisException: ") + 500


def test_log_failure_is_best_effort(spark, setup, tmp_path):
    (tmp_path / "file").write_text("not a directory")
    bad = {"run_log": str(tmp_path / "file/log")}
    result = sync(spark, setup(**bad))
    assert result.status == "success" and result.run_log_error
    with pytest.raises(Exception, match="run log"):
        sync(spark, setup(**bad, run_log_fail_on_error=True))
    assert sync(spark, setup(run_log=None)).run_log_error is None


def test_log_failure_does_not_hide_the_error(spark, setup, tmp_path):
    (tmp_path / "file").write_text("not a directory")
    spec = setup(
        run_log=str(tmp_path / "file/log"), run_log_fail_on_error=True,
        source={"full_refresh_paths": ["dt=1999"]},
    )
    with pytest.raises(SourceError):
        sync(spark, spec)


# --- concurrent runs ----------------------------------------------------------------


class Racing:
    """A source whose load lets other runs publish first."""

    kind = "racing"
    full_refresh_slices = incremental_slices = ()

    def __init__(self, frame, location, races):
        self.frame, self.location, self.races = frame, location, races


def _plan_racing(context, source):
    def rows():
        if source.races:
            source.races -= 1
            table = ManagedTable(context.engine, source.location)
            head = table.head()
            part = table.write(source.frame, f"other-{source.races}")
            table.publish(head, head.schema, head.parts, "other", [part])
        return source.frame

    return SourcePlan(schema=source.frame.schema, rows=rows)


register_source(Racing, _plan_racing)


def test_conflict_is_retried_against_the_new_head(spark, rows, tmp_path):
    location = str(tmp_path / "t")
    frame = rows("id int", (1,))
    waits = []
    spec = SyncSpec("t", Racing(frame, location, 1), location=location, retry=RetryPolicy(3, 5, 60, 2, 0))
    result = sync(spark, spec, sleep=waits.append)
    assert result.retry["attempts"] == 2 and waits == [5]
    (error,) = result.retry["retryable_errors"]
    assert error["attempt"] == 1 and error["delay_seconds"] == 5
    assert bag(read_table(spark, location)) == [(1,)]
    assert result.version == 2


def test_a_conflict_copies_the_source_once(spark, write, tmp_path, monkeypatch):
    write(tmp_path / "src", "id int, day int", (1, 1), (2, 2))
    spec = SyncSpec(
        "t", PrefixSource(str(tmp_path / "src")), location=str(tmp_path / "t"),
        retry=RetryPolicy(4, 1, 1, 1, 0),
    )
    sync(spark, spec)
    writes, conflicts = [], [1, 1]
    write_part, publish = ManagedTable.write, ManagedTable.publish

    def counted(self, frame, directory):
        writes.append(directory)
        return write_part(self, frame, directory)

    def contested(self, parent, *rest):
        if conflicts:
            conflicts.pop()
            raise PublishConflict("taken")
        return publish(self, parent, *rest)

    monkeypatch.setattr(ManagedTable, "write", counted)
    monkeypatch.setattr(ManagedTable, "publish", contested)
    result = sync(spark, spec, sleep=lambda _: None)
    assert result.retry["attempts"] == 3 and writes == [result.run_id]
    assert bag(read_table(spark, spec.location)) == [(1, 1), (2, 2)]


def test_conflicts_run_out(spark, rows, tmp_path, monkeypatch):
    location = str(tmp_path / "t")
    frame, publish = rows("id int", (1,)), ManagedTable.publish
    count = iter(range(9))

    def contested(self, parent, schema, parts, run_id, added=()):
        part = self.write(frame, f"other-{next(count)}")
        publish(self, parent, schema, parent.parts, "other", [part])
        return publish(self, parent, schema, parts, run_id, added)

    monkeypatch.setattr(ManagedTable, "publish", contested)
    spec = SyncSpec(
        "t", Racing(frame, location, 0), location=location,
        retry=RetryPolicy(2, 1, 60, 2, 0), run_log=str(tmp_path / "log"),
    )
    with pytest.raises(PublishConflict):
        sync(spark, spec, sleep=lambda _: None)
    run = read_runs(engine_session(spark), str(tmp_path / "log")).first()
    retry = json.loads(run["retry"])
    assert retry["attempts"] == 2
    assert [e["delay_seconds"] for e in retry["retryable_errors"]] == [1, 0]
    # the other run's rows are live, so the table is not this run's to drop
    assert read_table(spark, location).count() == 2


def test_concurrent_runs_of_one_table(spark, write, tmp_path):
    """Four runs replace four slices at the same time; none is lost."""
    from concurrent.futures import ThreadPoolExecutor

    for day in range(4):
        write(tmp_path / f"src/d={day}", "day int, v string", (day, "old"), (day, "old"))
    specs = [
        SyncSpec(
            "t",
            PrefixSource(str(tmp_path / "src"), incremental_paths=[f"d={day}"]),
            location=str(tmp_path / "t"),
            incremental_predicate=f"day = {day}",
            retry=RetryPolicy(20, 0.1, 0.5, 1, 0.3),
        )
        for day in range(4)
    ]
    sync(spark, specs[0])
    for day in range(4):
        write(tmp_path / f"src/d={day}", "day int, v string", (day, "new"), mode="overwrite")
    with ThreadPoolExecutor(4) as pool:
        results = list(pool.map(lambda spec: sync(spark, spec), specs))
    assert sorted(result.version for result in results) == [2, 3, 4, 5]
    assert bag(read_table(spark, str(tmp_path / "t"))) == [(day, "new") for day in range(4)]


def test_retention(spark, setup):
    spec = setup(retention_days=0)
    results = [sync(spark, spec) for _ in range(3)]
    assert results[2].cleanup["expired"]["versions"] == 1
    table = ManagedTable(engine_session(spark), spec.table_location)
    assert table.version_numbers() == [3] and table.read().count() == 2
    kept = setup(target="db.kept", retention_days=None)
    for _ in range(2):
        assert "expired" not in sync(spark, kept).cleanup


def test_other_errors_are_not_retried(spark, setup):
    waits = []
    with pytest.raises(SourceError):
        sync(spark, setup(source={"full_refresh_paths": ["dt=1999"]}), sleep=waits.append)
    assert waits == []


# --- other sources ------------------------------------------------------------------


def test_table_source_with_declared_columns(spark, write, tmp_path):
    write(tmp_path / "d/orders", "OrderID int, AmountText string", (1, "12.4"), (2, "x"))
    columns = (
        ColumnSpec("OrderID", "int"),
        ColumnSpec(
            "AmountText", "string", alias="amount",
            expression='try_cast("AmountText" AS decimal(38,0))',
        ),
    )
    spec = SyncSpec(
        "t", TableSource(str(tmp_path / "d"), "orders"), location=str(tmp_path / "t"),
        columns=columns,
    )
    sync(spark, spec)
    assert [(k, None if v is None else int(v)) for k, v in bag(read_view(spark, spec.location))] == [
        (1, 12), (2, None),
    ]
    assert bag(read_table(spark, spec.location)) == [(1, "12.4"), (2, "x")]


def test_table_source_must_fit_declared_types(spark, write, tmp_path):
    write(tmp_path / "d/orders", "id string", ("1",))
    spec = SyncSpec(
        "t", TableSource(str(tmp_path / "d"), "orders"), location=str(tmp_path / "t"),
        columns=(ColumnSpec("id", "int"),),
    )
    with pytest.raises(SchemaError):
        sync(spark, spec)


def test_sql_source_incremental(spark, rows, tmp_path):
    rows("id int, day string", (1, "a"), (2, "b")).createOrReplaceTempView("days")
    spec = SyncSpec(
        "t",
        SqlSource(
            "SELECT * FROM days", str(tmp_path / "s"), incremental_predicates="day = 'b'",
            reuse=False,
        ),
        location=str(tmp_path / "t"),
        incremental_predicate="\"day\" = 'b'",
    )
    sync(spark, spec)
    rows("id int, day string", (7, "a"), (8, "b")).createOrReplaceTempView("days")
    result = sync(spark, spec)
    assert result.effective_mode == "incremental" and result.staging_reference
    assert bag(read_table(spark, spec.location)) == [(1, "a"), (8, "b")]


def test_unregistered_source(spark, tmp_path):
    class Unknown:
        full_refresh_slices = incremental_slices = ()

    with pytest.raises(SourceError, match="unsupported"):
        sync(spark, SyncSpec("t", Unknown(), location=str(tmp_path / "t")))


# --- views --------------------------------------------------------------------------


def test_view_in_sql(spark, setup):
    spec = setup()
    sync(spark, spec)
    register_view(spark, spec.table_location, "orders_view")
    assert spark.sql("SELECT max(order_id) FROM global_temp.orders_view").first()[0] == 2


def test_full_ingest(spark, setup, tmp_path):
    columns = (
        ColumnSpec("OrderID", "bigint"),
        ColumnSpec("day", "date", expression='CAST($1:"EventDate" AS DATE)'),
        ColumnSpec("absent", "string"),
    )
    spec = setup(
        columns=columns, source={"load_mode": "full_ingest", "incremental_paths": [""]},
        incremental_predicate=None,
    )
    result = sync(spark, spec)
    assert [c.expression for c in result.view_columns] == [None, None, None]
    table = read_table(spark, spec.table_location)
    assert [kind for _, kind in table.dtypes] == ["bigint", "date", "string"]
    assert [(row[0], str(row[1]), row[2]) for row in bag(table)] == [
        (1, "2026-01-01", None), (2, "2026-01-02", None),
    ]
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        bad = (ColumnSpec("EventDate", "int"),)
        other = setup(target="db.other", columns=bad, source={"load_mode": "full_ingest"})
        sync(spark, other)


def test_strict_load_refuses_zoned_timestamps(spark, setup, tmp_path):
    engine_session(spark).sql("SELECT TIMESTAMP'2026-01-01 00:00:00Z' AS at").write.parquet(
        str(tmp_path / "ts")
    )
    values = {"columns": (ColumnSpec("at", "timestamp_ntz"),), "incremental_predicate": None}
    strict = {"location": str(tmp_path / "ts"), "incremental_paths": [""]}
    with pytest.raises(SchemaError, match="full_ingest"):
        sync(spark, setup(**values, source=strict))
    spec = setup(**values, source={**strict, "load_mode": "full_ingest"})
    sync(spark, spec)
    assert str(read_table(spark, spec.table_location).first()[0]) == "2026-01-01 00:00:00"


# --- evolution of stored data ---------------------------------------------------------


@pytest.mark.parametrize(
    "old, new, select, wanted",
    [
        ("named_struct('a','x','b',1L)", "named_struct('a','y','b',2L,'c','n')",
         ("p.a", "p.b", "p.c"), [("x", 1, None), ("y", 2, "n")]),
        ("named_struct('a','x','b',1L)", "named_struct('b',2L,'a','y')",
         ("p.a", "p.b"), [("x", 1), ("y", 2)]),
        ("named_struct('n',1)", "named_struct('n',5000000000L)",
         ("p.n",), [(1,), (5000000000,)]),
        ("named_struct('a','x','old','o')", "named_struct('a','y')",
         ("p.a", "p.old"), [("x", "o"), ("y", None)]),
        ("named_struct('o',named_struct('a','x'))", "named_struct('o',named_struct('a','y','b','z'))",
         ("p.o.a", "p.o.b"), [("x", None), ("y", "z")]),
        ("array(named_struct('s','x'))", "array(named_struct('s','y','q',1L))",
         ("p[0].s", "p[0].q"), [("x", None), ("y", 1)]),
        ("named_struct('a',1,'b','x')", "named_struct('b','y','a',2L,'c','n')",
         ("p.a", "p.b", "p.c"), [(1, "x", None), (2, "y", "n")]),
        ("named_struct('ID','x')", "named_struct('id','y')", ("p.ID",), [("x",), ("y",)]),
        ("array(named_struct('ID','x'))", "array(named_struct('id','y'))",
         ("p[0].ID",), [("x",), ("y",)]),
    ],
)
def test_nested_evolution(spark, setup, tmp_path, old, new, select, wanted):
    engine = engine_session(spark)
    for day, value in (("1", old), ("2", new)):
        engine.sql(f"SELECT '{day}' AS day, {value} AS p").write.parquet(
            str(tmp_path / f"n/{day}")
        )
    spec = setup(
        source={
            "location": str(tmp_path / "n"), "full_refresh_paths": ["1"],
            "incremental_paths": ["2"],
        },
        incremental_predicate="\"day\" = '2'",
    )
    for _ in range(3):
        sync(spark, spec)
    table = read_table(spark, spec.table_location).orderBy("day")
    assert [tuple(row) for row in table.select(*(F.expr(s) for s in select)).collect()] == wanted


def test_evolve_without_loading(spark, setup):
    from pyspark.sql import types as T

    spec = setup()
    sync(spark, spec)
    wanted = T.StructType.fromDDL("OrderID int, EventDate string, Extra double")
    plan = evolve(spark, spec.table_location, wanted)
    assert plan.added_columns == ["Extra"]
    assert read_table(spark, spec.table_location).columns == ["OrderID", "EventDate", "Extra"]
    assert not evolve(spark, spec.table_location, wanted).altered
    required = T.StructType.fromDDL("OrderID int, EventDate string, Extra double, R int not null")
    with pytest.raises(SchemaError, match="nullable"):
        evolve(spark, spec.table_location, required)


def test_session_functions(spark, setup):
    doubled = F.udf(lambda value: value * 2, "int")
    given = {"doubled": doubled}
    columns = (
        ColumnSpec("OrderID", "int", expression='doubled("OrderID")'),
        ColumnSpec("EventDate", "string"),
    )
    spec = setup(columns=columns, incremental_predicate='doubled("OrderID") = 4')
    for _ in range(2):
        result = sync(spark, spec, functions=given)
    assert result.rows_deleted == 1
    view = read_view(spark, spec.table_location, given)
    assert [row[0] for row in bag(view)] == [2, 4]


def test_plan_touches_nothing(spark, setup, write, tmp_path):
    import os

    spec = setup()
    planned = plan(spark, spec)
    assert planned.effective_mode == "full_refresh" and planned.evolution is None
    assert [c.alias for c in planned.view_columns] == ["order_id", "event_date"]
    assert not os.path.exists(spec.table_location) and not os.path.exists(spec.run_log)
    sync(spark, spec)
    write(
        tmp_path / "src/dt=2026-01-02", "OrderID int, EventDate string, Name string",
        (2, "2026-01-02", "bob"), mode="overwrite",
    )
    planned = plan(spark, spec)
    assert planned.slices == ("dt=2026-01-02",) and planned.segments[0]["file_count"] == 1
    assert planned.evolution.added_columns == ["Name"]
    assert read_table(spark, spec.table_location).columns == ["OrderID", "EventDate"]
    missing = {"incremental_paths": ["dt=1999"], "skip_missing": True}
    assert plan(spark, setup(source=missing)).skip_reason


def test_latest_run_per_target(spark, setup, log):
    for target in ("db.a", "db.b", "db.a"):
        sync(spark, setup(target=target))
    latest = {row["target_view"]: row["effective_mode"] for row in latest_runs(log()).collect()}
    assert latest == {"db.a": "incremental", "db.b": "full_refresh"}
