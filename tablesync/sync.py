"""One sync run, from the spec to the run-log row."""

from __future__ import annotations

import random
import time
import uuid
from collections.abc import Callable, Mapping
from concurrent.futures import ThreadPoolExecutor
from contextlib import ExitStack
from dataclasses import dataclass, field
from datetime import UTC, datetime
from typing import Any

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from .errors import PublishConflict, SchemaError, TableSyncError
from .operators.catalog import CatalogView
from .operators.load import enforce_not_null, project_by_name
from .operators.runlog import append_run
from .operators.slicing import by_value, check_names
from .operators.store import Deletion, ManagedTable, Version, Written
from .operators.views import View, ViewColumn, view_columns
from .plans.evolution import EvolutionPlan, plan_evolution
from .plans.modes import FULL_REFRESH, effective_mode, retry_delay, slices_for
from .plans.types import map_declared_columns, view_aliases
from .session import engine_session
from .sources import prefix, sqltext, tables  # noqa: F401  (register the built-in sources)
from .sources.base import SourceContext, SourcePlan, plan_source
from .spec import SyncSpec


@dataclass
class SyncResult:
    """What a run did; the same facts as its run-log row."""

    run_id: str
    target: str
    location: str
    status: str = "running"
    effective_mode: str = "unknown"
    error_message: str | None = None
    slices: tuple[str, ...] = ()
    view_columns: list[ViewColumn] = field(default_factory=list)
    catalog_view: str | None = None
    segments: list[dict[str, Any]] = field(default_factory=list)
    job_references: list[dict[str, Any]] = field(default_factory=list)
    staging_reference: str | None = None
    publish_ids: list[str] = field(default_factory=list)
    version: int | None = None
    rows_deleted: int | None = None
    slices_dropped: int = 0
    slices_rewritten: int = 0
    retry: dict[str, Any] = field(default_factory=dict)
    cleanup: dict[str, Any] = field(default_factory=dict)
    run_log_error: str | None = None


def sync(
    spark: SparkSession,
    spec: SyncSpec,
    *,
    functions: Mapping[str, Any] | None = None,
    sleep: Callable[[float], None] = time.sleep,
) -> SyncResult:
    """Bring the managed table in step with its source.

    Plans the slices to read, evolves the schema, replaces the whole table or the
    rows of the delete predicate in one published version, and refreshes the view.
    Every run ends in the run log, failed and skipped ones too; a failure leaves
    the version before it live and is raised.

    ``functions`` are session functions (names and UDFs) that the delete predicate or
    column expressions call. Loaded rows are not checked against the delete predicate: slices that bring
    rows outside it add duplicates run after run.
    """
    engine = engine_session(spark, functions)
    table = ManagedTable(engine, spec.table_location)
    view = View(table)
    result = SyncResult(
        uuid.uuid4().hex,
        spec.target,
        spec.table_location,
        retry={
            "max_attempts": spec.retry.max_attempts,
            "attempts": 0,
            "retryable_errors": [],
        },
        cleanup={
            "created_internal_table": False,
            "altered_internal_table_schema": False,
            "dropped_created_internal_table": False,
            "schema_evolution_warnings": [],
        },
    )
    started = datetime.now(UTC)
    view_existed, source = True, ExitStack()
    try:
        view_existed = view.exists()
        result.effective_mode = effective_mode(
            spec.strategy, spec.full_refresh, table.exists(), view_existed
        )
        result.slices = slices_for(spec.source, result.effective_mode)
        plan = plan_source(_context(spark, engine, spec, result), spec.source)
        source.callback(plan.close)
        result.segments = plan.segments
        result.job_references = plan.job_references
        result.staging_reference = plan.staging_reference
        if plan.skip_reason:
            result.status, result.error_message = "skipped", plan.skip_reason
        else:
            with table.lease(result.run_id):
                _load(table, spec, plan, result, sleep)
            result.view_columns = view_columns(plan.schema, plan.expressions_at_load)
            view.create_or_replace(result.view_columns, plan.schema)
            if spec.catalog_schema:
                catalog = CatalogView(table, spec.catalog_schema, spec.target)
                result.catalog_view = catalog.create_or_replace(result.view_columns)
            result.status = "success"
            _expire(table, spec, result)
    except Exception as error:
        source.close()
        result.status, result.error_message = "failure", str(error)
        _clean_up(table, spec, result, view_existed)
        try:
            _log(engine, spec, result, started, type(error).__name__)
        except Exception as log_error:  # the run's own error is the one to raise
            result.run_log_error = type(log_error).__name__
        raise
    source.close()
    _log(engine, spec, result, started)
    return result


@dataclass
class SyncPlan:
    """What a run would do now: its mode and slices, and how the schema would change."""

    effective_mode: str
    slices: tuple[str, ...]
    segments: list[dict[str, Any]]
    skip_reason: str | None = None
    schema: T.StructType | None = None
    evolution: EvolutionPlan | None = None
    view_columns: list[ViewColumn] = field(default_factory=list)


def plan(
    spark: SparkSession, spec: SyncSpec, *, functions: Mapping[str, Any] | None = None
) -> SyncPlan:
    """Plan a run and check its schema without touching the table, view or run log.

    A SQL source stages its result (and a table source with an export location
    exports) while planning, just as the run would.
    """
    engine = engine_session(spark, functions)
    table = ManagedTable(engine, spec.table_location)
    result = SyncResult(uuid.uuid4().hex, spec.target, spec.table_location)
    exists = table.exists()
    result.effective_mode = effective_mode(
        spec.strategy, spec.full_refresh, exists, View(table).exists()
    )
    source = plan_source(_context(spark, engine, spec, result), spec.source)
    source.close()
    planned = SyncPlan(
        result.effective_mode,
        slices_for(spec.source, result.effective_mode),
        source.segments,
        source.skip_reason,
    )
    if source.schema is not None:
        planned.schema = source.schema
        planned.view_columns = view_columns(source.schema, source.expressions_at_load)
        if exists:
            planned.evolution = plan_evolution(table.head().schema, source.schema)
    return planned


def evolve(spark: SparkSession, location: str, wanted: T.StructType) -> EvolutionPlan:
    """Evolve a table's schema without loading anything."""
    table = ManagedTable(engine_session(spark), location)
    head = table.head()
    plan = plan_evolution(head.schema, wanted)
    _check_appended(plan, head.schema)
    if plan.altered:
        table.publish(head, plan.schema, head.parts, uuid.uuid4().hex)
    return plan


def _context(
    spark: SparkSession, engine: SparkSession, spec: SyncSpec, result: SyncResult
) -> SourceContext:
    declared = map_declared_columns(spec.columns) if spec.columns else None
    return SourceContext(
        spark, engine, result.effective_mode, result.run_id, spec.target, declared
    )


def _load(
    table: ManagedTable,
    spec: SyncSpec,
    plan: SourcePlan,
    result: SyncResult,
    sleep: Callable[[float], None],
) -> None:
    view_aliases(plan.schema)
    check_names(plan.schema)
    result.cleanup["created_internal_table"] = table.create(plan.schema, result.run_id)
    copied: dict[str, Written] = {}
    for attempt in range(1, spec.retry.max_attempts + 1):
        result.retry["attempts"] = attempt
        kept = f"{result.run_id}-kept-{attempt}"
        try:
            version = _load_once(table, spec, plan, result, copied, kept)
        except Exception as error:
            # Only the delete depends on the head, so a conflict keeps what was copied.
            table.discard(kept)
            last = attempt == spec.retry.max_attempts
            conflict = isinstance(error, PublishConflict)
            if last or not conflict:
                for number in range(len(copied) + 1):
                    table.discard(_copy_directory(result, number))
            if not conflict:
                raise
            delay = 0.0
            if not last:
                delay = retry_delay(
                    spec.retry, attempt, random.uniform(0, spec.retry.jitter_seconds)
                )
            result.retry["retryable_errors"].append(
                {"attempt": attempt, "error_message": str(error), "delay_seconds": delay}
            )
            if last:
                raise
            sleep(delay)
        else:
            result.version = version.number
            result.publish_ids.append(f"v{version.number}")
            for schema, written in copied.items():
                if schema != version.schema.json():
                    table.discard(written.part.directory)
            return


def _copy_directory(result: SyncResult, number: int) -> str:
    return result.run_id if number == 0 else f"{result.run_id}-{number}"


def _load_once(
    table: ManagedTable,
    spec: SyncSpec,
    plan: SourcePlan,
    result: SyncResult,
    copied: dict[str, Written],
    kept: str,
) -> Version:
    """Delete, copy and publish against the present head: all of it or nothing.

    ``copied`` holds the source's rows written so far, by the schema they were written
    under; ``kept`` is the directory for rows of slices that lose some.
    """
    head = table.head()
    evolution = plan_evolution(head.schema, plan.schema)
    full = result.effective_mode == FULL_REFRESH
    if not full:
        _check_appended(evolution, head.schema)
    schema = evolution.schema
    key = schema.json()

    def sliced(rows: DataFrame) -> DataFrame:
        return by_value(rows, spec.slice_by) if spec.slice_by else rows

    def delete() -> tuple[Deletion, tuple[Written, ...]]:
        deletion = table.delete(head, None if full else spec.incremental_predicate)
        if deletion.rewritten is None:
            return deletion, ()
        rows = project_by_name(deletion.rewritten, schema)
        return deletion, (table.write(sliced(rows), kept),)

    # Finding and rewriting the slices to delete from and copying the source have nothing
    # to do with each other, so they share the cluster.
    with ThreadPoolExecutor(max_workers=1) as pool:
        deleting = pool.submit(inheritable_thread_target(table.spark)(delete))
        if key not in copied:
            incoming = enforce_not_null(project_by_name(plan.rows(), schema), schema)
            copied[key] = table.write(sliced(incoming), _copy_directory(result, len(copied)))
        deletion, rewritten = deleting.result()
    added = (*rewritten, copied[key])
    version = table.publish(head, schema, deletion.kept, result.run_id, added)
    result.rows_deleted = None if full else deletion.rows_deleted
    result.slices_dropped = deletion.slices_dropped
    result.slices_rewritten = deletion.slices_rewritten
    result.cleanup["altered_internal_table_schema"] = evolution.altered
    result.cleanup["schema_evolution_warnings"] = evolution.warnings
    return version


def _check_appended(plan: EvolutionPlan, stored: T.StructType) -> None:
    """Rows already stored read a new column as NULL, so it cannot be NOT NULL."""
    strict = [f.name for f in plan.schema.fields[len(stored) :] if not f.nullable]
    if strict:
        raise SchemaError(
            "columns added to a table with rows must be nullable: " + ", ".join(strict)
        )


def _expire(table: ManagedTable, spec: SyncSpec, result: SyncResult) -> None:
    """Apply the retention. The run itself is done, so a problem here is only noted."""
    days = spec.retention_days
    try:
        if days is not None and table.expiry_is_due(days):
            result.cleanup["expired"] = table.expire(days)
    except Exception as error:
        result.cleanup["expiry_error"] = type(error).__name__


def _clean_up(
    table: ManagedTable, spec: SyncSpec, result: SyncResult, view_existed: bool
) -> None:
    """Drop a table only this run created and nobody published to or looked at."""
    if not (
        spec.drop_created_on_failure
        and result.cleanup["created_internal_table"]
        and not view_existed
    ):
        return
    try:
        if table.head().run_id == result.run_id:
            table.drop()
            result.cleanup["dropped_created_internal_table"] = True
    except Exception as error:
        result.cleanup["cleanup_error"] = type(error).__name__


def _log(
    engine: SparkSession,
    spec: SyncSpec,
    result: SyncResult,
    started: datetime,
    error_kind: str | None = None,
) -> None:
    if not spec.run_log:
        return
    row = {
        "run_id": result.run_id,
        "invocation_id": spec.invocation_id,
        "model_unique_id": spec.model_id,
        "target_view": spec.target,
        "internal_table": spec.table_location,
        "source_type": getattr(spec.source, "kind", type(spec.source).__name__),
        "effective_mode": result.effective_mode,
        "predicate_json": list(result.slices),
        "export_segments": result.segments,
        "source_job_references": result.job_references,
        "staging_table_reference": result.staging_reference,
        "publish_ids": result.publish_ids,
        "retry": result.retry,
        "cleanup": result.cleanup,
        "status": result.status,
        "error_message": result.error_message,
        "started_at": started,
        "finished_at": datetime.now(UTC),
    }
    try:
        append_run(engine, spec.run_log, row, error_kind)
    except Exception as error:
        if spec.run_log_fail_on_error:
            raise TableSyncError("the run log could not be written") from error
        result.run_log_error = type(error).__name__
