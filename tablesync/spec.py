"""The sync specification: what to keep equal to what, and how."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from dataclasses import dataclass, field, fields
from typing import Any

from .errors import SpecError
from .operators.load import LOAD_MODES, STRICT
from .plans.modes import FULL_REFRESH, INCREMENTAL
from .plans.slices import (
    AUTO,
    SQL_PREDICATE_TYPES,
    TABLE_PREDICATE_TYPES,
    RangePartition,
    TimePartition,
)

# The choices a spec offers.
STRATEGIES = (FULL_REFRESH, INCREMENTAL)
INCREMENTAL_STRATEGIES = ("delete+copy",)
COMPRESSIONS = ("NONE", "SNAPPY", "GZIP", "ZSTD")


def _listed(value: Any, name: str) -> tuple[str, ...]:
    """A text value is a one-item list; None is an empty one."""
    if value is None or value == "":
        return ()
    items = (value,) if isinstance(value, str) else tuple(value)
    if any(item is None for item in items):
        raise SpecError(f"{name} must not contain null values")
    return tuple(str(item) for item in items)


def _suffixes(value: Any, name: str) -> tuple[str, ...]:
    items = _listed(value, name) or ("",)
    for item in items:
        if "://" in item or item.startswith("@"):
            raise SpecError(f"{name} must be relative to the location, not {item!r}")
    return tuple(item.strip().strip("/") for item in items)


def _choice(value: str, choices: Iterable[str], name: str) -> None:
    if value not in choices:
        raise SpecError(f"{name} must be one of: {', '.join(choices)}")


@dataclass(frozen=True)
class ColumnSpec:
    """A declared column; ``type`` is Spark DDL or a common scalar spelling."""

    name: str
    type: str
    nullable: bool = True
    alias: str | None = None
    expression: str | None = None

    def __post_init__(self):
        for part in ("name", "type"):
            if not str(getattr(self, part) or "").strip():
                raise SpecError(f"a declared column needs a {part}")
        for part in ("alias", "expression"):
            value = getattr(self, part)
            if value is not None and not value.strip():
                raise SpecError(f"{part} of column {self.name} must not be empty when set")
        if not isinstance(self.nullable, bool):
            raise SpecError(f"nullable of column {self.name} must be true or false")


@dataclass(frozen=True)
class PrefixSource:
    """Parquet files below ``location``, chosen by path suffix and name pattern.

    The schema comes from the footers of all chosen files, or of the newest
    ``infer_max_files`` only (columns that only other files have are then not loaded).
    ``split_bytes`` sets the input bytes per task of the copy; Spark's setting by default.
    """

    location: str
    file_pattern: str | None = None
    full_refresh_paths: tuple[str, ...] = ("",)
    incremental_paths: tuple[str, ...] = ("",)
    skip_missing: bool = False
    infer_max_files: int | None = None
    load_mode: str = STRICT
    split_bytes: int | None = None

    kind = "prefix"

    def __post_init__(self):
        for name in ("full_refresh_paths", "incremental_paths"):
            object.__setattr__(self, name, _suffixes(getattr(self, name), name))
        object.__setattr__(self, "load_mode", (self.load_mode or STRICT).strip().lower())
        _choice(self.load_mode, LOAD_MODES, "load_mode")
        if not self.location:
            raise SpecError("location is required")
        if self.file_pattern == "":
            raise SpecError("file_pattern must not be empty when set")
        for name in ("infer_max_files", "split_bytes"):
            if getattr(self, name) is not None and getattr(self, name) < 1:
                raise SpecError(f"{name} must be at least 1 when set")

    @property
    def full_refresh_slices(self) -> tuple[str, ...]:
        return self.full_refresh_paths

    @property
    def incremental_slices(self) -> tuple[str, ...]:
        return self.incremental_paths

    @property
    def is_sliced(self) -> bool:
        return self.incremental_paths != ("",)


@dataclass(frozen=True)
class _PredicateSource:
    def _normalise(self):
        for name in ("full_refresh_predicates", "incremental_predicates"):
            object.__setattr__(self, name, _listed(getattr(self, name), name))
        object.__setattr__(self, "compression", str(self.compression or "ZSTD").upper())
        _choice(self.compression, COMPRESSIONS, "compression")

    @property
    def full_refresh_slices(self) -> tuple[str, ...]:
        return self.full_refresh_predicates

    @property
    def incremental_slices(self) -> tuple[str, ...]:
        return self.incremental_predicates

    @property
    def is_sliced(self) -> bool:
        return bool(self.incremental_predicates)


@dataclass(frozen=True)
class TableSource(_PredicateSource):
    """A table, a wildcard shard set (``name_*``) or partitions of a table.

    ``dataset`` is a directory of tables or the name of a catalog database. With
    ``export_location`` each slice is first written there as Parquet.
    """

    dataset: str
    table: str
    predicate_type: str = AUTO
    full_refresh_predicates: tuple[str, ...] = ()
    incremental_predicates: tuple[str, ...] = ()
    skip_missing: bool = False
    partition: TimePartition | RangePartition | None = None
    schema_fields: tuple[Mapping[str, Any], ...] | None = None
    export_location: str | None = None
    compression: str = "ZSTD"

    kind = "table"

    def __post_init__(self):
        self._normalise()
        if not self.dataset or not self.table:
            raise SpecError("dataset and table are required")
        _choice(self.predicate_type, TABLE_PREDICATE_TYPES, "predicate_type")


@dataclass(frozen=True)
class SqlSource(_PredicateSource):
    """The result of Spark SQL, staged as Parquet and reused until it expires."""

    sql: str
    staging_location: str
    predicate_type: str = AUTO
    full_refresh_predicates: tuple[str, ...] = ()
    incremental_predicates: tuple[str, ...] = ()
    identity: str = ""
    staging_hours: float = 24
    reuse: bool = True
    force_rebuild: bool = False
    export_location: str | None = None
    compression: str = "ZSTD"

    kind = "sql"

    def __post_init__(self):
        self._normalise()
        if not self.sql.strip():
            raise SpecError("sql is required")
        if not self.staging_location:
            raise SpecError("staging_location is required")
        _choice(self.predicate_type, SQL_PREDICATE_TYPES, "predicate_type")


@dataclass(frozen=True)
class RetryPolicy:
    """Attempts and waits after another run published first."""

    max_attempts: int = 3
    initial_delay_seconds: float = 5
    max_delay_seconds: float = 60
    backoff_multiplier: float = 2.0
    jitter_seconds: float = 3

    def __post_init__(self):
        if self.max_attempts < 1:
            raise SpecError("max_attempts must be at least 1")
        if self.backoff_multiplier < 1:
            raise SpecError("backoff_multiplier must be at least 1.0")
        for name in ("initial_delay_seconds", "max_delay_seconds", "jitter_seconds"):
            if getattr(self, name) < 0:
                raise SpecError(f"{name} must be non-negative")


@dataclass(frozen=True)
class SyncSpec:
    """One managed table and the source it follows.

    ``target`` names the view (``name``, ``schema.name`` or ``db.schema.name``). The
    table lives at ``location``, by default ``<warehouse>/<target parts>``. Versions
    replaced more than ``retention_days`` ago are removed after a successful run (None
    keeps them all). ``slice_by`` is an expression over the table's columns whose values
    become slices, the units a delete drops or rewrites (for example
    ``date_trunc('month', "order_date")``); by default a slice is a directory of the source.
    With ``catalog_schema`` a view named like the last part of the target is kept in that
    schema of the session catalog.
    """

    target: str
    source: Any
    warehouse: str | None = None
    location: str | None = None
    strategy: str = INCREMENTAL
    incremental_strategy: str = "delete+copy"
    incremental_predicate: str | None = None
    full_refresh: bool = False
    columns: tuple[ColumnSpec, ...] = ()
    partition_by: tuple[str, ...] = ()
    cluster_by: tuple[str, ...] = ()
    retention_days: float | None = 7
    retry: RetryPolicy = field(default_factory=RetryPolicy)
    drop_created_on_failure: bool = True
    run_log: str | None = None
    run_log_fail_on_error: bool = False
    invocation_id: str | None = None
    model_id: str | None = None
    slice_by: str | None = None
    catalog_schema: str | None = None

    def __post_init__(self):
        object.__setattr__(self, "columns", tuple(self.columns or ()))
        _choice(self.strategy, STRATEGIES, "strategy")
        _choice(self.incremental_strategy, INCREMENTAL_STRATEGIES, "incremental_strategy")
        if not self.target:
            raise SpecError("target is required")
        if not self.location and not self.warehouse:
            raise SpecError("location or warehouse is required")
        if self.retention_days is not None and self.retention_days < 0:
            raise SpecError("retention_days must be non-negative")
        if self.partition_by or self.cluster_by:
            raise SpecError("partition_by and cluster_by are not supported")
        names = [column.name for column in self.columns]
        if len(set(names)) < len(names):
            raise SpecError("declared columns contain duplicate column names")
        sliced = getattr(self.source, "is_sliced", None)
        if sliced is not None and sliced != bool(self.incremental_predicate):
            raise SpecError(
                "incremental slices of the source and incremental_predicate must be "
                "both present or both absent"
            )

    @property
    def table_location(self) -> str:
        if self.location:
            return self.location.rstrip("/")
        return f"{self.warehouse.rstrip('/')}/{self.target.replace('.', '/')}"

    @classmethod
    def from_dict(cls, payload: Mapping[str, Any]) -> SyncSpec:
        """A spec from plain (for example JSON) values.

        ``source`` is a mapping with ``kind`` (``prefix``, ``table`` or ``sql``) and
        the source's own options. Unknown keys are refused.
        """
        values = dict(payload)
        source = values.get("source")
        if isinstance(source, Mapping):
            source = dict(source)
            kinds = {cls_.kind: cls_ for cls_ in (PrefixSource, TableSource, SqlSource)}
            kind = source.pop("kind", None)
            if kind not in kinds:
                raise SpecError(f"source kind must be one of: {', '.join(kinds)}")
            partition = source.get("partition")
            if isinstance(partition, Mapping):
                shape = RangePartition if "interval" in partition else TimePartition
                source["partition"] = _built(shape, partition)
            values["source"] = _built(kinds[kind], source)
        if "columns" in values:
            if not values["columns"]:
                raise SpecError("columns must not be empty when set")
            values["columns"] = tuple(_built(ColumnSpec, column) for column in values["columns"])
        if isinstance(values.get("retry"), Mapping):
            values["retry"] = _built(RetryPolicy, values["retry"])
        return _built(cls, values)


def _built(cls: type, values: Mapping[str, Any]):
    known = {item.name for item in fields(cls)}
    unknown = sorted(set(values) - known)
    if unknown:
        raise SpecError(f"unknown {cls.__name__} options: {', '.join(unknown)}")
    try:
        return cls(**values)
    except TypeError as error:
        raise SpecError(f"{cls.__name__}: {error}") from None
