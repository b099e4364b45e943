"""Keep managed tables in step with Parquet prefixes, tables or Spark SQL."""

from .errors import PublishConflict, SchemaError, SourceError, SpecError, TableSyncError
from .operators.store import ManagedTable
from .operators.views import read_table, read_view, register_view
from .plans.slices import RangePartition, TimePartition
from .sources.base import SourcePlan, register_source
from .spec import ColumnSpec, PrefixSource, RetryPolicy, SqlSource, SyncSpec, TableSource
from .sync import SyncPlan, SyncResult, evolve, plan, sync

__all__ = [
    "ColumnSpec",
    "ManagedTable",
    "PrefixSource",
    "PublishConflict",
    "RangePartition",
    "RetryPolicy",
    "SchemaError",
    "SourceError",
    "SourcePlan",
    "SpecError",
    "SqlSource",
    "SyncPlan",
    "SyncResult",
    "SyncSpec",
    "TableSource",
    "TableSyncError",
    "TimePartition",
    "evolve",
    "plan",
    "read_table",
    "read_view",
    "register_source",
    "register_view",
    "sync",
]
