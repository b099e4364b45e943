"""Planning rules: schemas, evolution, slices and modes. Nothing here reads rows."""

from .evolution import Change, EvolutionPlan, can_widen, check_compatible, plan_evolution
from .modes import FULL_REFRESH, INCREMENTAL, effective_mode, retry_delay, slices_for
from .slices import RangePartition, TimePartition, disjoint_layers
from .types import (
    as_nullable,
    declared_type,
    map_declared_columns,
    map_source_schema,
    normalise_inferred,
    view_aliases,
)

__all__ = [
    "FULL_REFRESH",
    "INCREMENTAL",
    "Change",
    "EvolutionPlan",
    "RangePartition",
    "TimePartition",
    "as_nullable",
    "can_widen",
    "check_compatible",
    "declared_type",
    "disjoint_layers",
    "effective_mode",
    "map_declared_columns",
    "map_source_schema",
    "normalise_inferred",
    "plan_evolution",
    "retry_delay",
    "slices_for",
    "view_aliases",
]
