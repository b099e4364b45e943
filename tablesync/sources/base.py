"""What every source hands to a sync run, and the registry of sources."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from ..errors import SourceError


@dataclass
class SourcePlan:
    """One run's reading plan. ``rows`` makes the frame to load, once per attempt; ``close``
    is called when the run no longer reads the source."""

    schema: T.StructType | None = None
    rows: Callable[[], DataFrame] | None = None
    segments: list[dict[str, Any]] = field(default_factory=list)
    job_references: list[dict[str, Any]] = field(default_factory=list)
    staging_reference: str | None = None
    expressions_at_load: bool = False
    skip_reason: str | None = None
    close: Callable[[], None] = lambda: None


@dataclass(frozen=True)
class SourceContext:
    """Sessions and run facts a planner may use.

    ``user`` is the caller's session (temporary views, functions), ``engine`` the
    child session with the engine's settings.
    """

    user: SparkSession
    engine: SparkSession
    mode: str
    run_id: str
    target: str
    declared: T.StructType | None = None


Planner = Callable[[SourceContext, Any], SourcePlan]
_PLANNERS: dict[type, Planner] = {}


def register_source(source_class: type, planner: Planner) -> None:
    """Make a new kind of source usable in a sync spec.

    The class needs ``kind``, ``full_refresh_slices`` and ``incremental_slices``.
    """
    _PLANNERS[source_class] = planner


def plan_source(context: SourceContext, source: Any) -> SourcePlan:
    planner = _PLANNERS.get(type(source))
    if planner is None:
        raise SourceError(f"unsupported source: {type(source).__name__}")
    return planner(context, source)
