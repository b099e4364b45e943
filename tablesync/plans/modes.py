"""Full refresh or incremental."""

from __future__ import annotations

FULL_REFRESH, INCREMENTAL = "full_refresh", "incremental"


def effective_mode(
    strategy: str, full_refresh: bool, table_exists: bool, view_exists: bool
) -> str:
    """Incremental only when it is asked for and there is something to add to."""
    if strategy == INCREMENTAL and not full_refresh and table_exists and view_exists:
        return INCREMENTAL
    return FULL_REFRESH


def slices_for(source, mode: str) -> tuple[str, ...]:
    """The slice list (path suffixes or predicates) a source uses in this mode."""
    return source.full_refresh_slices if mode == FULL_REFRESH else source.incremental_slices


def retry_delay(policy, failed_attempt: int, jitter: float) -> float:
    """Seconds to wait after the given failed attempt, counted from 1."""
    wait = policy.initial_delay_seconds * policy.backoff_multiplier ** (failed_attempt - 1)
    return min(policy.max_delay_seconds, wait + jitter)
