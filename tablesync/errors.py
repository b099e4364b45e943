"""Errors raised by the library, one class per kind of failure a caller can act on."""

from __future__ import annotations


class TableSyncError(Exception):
    """Base class; catching it catches everything the library raises itself."""


class SpecError(TableSyncError):
    """The sync specification is not valid."""


class SchemaError(TableSyncError):
    """A schema cannot be mapped, evolved or loaded."""


class SourceError(TableSyncError):
    """The source, or the requested slice of it, cannot be read."""


class PublishConflict(TableSyncError):
    """Another run published a version first; recompute against the new head."""
