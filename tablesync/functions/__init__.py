"""Scalar functions, all built from Spark's own expressions."""

from .expressions import (
    file_field_refs,
    json_count,
    json_field,
    log_timestamp,
    stable_digest,
    stable_hash,
    try_double,
    try_number,
)
from .naming import lower_snake, quoted, snake_name
from .text import error_text, redact

__all__ = [
    "error_text",
    "file_field_refs",
    "json_count",
    "json_field",
    "log_timestamp",
    "lower_snake",
    "quoted",
    "redact",
    "snake_name",
    "stable_digest",
    "stable_hash",
    "try_double",
    "try_number",
]
