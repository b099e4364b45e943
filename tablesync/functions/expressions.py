"""Column expressions used in declared columns and audit queries."""

from __future__ import annotations

import hashlib
import json
import re
from typing import Any

from pyspark.sql import Column
from pyspark.sql import functions as F

from .naming import quoted

_FILE_FIELD = re.compile(r'\$1:(?:"((?:[^"]|"")*)"|([A-Za-z_]\w*))')


def try_number(value: Column) -> Column:
    """Whole number with half-up rounding, NULL when the text is not a number."""
    return value.try_cast("decimal(38,0)")


def try_double(value: Column) -> Column:
    """Floating point number, NULL when the text is not a number."""
    return value.try_cast("double")


def file_field_refs(expression: str) -> str:
    """Write file-field references (``$1:"Col"``) as plain column references."""

    def column_ref(match: re.Match) -> str:
        name = match.group(2) or match.group(1).replace('""', '"')
        return quoted(name)

    return _FILE_FIELD.sub(column_ref, expression)


def json_count(array_json: Column) -> Column:
    """Number of items in a JSON array held as text; 0 for NULL or other JSON."""
    return F.coalesce(F.json_array_length(array_json), F.lit(0))


def json_field(value: Column, path: str, kind: str) -> Column:
    """A field of JSON text by its path (``$.a.b[0]``); NULL for text that is not JSON, a path
    that is not there or a value that is not of the type. The text is parsed once, to a variant."""
    return F.try_variant_get(F.try_parse_json(value), path, kind)


def log_timestamp(value: Column) -> Column:
    """Timestamp text with microseconds."""
    return F.date_format(value, "yyyy-MM-dd HH:mm:ss.SSSSSS")


def stable_hash(text: Column, length: int) -> Column:
    """Leading hex digits of the SHA-256 of a text column."""
    return F.substring(F.sha2(text, 256), 1, length)


def stable_digest(value: Any, length: int) -> str:
    """The same digest of a small planning value, through its canonical JSON."""
    text = json.dumps(value, sort_keys=True, separators=(",", ":"), default=str)
    return hashlib.sha256(text.encode("utf-8")).hexdigest()[:length]
