"""Redaction of secrets and locations in free text (error messages in the run log)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# White space that is collapsed, and what is redacted by what (in this
# order).
WHITESPACE = r"[\t-\r\x1c-\x20\x{85}\p{Z}]+"
REDACTIONS = (
    (r"(?i)bearer [A-Za-z0-9._~+/=-]+", "Bearer <redacted>"),
    (r"(?i)(gs|gcs|s3)://[^ ]+", "<redacted-uri>"),
    (r"(?i)https?://[^ ]+", "<redacted-uri>"),
    (r"(?i)@[A-Za-z0-9_\".]+/[^ ]+", "@<redacted-stage-path>"),
    (
        r"(?i)(password|token|secret|credential|private[_-]?key)( ?[:=] ?)"
        r"('[^']*'|\"[^\"]*\"|[^ ]+)",
        "$1$2<redacted>",
    ),
)


def redact(text: Column) -> Column:
    """Collapse white space and hide tokens, URIs, stage paths and ``key=secret`` pairs."""
    text = F.btrim(F.regexp_replace(text, WHITESPACE, " "))
    for pattern, replacement in REDACTIONS:
        text = F.regexp_replace(text, pattern, replacement)
    return text


def error_text(kind: Column, message: Column, limit: int | None = None) -> Column:
    """``Kind: redacted message``.

    With a ``limit`` a longer message is cut to that many characters, the last three of
    which are dots; by default nothing is cut.
    """
    clean = redact(message)
    if limit is not None:
        cut = F.concat(F.rtrim(F.left(clean, F.lit(limit - 3))), F.lit("..."))
        clean = F.when(F.length(clean) > limit, cut).otherwise(clean)
    return F.when(clean == "", kind).otherwise(F.concat(kind, F.lit(": "), clean))
