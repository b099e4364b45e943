"""Names: lower-snake aliases and quoting."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# The alias rule as ordered (pattern, replacement) steps. Split
# before a capital that follows a lower-case letter or digit, split an acronym
# from the word after it, then turn each run of other characters into one "_".
SNAKE_STEPS = (
    (r"([a-z0-9])([A-Z])", "$1_$2"),
    (r"([A-Z]+)([A-Z][a-z])", "$1_$2"),
    (r"[^0-9A-Za-z]+", "_"),
)
EMPTY_NAME = "field"


def lower_snake(name: Column) -> Column:
    """Lower-snake form of a string column, inside whole-stage codegen."""
    for pattern, replacement in SNAKE_STEPS:
        name = F.regexp_replace(name, pattern, replacement)
    bare = F.lower(F.btrim(name, F.lit("_")))
    return (
        F.when(bare == "", F.lit(EMPTY_NAME))
        .when(bare.rlike("^[0-9]"), F.concat(F.lit("_"), bare))
        .otherwise(bare)
    )


def snake_name(name: str) -> str:
    """The same rule for one column name while planning on the driver."""
    for pattern, replacement in SNAKE_STEPS:
        name = re.sub(pattern, replacement.replace("$", "\\"), name)
    bare = name.strip("_").lower() or EMPTY_NAME
    return f"_{bare}" if bare[0].isdigit() else bare


def quoted(name: str) -> str:
    """Backtick-quoted identifier, safe for dots and spaces in names."""
    return "`" + name.replace("`", "``") + "`"
