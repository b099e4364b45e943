"""Slices: how rows are dealt to directories while they are written."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..errors import SchemaError

#: The column that deals rows to slices, and the one that names a row's slice while a table is
#: read. Sources and tables cannot have columns of these names.
SLICE, AT = "_slice", "_slice_directory"

#: Most slices of a run. Labels are hashes below this, so what is recorded has a bound.
SLICES = 4096


def slice_label(value: Column) -> Column:
    """The slice of a value; equal values are in one slice."""
    number = F.pmod(F.xxhash64(value.cast("string")), F.lit(SLICES))
    return F.concat(F.lit("s"), F.lpad(number.cast("string"), 4, "0"))


def by_directory(scan: DataFrame) -> DataFrame:
    """Rows of a file scan with the slice of the directory they come from.

    Sources that are laid out by day, month or region keep that layout in the table, and
    since a file lies in one directory, nothing is shuffled. A frame that is not a scan of
    files is returned as it is.
    """
    check_names(scan.schema)
    directory = F.regexp_extract(F.col("_metadata.file_path"), "^(.*)/[^/]*$", 1)
    try:
        return scan.select("*", slice_label(directory).alias(SLICE))
    except AnalysisException:
        return scan


def by_value(frame: DataFrame, expression: str) -> DataFrame:
    """Rows with the slice of an expression's value, gathered by slice.

    The gathering is a hint that splits hot slices and joins small ones, so neither files
    nor tasks follow the skew.
    """
    return frame.withColumn(SLICE, slice_label(F.expr(expression))).hint("rebalance", SLICE)


def check_names(schema: T.StructType) -> None:
    taken = sorted({name for name in schema.names if name.lower() in (SLICE, AT)})
    if taken:
        raise SchemaError("column names that are not available: " + ", ".join(taken))


def with_slice(schema: T.StructType, frame: DataFrame) -> T.StructType:
    """``schema``, and the slice if the frame has it."""
    if SLICE not in frame.columns:
        return schema
    return T.StructType([*schema.fields, T.StructField(SLICE, T.StringType())])
