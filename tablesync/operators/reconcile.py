"""Reconciliation: whether two tables hold the same bag of rows, slice by slice."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.naming import quoted

_MEASURES = ("n", "x", "y")


def row_hashes(schema: T.StructType, columns: list[str]) -> tuple[Column, Column]:
    """Two independent hashes of a row's columns. A hash skips NULLs, so whether a column is
    NULL is hashed too; nested values are hashed as JSON that keeps their NULL fields."""
    parts = []
    for name in columns:
        column = F.col(quoted(name))
        if isinstance(schema[name].dataType, (T.StructType, T.ArrayType, T.MapType)):
            column = F.to_json(F.struct(column), {"ignoreNullFields": "false"})
        parts += [column, F.col(quoted(name)).isNull()]
    return F.xxhash64(*parts), F.xxhash64(F.lit(1), *reversed(parts))


def slice_digests(frame: DataFrame, key: Column, columns: list[str]) -> DataFrame:
    """``slice, n, x, y``: rows of each slice and digests of them as a bag.

    A digest is a sum of hashes, so the order of rows does not matter and their number does.
    It is aggregated before anything moves: of a slice of any size a task hands on one row.
    """
    one, other = row_hashes(frame.schema, columns)
    wide = T.DecimalType(38, 0)
    return frame.groupBy(key.alias("slice")).agg(
        F.count("*").alias("n"),
        F.sum(one.cast(wide)).alias("x"),
        F.sum(other.cast(wide)).alias("y"),
    )


def differing_slices(
    left: DataFrame, right: DataFrame, key: Column, columns: list[str] | None = None
) -> DataFrame:
    """``slice, left_rows, right_rows`` of the slices whose rows are not the same bag.

    ``columns`` are compared, by default all of ``left``; ``right`` has the same names, and
    types that cast to those of ``left``. A slice that one side lacks has 0 rows there; rows
    with a NULL key are a slice of their own. Only slices that differ are returned: equal
    digests, from the other side's point of view, remove a slice by an anti-join.
    """
    columns = columns or left.columns
    right = right.withColumns(
        {name: F.col(quoted(name)).cast(left.schema[name].dataType) for name in columns}
    )
    one, other = (slice_digests(frame, key, columns) for frame in (left, right))
    apart = []
    for own, against, names in ((one, other, ("n", "m")), (other, one, ("m", "n"))):
        same = reduce(
            lambda a, b: a & b,
            [own[name].eqNullSafe(against[name]) for name in ("slice", *_MEASURES)],
        )
        left_only = own.join(against, same, "left_anti").select("slice", F.col("n").alias(names[0]))
        apart.append(left_only.withColumn(names[1], F.lit(None).cast("bigint")).select("slice", "n", "m"))
    found = apart[0].unionByName(apart[1]).groupBy("slice")
    rows = (F.coalesce(F.max(name), F.lit(0)).alias(to) for name, to in (("n", "left_rows"), ("m", "right_rows")))
    return found.agg(*rows)
