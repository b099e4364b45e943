"""Vectors as numpy matrices."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def dimension_of(frame: DataFrame, column: str) -> int:
    """The most common number of components (the larger of equally common ones)."""
    sizes = frame.where(F.col(column).isNotNull()).groupBy(F.size(column).alias("d"))
    best = sizes.count().orderBy(F.desc("count"), F.desc("d")).first()
    return best["d"] if best else 0


def usable(column: str, dimension: int) -> Column:
    """True for a vector of that dimension, finite in every component and not zero."""
    fine = F.forall(
        column, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))
    )
    some = F.exists(column, lambda x: x != 0)
    right = F.col(column).isNotNull() & (F.size(column) == dimension)
    return F.coalesce(right & fine & some, F.lit(False))


def matrix(column: pa.Array | pa.ChunkedArray, dimension: int) -> np.ndarray:
    """A list column as float64 rows."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dimension)
