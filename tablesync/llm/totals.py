"""Running totals and ranks that do not gather a hot group in one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Pieces that a group is dealt to. A running total is summed within pieces and over the
#: pieces of a group, so no task holds more than a piece of one.
PIECES = 4096


def running_total(
    frame: DataFrame, group: list[str], order: Column, tie: list[str], value: str, out: str
) -> DataFrame:
    """Add ``out``: the sum of ``value`` over the rows before this one in its group.

    ``order`` is a 64-bit hash; rows run in its order, ties in that of ``tie``. Groups may
    be of any size: the leading bits of the hash split a group into up to ``PIECES``.
    Rows that agree in all of them may change places with each other only.
    """
    # The sign bit is flipped because the shift reads the hash as an unsigned number.
    leading = F.shiftrightunsigned(
        F.col("_rt_order").bitwiseXOR(F.lit(-(1 << 63))), 64 - (PIECES.bit_length() - 1)
    )
    dealt = frame.withColumn("_rt_order", order).withColumn("_rt_piece", leading.cast("int"))
    within = Window.partitionBy(*group, "_rt_piece").orderBy("_rt_order", *tie)
    within = within.rowsBetween(Window.unboundedPreceding, -1)
    across = Window.partitionBy(*group).orderBy("_rt_piece")
    across = across.rowsBetween(Window.unboundedPreceding, -1)
    totals = dealt.groupBy(*group, "_rt_piece").agg(F.sum(value).alias("_rt_total"))
    totals = totals.select(
        *[F.col(name).alias(f"_rt_g{i}") for i, name in enumerate(group)],
        F.col("_rt_piece").alias("_rt_p"),
        F.coalesce(F.sum("_rt_total").over(across), F.lit(0)).alias("_rt_base"),
    )
    same = [F.col(name).eqNullSafe(F.col(f"_rt_g{i}")) for i, name in enumerate(group)]
    condition = F.col("_rt_piece") == F.col("_rt_p")
    for one in same:
        condition = condition & one
    local = dealt.withColumn("_rt_before", F.coalesce(F.sum(value).over(within), F.lit(0)))
    joined = local.join(totals, condition)
    return joined.withColumn(out, F.col("_rt_base") + F.col("_rt_before")).drop(
        "_rt_order", "_rt_piece", "_rt_before", "_rt_base", "_rt_p", *[f"_rt_g{i}" for i in range(len(group))]
    )
