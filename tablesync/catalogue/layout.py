"""Source layouts the catalogue queries read, written from the given tables.

A layout is written once per session and input folder and then shared: syncs
never change their source.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import Files, scratch_dir

_WRITTEN: dict[tuple[str, str, str], str] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def once(spark: SparkSession, sf_dir: str, name: str, write: Callable[[str], None]) -> str:
    """The layout's location, written on first use."""
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key not in _WRITTEN:
        location = scratch_dir(spark, name)
        write(location)
        _WRITTEN[key] = location
    return _WRITTEN[key]


def write_partitioned(frame: DataFrame, location: str, *columns: str) -> None:
    """One directory per value. REBALANCE gives small partitions few files and splits
    a hot one over many tasks, however large it is."""
    frame.hint("rebalance", *columns).write.partitionBy(*columns).parquet(location)


def lake(spark: SparkSession, sf_dir: str) -> str:
    """``orders`` under ``year=YYYY/month=M`` (unpadded)."""

    def write(location: str) -> None:
        orders = table(spark, sf_dir, "orders")
        dated = orders.withColumns(
            {"year": F.year("o_orderdate"), "month": F.month("o_orderdate")}
        )
        write_partitioned(dated, location, "year", "month")

    return once(spark, sf_dir, "lake", write)


def revised_lake(spark: SparkSession, sf_dir: str) -> str:
    """The lake after a correction: each price is higher by one."""

    def write(location: str) -> None:
        orders = table(spark, sf_dir, "orders")
        dated = orders.withColumns(
            {
                "o_totalprice": F.col("o_totalprice") + 1,
                "year": F.year("o_orderdate"),
                "month": F.month("o_orderdate"),
            }
        )
        write_partitioned(dated, location, "year", "month")

    return once(spark, sf_dir, "revised", write)


def aged_lake(spark: SparkSession, sf_dir: str) -> str:
    """The lake with a column that only its first month, written first, has."""

    def write(location: str) -> None:
        orders = table(spark, sf_dir, "orders")
        first = (F.year("o_orderdate") == 1995) & (F.month("o_orderdate") == 1)
        oldest = orders.where(first).withColumn("legacy", F.upper("o_orderpriority"))
        oldest.write.parquet(f"{location}/first")
        rest = orders.where(~first).withColumns(
            {"year": F.year("o_orderdate"), "month": F.month("o_orderdate")}
        )
        write_partitioned(rest, f"{location}/later", "year", "month")

    return once(spark, sf_dir, "aged", write)


def two_schemas(spark: SparkSession, sf_dir: str) -> str:
    """``suppliers/t``, a table whose second half has a column more; and ``days/events_*``,
    whose first day lacks a column of the others and has one they lack."""

    def write(location: str) -> None:
        supplier = table(spark, sf_dir, "supplier")
        odd = F.col("s_suppkey") % 2 == 1
        supplier.where(~odd).write.parquet(f"{location}/suppliers/t")
        wider = supplier.where(odd).withColumn("s_double", F.col("s_acctbal") * 2)
        wider.write.mode("append").parquet(f"{location}/suppliers/t")
        events = table(spark, sf_dir, "events")
        day = F.to_date("ts")
        first = F.lit("2024-01-01").cast("date")
        names = ("event_id", "ts", "event_type")
        events.where(day == first).select(*names, "user_id").write.parquet(
            f"{location}/days/events_1"
        )
        events.where(day > first).select(*names, "value").write.parquet(
            f"{location}/days/events_2"
        )

    return once(spark, sf_dir, "two-schemas", write)


def shards(spark: SparkSession, sf_dir: str) -> str:
    """``events`` as one table per day, ``events_YYYYMMDD``."""

    def write(location: str) -> None:
        events = table(spark, sf_dir, "events")
        write_partitioned(
            events.withColumn("day", F.date_format("ts", "yyyyMMdd")), location, "day"
        )
        files = Files(spark, location)
        for name in files.names(location):
            if name.startswith("day="):
                files.rename(f"{location}/{name}", f"{location}/events_{name[4:]}")

    return once(spark, sf_dir, "shards", write)


def eras(
    spark: SparkSession, sf_dir: str, name: str, old: list[Column], new: list[Column]
) -> str:
    """All ``orders`` under two prefixes whose files have different schemas: orders
    before 1998 with the ``old`` columns, later ones with the ``new`` columns."""

    def write(location: str) -> None:
        orders = table(spark, sf_dir, "orders")
        cut = F.lit("1998-01-01")
        orders.where(F.col("o_orderdate") < cut).select(old).write.parquet(f"{location}/era=old")
        orders.where(F.col("o_orderdate") >= cut).select(new).write.parquet(f"{location}/era=new")

    return once(spark, sf_dir, name, write)
