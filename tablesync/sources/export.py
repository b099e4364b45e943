"""Parquet export of source slices."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..plans.slices import RangePartition, TimePartition, partition_condition
from ..session import literal_path
from .listing import BROADCAST_SUFFIXES


def export_slices(
    slices: Sequence[DataFrame], location: str, run_id: str, compression: str = "ZSTD"
) -> list[str]:
    """Write slices below ``<location>/<run_id>/segment=NNNNN`` and return those paths.

    (With underscores after ``segment`` while the slices have a column of that name.)
    All slices are written by one job, in parallel, with no shuffle: each task holds
    rows of a single slice.
    """
    destination = f"{location.rstrip('/')}/{run_id}"
    segment = "segment"
    while segment.lower() in (name.lower() for name in slices[0].columns):
        segment += "_"
    names = [f"{number:05d}" for number in range(len(slices))]
    tagged = [frame.withColumn(segment, F.lit(name)) for frame, name in zip(slices, names)]
    everything = reduce(DataFrame.unionByName, tagged)
    everything.write.option("compression", compression.lower()).partitionBy(segment).parquet(
        destination
    )
    return [f"{destination}/{segment}={name}" for name in names]


def export_partitions(
    table: DataFrame,
    partition: TimePartition | RangePartition,
    ids: Sequence[str],
    location: str,
    run_id: str,
    compression: str = "ZSTD",
) -> list[str]:
    """Write partitions of a table like :func:`export_slices`, from a single scan.

    A row is labelled with the id of its partition in every unit the ids use, and joined
    to the ids by equality, so a row of two overlapping partitions is written twice.
    """
    destination = f"{location.rstrip('/')}/{run_id}"
    segment = "segment"
    while segment.lower() in (name.lower() for name in table.columns):
        segment += "_"
    labelled_partitions(table, partition, ids, segment).write.option(
        "compression", compression.lower()
    ).partitionBy(segment).parquet(destination)
    return [f"{destination}/{segment}={number:05d}" for number in range(len(ids))]


def labelled_partitions(
    table: DataFrame, partition: TimePartition | RangePartition, ids: Sequence[str], segment: str
) -> DataFrame:
    """Rows of the partitions with the number of the partition in ``segment``."""
    names = [f"{number:05d}" for number in range(len(ids))]
    spark = table.sparkSession
    rows = F.lit([f"{name} {label}" for name, label in zip(names, ids)])
    wanted = spark.range(1).select(F.explode(rows).alias("_wanted")).select(
        F.substring_index("_wanted", " ", 1).alias(segment),
        F.substring_index("_wanted", " ", -1).alias("_partition_id"),
    )
    if len(ids) <= BROADCAST_SUFFIXES:
        wanted = F.broadcast(wanted)
    labelled = table.where(partition_condition(partition, ids)).withColumn(
        "_label", F.explode(F.array_distinct(F.array(*partition.labels(ids))))
    )
    tagged = labelled.join(wanted, F.col("_label") == F.col("_partition_id"))
    return tagged.drop("_label", "_partition_id")


def read_export(like: DataFrame, location: str, run_id: str) -> DataFrame:
    """All exported slices of a run, with the exported columns only."""
    reader = like.sparkSession.read.schema(like.schema).option("recursiveFileLookup", True)
    return reader.parquet(literal_path(f"{location.rstrip('/')}/{run_id}"))
