"""Intermediate tables in the folder every executor shares."""

from __future__ import annotations

from itertools import count

from pyspark.sql import DataFrame

from ..session import scratch_dir

#: So many stashes after one another before the driver is asked to collect garbage.
COLLECT_EVERY = 8

_stashes = count(1)


def fresh(name: str, taken: list[str]) -> str:
    """``name``, with underscores before it until no column is called so."""
    used = {column.lower() for column in taken}
    while name.lower() in used:
        name = f"_{name}"
    return name


def stash(frame: DataFrame, label: str) -> DataFrame:
    """Write ``frame`` as Parquet below ``spark.checkpoint.dir`` and read it back.

    It cuts the lineage: what reads the result needs neither the input again nor any
    executor that took part in writing it. Values that depend on how rows were dealt to
    tasks (row numbers, for one) are fixed from here on.

    Plans, broadcasts and shuffles of frames that are done with stay in the driver until its
    garbage is collected, which a long row of small jobs rarely makes it do by itself.
    """
    spark = frame.sparkSession
    path = scratch_dir(spark, f"llm-{label}")
    frame.write.option("compression", "zstd").parquet(path)
    if next(_stashes) % COLLECT_EVERY == 0:
        spark.sparkContext._jvm.System.gc()
    return spark.read.schema(frame.schema).parquet(path)
