"""File listings as DataFrames, and what is planned from them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import literal_path

# The suffix list is broadcast only up to this many rows; beyond it the join
# shuffles both sides like any other.
BROADCAST_SUFFIXES = 10_000


def list_files(spark: SparkSession, *directories: str) -> DataFrame:
    """Name, size and modification time of every file under some directories.

    The file content column is never selected, so nothing is opened. Hidden names
    (leading ``_`` or ``.``) are skipped.
    """
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", True)
    return reader.load([*map(literal_path, directories)]).select("path", "length", "modificationTime")


def relative_to(path: Column, root: str) -> Column:
    """Path below ``root`` (which must be fully qualified)."""
    return F.substring(path, len(root.rstrip("/")) + 2, 1 << 30)


def normalise_suffix(suffix: Column) -> Column:
    return F.btrim(F.btrim(suffix), F.lit("/"))


def covering(suffixes: Sequence[str]) -> list[str]:
    """The suffixes that are not inside another one: list these, nothing twice."""
    cover: set[str] = set()
    for suffix in sorted(set(suffixes), key=len):
        pieces = suffix.split("/")
        if cover.isdisjoint({"", *("/".join(pieces[: n + 1]) for n in range(len(pieces)))}):
            cover.add(suffix)
    return sorted(cover)


def _suffix_rows(spark: SparkSession, suffixes: Sequence[str]) -> DataFrame:
    return spark.range(1).select(F.posexplode(F.lit(list(suffixes))).alias("segment", "path_suffix"))


def match_segments(
    listing: DataFrame,
    root: str,
    suffixes: Sequence[str],
    pattern: str | None = None,
    others: bool = False,
) -> DataFrame:
    """Files per segment: ``segment, path_suffix, rel, path, length, modificationTime``.

    Each file is paired with its own parent directories and joined to the suffix
    list by equality. ``month=1`` therefore never takes ``month=10``, a file that
    lies under two suffixes appears once for each, and no file is compared with
    every suffix. The pattern is searched in the name relative to the segment. With ``others``
    the files it leaves out stay too, told apart by ``selected``.
    """
    wanted = _suffix_rows(listing.sparkSession, suffixes)
    if len(suffixes) <= BROADCAST_SUFFIXES:
        wanted = F.broadcast(wanted)
    rel = relative_to(F.col("path"), root)
    pieces = F.split(rel, "/")
    parents = F.transform(
        F.sequence(F.lit(0), F.size(pieces) - 1),
        lambda depth: F.concat_ws("/", F.slice(pieces, F.lit(1), depth)),
    )
    named = listing.withColumn("rel", rel).withColumn("path_suffix", F.explode(parents))
    matched = named.join(wanted, "path_suffix")
    columns = ["segment", "path_suffix", "rel", "path", "length", "modificationTime"]
    selected = F.lit(True)
    if pattern:
        prefix = F.when(F.col("path_suffix") == "", 0).otherwise(F.length("path_suffix") + 1)
        name = F.col("rel").substr(prefix + F.lit(1), F.length("rel"))
        selected = name.rlike(pattern)
    if others:
        return matched.select(*columns, selected.alias("selected"))
    return matched.where(selected).select(*columns)


def selected_paths(matched: DataFrame) -> DataFrame:
    """``path, copies``: the directories and files that hold just what a pattern selects.

    ``matched`` has the files it leaves out as well. A directory without subdirectories, all
    files of which are selected once, stands for them; of other directories the selected files
    are named, with the number of segments each is selected in.
    """
    copies = F.count_if("selected").alias("copies")
    files = matched.groupBy("path").agg(copies)
    files = files.withColumn("folder", F.regexp_extract("path", "^(.*)/[^/]*$", 1))
    folders = files.groupBy("folder").agg(F.min("copies").alias("low"), F.max("copies").alias("high"))
    pieces = F.split("folder", "/")
    above = F.transform(
        F.sequence(F.lit(1), F.size(pieces) - 1),
        lambda depth: F.concat_ws("/", F.slice(pieces, F.lit(1), depth)),
    )
    parents = folders.select(F.explode(above).alias("folder")).distinct()
    whole = folders.where("low = 1 AND high = 1").join(parents, "folder", "left_anti")
    rest = files.where("copies > 0").join(whole.select("folder"), "folder", "left_anti")
    return whole.select(F.col("folder").alias("path"), F.lit(1).cast("long").alias("copies")).unionByName(
        rest.select("path", "copies")
    )


def segment_sums(matched: DataFrame) -> DataFrame:
    """Files and bytes of the segments that have files."""
    return matched.groupBy("segment").agg(
        F.count("*").alias("file_count"), F.sum("length").alias("total_bytes")
    )


def segment_rollup(matched: DataFrame, suffixes: Sequence[str]) -> DataFrame:
    """Files and bytes per segment; a segment without files counts 0."""
    wanted = _suffix_rows(matched.sparkSession, suffixes)
    return wanted.join(segment_sums(matched), "segment", "left").select(
        "segment",
        "path_suffix",
        F.coalesce("file_count", F.lit(0)).alias("file_count"),
        F.coalesce("total_bytes", F.lit(0)).alias("total_bytes"),
    )


def newest_files(matched: DataFrame, count: int) -> DataFrame:
    """The ``count`` files modified last (ties by name, descending)."""
    order = (F.col("modificationTime").desc_nulls_last(), F.col("rel").desc())
    return matched.orderBy(*order).limit(count)
