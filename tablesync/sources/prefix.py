"""Parquet files under a path prefix."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from decimal import Decimal
from functools import reduce

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..errors import SchemaError, SourceError
from ..operators.load import (
    CONVERT,
    check_file_types,
    convert,
    has_load_expressions,
)
from ..operators.slicing import SLICE, by_directory
from ..plans.modes import slices_for
from ..plans.slices import disjoint_layers, suffix_containers
from ..plans.types import normalise_inferred
from ..session import Files, literal_path, one_partition_per_core
from ..spec import PrefixSource
from .base import SourceContext, SourcePlan, register_source
from .listing import (
    covering,
    list_files,
    match_segments,
    newest_files,
    segment_rollup,
    segment_sums,
    selected_paths,
)

class Prefix:
    """The files a suffix list selects under a location."""

    def __init__(
        self,
        spark: SparkSession,
        location: str,
        suffixes: tuple[str, ...] = ("",),
        pattern: str | None = None,
    ):
        self.spark = spark
        self.named: list[tuple[str, int]] | None = None
        self.suffixes = suffixes
        self.pattern = pattern
        self._files = Files(spark, location)
        self.root = self._files.qualified(location.rstrip("/"))
        distinct = list(dict.fromkeys(suffixes))
        found = self._files.directories([self._path(suffix) for suffix in distinct])
        self.present = frozenset(s for s, there in zip(distinct, found) if there)

    def _path(self, suffix: str) -> str:
        return f"{self.root}/{suffix}" if suffix else self.root

    def files(self, others: bool = False) -> DataFrame:
        """One row per (segment, file); with ``others`` also of files the pattern leaves out."""
        directories = [self._path(suffix) for suffix in covering(sorted(self.present))]
        if directories:
            listing = list_files(self.spark, *directories)
        else:
            listing = self.spark.createDataFrame(
                [], "path string, length long, modificationTime timestamp"
            )
        return match_segments(listing, self.root, self.suffixes, self.pattern, others)

    def rollup(self) -> DataFrame:
        return segment_rollup(self.files(), self.suffixes)

    def newest(self, count: int) -> DataFrame:
        return newest_files(self.files(), count)

    def infer_schema(self, max_files: int | None = None) -> T.StructType:
        """Table schema from the footers of all files, or of the newest ``max_files``."""
        if max_files is None:
            return normalise_inferred(self.read().schema)
        return footer_schema(self.newest(max_files))

    def read(self, schema: T.StructType | None = None, sliced: bool = False) -> DataFrame:
        """All rows of all segments: a file in two segments is read twice.

        Without a schema the rows have the merged schema of every selected file; the
        executors read the footers, and one listing serves both footers and rows.
        Directory names like ``dt=...`` are not columns. ``sliced`` rows come with the slice
        of their directory.
        """
        mark = by_directory if sliced else (lambda scan: scan)
        if self.pattern:
            copies = self.named if self.named is not None else named_paths(self.files(others=True))
            names = [path for path, _ in copies]
            if schema is None and all(count == 1 for _, count in copies):
                return mark(merging_scan(self.spark, names))
            paths = [path for path, count in copies for _ in range(count)]
            return mark(_reader(self.spark, schema or _merged(self.spark, names))(paths))
        chosen = [suffix for suffix in self.suffixes if suffix in self.present]
        layers = [chosen]
        if len(covering(chosen)) < len(chosen):
            layers = disjoint_layers(chosen, suffix_containers)
            schema = schema or _merged(self.spark, [self._path(s) for s in covering(chosen)])
        scans = []
        for layer in layers:
            paths = [self._path(suffix) for suffix in layer]
            if schema is None:
                return mark(merging_scan(self.spark, paths))
            scans.append(mark(_reader(self.spark, schema, recursiveFileLookup=True)(paths)))
        return reduce(DataFrame.unionAll, scans)


def named_paths(matched: DataFrame) -> list[tuple[str, int]]:
    """Directories and files a pattern selects, and in how many segments each lies.

    A pattern cannot be given to the reader, so paths go back to it as a list. Files whose
    directory is selected whole are not named; of a lake laid out by day the days are.
    """
    return [(row["path"], row["copies"]) for row in selected_paths(matched).collect()]


def footer_schema(files: DataFrame) -> T.StructType:
    """Table schema from the footers of a few files."""
    paths = [row["path"] for row in files.select("path").collect()]
    return normalise_inferred(_merged(files.sparkSession, paths))


def _reader(spark: SparkSession, schema: T.StructType, **options):
    reader = spark.read.schema(schema).options(**options)
    return lambda paths: reader.parquet(*map(literal_path, paths))


def merging_scan(spark: SparkSession, paths: list[str]) -> DataFrame:
    reader = spark.read.option("recursiveFileLookup", True).option("mergeSchema", True)
    return agreeing(lambda: reader.parquet(*map(literal_path, paths)))


def agreeing(scan: Callable[[], DataFrame]) -> DataFrame:
    """The scan, or a clear error when the footers it merges do not agree."""
    try:
        return scan()
    except (PySparkException, Py4JJavaError) as error:
        if "CANNOT_MERGE" not in str(error):
            raise
        raise SchemaError("the schemas of the files do not agree") from error


def _merged(spark: SparkSession, paths: list[str]) -> T.StructType:
    return merging_scan(spark, paths).schema


#: How often a plan is made anew when files come or go while it is made.
LISTINGS = 3


def plan_prefix(context: SourceContext, source: PrefixSource) -> SourcePlan:
    suffixes = slices_for(source, context.mode)
    prefix = Prefix(context.engine, source.location, suffixes, source.file_pattern)
    schema = context.declared
    with one_partition_per_core(context.engine):
        for _ in range(LISTINGS):
            # One listing serves the sums and the file names. The scan lists once more, reads
            # all footers and holds on to what it found: it must be what was planned.
            listed = prefix.files(others=bool(source.file_pattern)).persist()
            try:
                matched = listed.where("selected") if source.file_pattern else listed
                segments = _segments(matched, suffixes)
                if not any(segment["file_count"] for segment in segments):
                    reason = "no Parquet files matched the location"
                    if source.skip_missing:
                        return SourcePlan(segments=segments, skip_reason=reason)
                    raise SourceError(reason)
                prefix.named = named_paths(listed) if source.file_pattern else None
                frame = prefix.read(sliced=True)
                if schema is None and source.infer_max_files is not None:
                    schema = footer_schema(newest_files(matched, source.infer_max_files))
                planned = listing_digest(matched.groupBy("path").agg(F.first("length").alias("length")))
            finally:
                listed.unpersist()
            if _same_files(planned, scan_digest(frame), segments):
                break
        else:
            raise SourceError("files under the location keep changing while they are listed")
    if schema is None:
        schema = normalise_inferred(frame.drop(SLICE).schema)
    if source.split_bytes:
        context.engine.conf.set("spark.sql.files.maxPartitionBytes", str(source.split_bytes))

    def rows() -> DataFrame:
        # Rows come as the files hold them, so nested names keep the files' spelling;
        # the conversion, or the projection by name, fits them to the table.
        if source.load_mode == CONVERT:
            return convert(frame, schema)
        check_file_types(frame.schema, schema)
        return frame

    return SourcePlan(
        schema=schema,
        rows=rows,
        segments=segments,
        job_references=[{"operation": "list", "segments": len(segments)}],
        expressions_at_load=source.load_mode == CONVERT and has_load_expressions(schema),
    )


@dataclass(frozen=True)
class ListingDigest:
    """A set of files in a few numbers that do not depend on their order."""

    count: int
    hashes: tuple[int, Decimal]
    size: int


def _path_digest(paths: DataFrame) -> list[Column]:
    hashed = F.xxhash64("path")
    return [
        F.count("*").alias("n"),
        F.coalesce(F.bit_xor(hashed), F.lit(0)).alias("x"),
        F.coalesce(F.sum(hashed.cast("decimal(38,0)")), F.lit(0)).alias("s"),
    ]


def listing_digest(files: DataFrame) -> ListingDigest:
    """Of a listing with a row for each file, ``path, length``."""
    total = F.coalesce(F.sum("length"), F.lit(0)).alias("size")
    row = files.agg(*_path_digest(files), total).first()
    return ListingDigest(row["n"], (row["x"], row["s"]), row["size"])


def scan_digest(frame: DataFrame) -> ListingDigest:
    """Of the files in a scan's own listing; their names stay in the engine."""
    spark = frame.sparkSession
    jvm = spark._jvm
    names = jvm.scala.collection.immutable.ArraySeq.unsafeWrapArray(frame._jdf.inputFiles())
    listed = spark._jsparkSession.createDataset(names, jvm.org.apache.spark.sql.Encoders.STRING())
    # These are URIs: encoded, and with an empty authority that a listing leaves out.
    decoded = F.url_decode(F.replace("value", F.lit("+"), F.lit("%2B")))
    path = F.regexp_replace(decoded, "^([A-Za-z][A-Za-z0-9+.-]*):///", "$1:/").alias("path")
    paths = DataFrame(listed.toDF(), spark).select(path)
    row = paths.agg(*_path_digest(paths)).first()
    leaves = frame._jdf.queryExecution().analyzed().collectLeaves()
    size = sum(leaves.apply(i).stats().sizeInBytes() for i in range(leaves.size()))
    return ListingDigest(row["n"], (row["x"], row["s"]), size)


def _same_files(planned: ListingDigest, scanned: ListingDigest, segments: list[dict]) -> bool:
    """Whether a scan is of the planned files. Bytes are compared where no file is read twice."""
    same = (planned.count, planned.hashes) == (scanned.count, scanned.hashes)
    once = sum(segment["file_count"] for segment in segments) == planned.count
    return same and (not once or planned.size == scanned.size)


def _segments(matched: DataFrame, suffixes: tuple[str, ...]) -> list[dict]:
    sums = {row["segment"]: row for row in segment_sums(matched).collect()}
    segments = []
    for number, suffix in enumerate(suffixes):
        found = sums.get(number)
        segments.append(
            {
                "path_suffix": suffix,
                "file_count": found["file_count"] if found else 0,
                "total_bytes": found["total_bytes"] if found else 0,
            }
        )
    return segments


register_source(PrefixSource, plan_prefix)
