"""Table-shaped sources: concrete tables, wildcard shards and table partitions."""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import cache, cached_property, partial, reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..errors import SourceError
from ..operators.load import check_file_types, convert
from ..operators.slicing import SLICE, by_directory, with_slice
from ..plans.modes import slices_for
from ..plans.slices import (
    NULL_PARTITION,
    PARTITION_DECORATOR,
    TABLE_SUFFIX,
    RangePartition,
    TimePartition,
    disjoint_layers,
    is_wildcard,
    partition_condition,
    resolve_table_predicates,
)
from ..plans.types import map_source_schema, normalise_inferred
from ..session import Files, literal_path
from ..spec import TableSource
from .base import SourceContext, SourcePlan, register_source
from .export import export_partitions, export_slices, read_export
from .prefix import agreeing as _agreeing
from .prefix import merging_scan


# Fixed value: the directory name of rows whose partition value is NULL.
_NULL_DIRECTORY = "__HIVE_DEFAULT_PARTITION__"


class Dataset:
    """A set of tables: Parquet directories under a path, or a catalog database."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.name = name.rstrip("/")
        self.is_path = "/" in name
        self._files = Files(spark, name) if self.is_path else None

    @cached_property
    def _names(self) -> frozenset[str]:
        """Everything directly under a path dataset, from one listing."""
        return frozenset(self._files.names(self.name))

    def exists(self, table: str) -> bool:
        if self.is_path:
            return table in self._names or f"{table}.parquet" in self._names
        return self.spark.catalog.tableExists(f"{self.name}.{table}")

    def tables(self, prefix: str) -> list[str]:
        """Tables whose name starts with ``prefix``, by name."""
        if self.is_path:
            names = {n.removesuffix(".parquet") for n in self._names if n[:1] not in ("_", ".")}
        else:
            names = {table.name for table in self.spark.catalog.listTables(self.name)}
        return sorted(name for name in names if name.startswith(prefix))

    def path(self, table: str) -> str:
        """A table is a directory, or one ``<table>.parquet`` file or directory."""
        return f"{self.name}/{table if table in self._names else f'{table}.parquet'}"

    def read(self, table: str) -> DataFrame:
        if self.is_path:
            # Files of a table may have been written under different schemas.
            reader = self.spark.read.option("mergeSchema", True)
            return _agreeing(lambda: reader.parquet(literal_path(self.path(table))))
        return self.spark.table(f"{self.name}.{table}")

    def read_shards(self, tables: Sequence[str], sliced: bool = False) -> DataFrame:
        """All rows of some tables, in the columns and types of the first one.

        Columns a later shard adds are dropped, columns it lacks are NULL. Flat
        Parquet shards become a single scan however many there are; a shard named
        twice is read twice. ``sliced`` rows come with the slice of their directory.
        """
        mark = by_directory if sliced else (lambda scan: scan)
        first = self.read(tables[0])
        schema = normalise_inferred(first.schema)
        if self.is_path and not self._has_partition_directories(tables[0]):
            reader = self.spark.read.schema(schema)
            return reduce(
                DataFrame.unionAll,
                [
                    mark(reader.parquet(*(literal_path(self.path(name)) for name in layer)))
                    for layer in disjoint_layers(tables)
                ],
            )
        scans = [mark(self.read(table)) for table in tables]
        return reduce(DataFrame.unionAll, [scan.to(with_slice(schema, scan)) for scan in scans])

    def partition(self, table: str) -> TimePartition | RangePartition | None:
        """How a table is laid out: by the first partition column that the catalog, or the
        table's directory names, tell of. An integer column has a partition per value."""
        if not self.exists(table):
            return None
        if self.is_path:
            if not self._has_partition_directories(table):
                return None
            names = [n for n in self._files.names(self.path(table)) if "=" in n]
            column = names[0].partition("=")[0]
        else:
            full = f"{self.name}.{table}"
            listed = [c.name for c in self.spark.catalog.listColumns(full) if c.isPartition]
            if not listed:
                return None
            column = listed[0]
            shown = self.spark.sql(f"SHOW PARTITIONS {full}").collect()
            names = [row[0].partition("/")[0] for row in shown]
        kind = self.read(table).schema[column].dataType
        if isinstance(kind, (T.DateType, T.TimestampType, T.TimestampNTZType)):
            return TimePartition(column)
        if isinstance(kind, (T.IntegerType, T.LongType)):
            values = [name.partition("=")[2] for name in names if name.startswith(f"{column}=")]
            found = [int(value) for value in values if value.lstrip("-").isdigit()]
            if found:
                return RangePartition(column, min(found), max(found) + 1, 1)
        return None

    def partition_values(self, table: str, column: str) -> DataFrame | None:
        """The values of a partition column from the catalog's partitions or the directory
        names, no file opened; None when the table is not laid out by that column first."""
        if self.is_path:
            if not self._has_partition_directories(table):
                return None
            names = [n for n in self._files.names(self.path(table)) if n.startswith(f"{column}=")]
            shown = self.spark.createDataFrame([(name,) for name in names], "partition string")
        else:
            full = f"{self.name}.{table}"
            listed = [c.name for c in self.spark.catalog.listColumns(full) if c.isPartition]
            if not listed or listed[0] != column:
                return None
            shown = self.spark.sql(f"SHOW PARTITIONS {full}")
            names = [column]
        if not names:
            return None
        first = F.split("partition", "/")[0]
        text = F.regexp_replace(F.substr(first, F.lit(len(column) + 2)), "[+]", "%2B")
        value = F.when(F.endswith(first, F.lit(f"={_NULL_DIRECTORY}")), None).otherwise(F.url_decode(text))
        kind = self.read(table).schema[column].dataType
        return shown.select(value.cast(kind).alias(column)).distinct()

    def check_shards(self, tables: Sequence[str], schema: T.StructType) -> None:
        """Raise unless the footers of every table fit ``schema``.

        The footers of flat shards are merged by the executors in one job.
        """
        if self.is_path and not self._has_partition_directories(tables[0]):
            check_file_types(merging_scan(self.spark, [*map(self.path, tables)]).schema, schema)
            return
        for table in tables:
            check_file_types(self.read(table).schema, schema)

    def _has_partition_directories(self, table: str) -> bool:
        path = self.path(table)
        return self._files.is_dir(path) and any("=" in name for name in self._files.names(path))


def partition_counts(
    table: DataFrame, partition: TimePartition | RangePartition, ids: Sequence[str]
) -> dict[str, int]:
    """Rows per partition id, in one pass over the partition column of those ids.

    ``table`` may be just the values of the partition column, known from metadata: then
    partitions are counted, and nothing of the table is scanned.

    Rows are grouped by the finest unit among the ids; a coarser time id is a prefix
    of the finer ones it holds.
    """
    key, label = partition.group(ids)
    counted = (
        table.where(partition_condition(partition, ids))
        .groupBy(key.alias("key"))
        .agg(F.count("*").alias("n"))
        .select(F.coalesce(label, F.lit(NULL_PARTITION)).alias("id"), "n")
        .collect()
    )
    total: Counter[str] = Counter()
    for row in counted:
        for name in (row["id"], *partition.containers(row["id"])):
            total[name] += row["n"]
    return {name: total[name] for name in ids}


def read_partitions(
    table: DataFrame, partition: TimePartition | RangePartition, ids: Sequence[str]
) -> DataFrame:
    """Rows of the given partitions; ids that overlap yield their rows once per id."""
    layers = disjoint_layers(ids, partition.containers)
    scans = [table.where(partition_condition(partition, layer)) for layer in layers]
    return reduce(DataFrame.unionAll, scans)


@dataclass
class _Slices:
    """The slices of a source that exist, out of ``planned`` ones."""

    planned: int
    labels: list[str]
    stored: T.StructType | None = None
    rows: Callable[[], DataFrame] | None = None
    export: Callable[[str, str, str], list[str]] | None = None
    check: Callable[[T.StructType], None] = lambda schema: None


def _partition_slices(
    dataset: Dataset,
    source: TableSource,
    partition: TimePartition | RangePartition,
    ids: Sequence[str],
) -> _Slices:
    if not dataset.exists(source.table):
        return _Slices(len(ids), [])
    table = dataset.read(source.table)
    known = dataset.partition_values(source.table, partition.column)
    counts = partition_counts(table if known is None else known, partition, ids)
    found = [name for name in ids if counts[name]]
    return _Slices(
        len(ids),
        [f"{source.table}${name}" for name in found],
        table.schema,
        rows=lambda: read_partitions(by_directory(table), partition, found),
        export=partial(export_partitions, table, partition, found),
    )


def _table_slices(
    dataset: Dataset, source: TableSource, kind: str, suffixes: Sequence[str]
) -> _Slices:
    if kind == TABLE_SUFFIX:
        names = [source.table[:-1] + suffix for suffix in suffixes]
    elif is_wildcard(source.table):
        names = dataset.tables(source.table[:-1])
    else:
        names = [source.table]
    found = [name for name in names if dataset.exists(name)]
    if not found:
        return _Slices(len(names), [])
    stored = dataset.read(found[0]).schema
    fitted = normalise_inferred(stored)
    return _Slices(
        len(names),
        found,
        stored,
        rows=lambda: dataset.read_shards(found, sliced=True),
        export=lambda *to: export_slices([dataset.read(n).to(fitted) for n in found], *to),
        check=lambda schema: dataset.check_shards(found, schema),
    )


def plan_table(context: SourceContext, source: TableSource) -> SourcePlan:
    dataset = Dataset(context.engine, source.dataset)
    predicates = slices_for(source, context.mode)

    @cache
    def partition() -> TimePartition | RangePartition | None:
        """As declared, else as the table itself tells."""
        return source.partition or dataset.partition(source.table)

    kind = resolve_table_predicates(
        source.predicate_type, source.table, predicates, lambda: partition() is not None
    )
    if kind == PARTITION_DECORATOR:
        slices = _partition_slices(dataset, source, partition(), predicates)
    else:
        slices = _table_slices(dataset, source, kind, predicates)
    missing = slices.planned - len(slices.labels)
    if missing and not source.skip_missing:
        raise SourceError(f"{missing} of {slices.planned} planned tables or partitions not found")
    if not slices.labels:
        reason = "no table or partition matched the plan"
        if source.skip_missing:
            return SourcePlan(skip_reason=reason)
        raise SourceError(reason)

    if context.declared is not None:
        schema = context.declared
    elif source.schema_fields is not None:
        schema = map_source_schema(source.schema_fields)
    else:
        schema = normalise_inferred(slices.stored)
    segments = [{"table": label} for label in slices.labels]
    jobs = []
    if source.export_location:
        if source.schema_fields is None:
            slices.check(schema)
        paths = slices.export(source.export_location, context.run_id, source.compression)
        segments = [{"table": label, "path": path} for label, path in zip(slices.labels, paths)]
        jobs = [{"operation": "export", "path": path} for path in paths]

    def rows() -> DataFrame:
        frame = slices.rows()
        if source.export_location:
            exported = read_export(frame.drop(SLICE), source.export_location, context.run_id)
            frame = by_directory(exported)
        if source.schema_fields is not None:
            return convert(frame, _without_expressions(schema))
        slices.check(schema)
        check_file_types(frame.schema, schema)
        return frame

    return SourcePlan(schema=schema, rows=rows, segments=segments, job_references=jobs)


def _without_expressions(schema: T.StructType) -> T.StructType:
    """Expressions of table sources belong to the view, not to the load."""
    return T.StructType([T.StructField(f.name, f.dataType, f.nullable) for f in schema.fields])


register_source(TableSource, plan_table)
