"""Scans: prefixes, listings, shards, partitions, SQL, export."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.views import read_table, read_view
from ..plans.slices import RangePartition, TimePartition
from ..session import engine_session, scratch_dir
from ..sources.export import export_slices
from ..sources.listing import normalise_suffix
from ..sources.prefix import Prefix
from ..spec import PrefixSource, SqlSource, SyncSpec, TableSource
from ..sync import sync
from .layout import aged_lake, lake, shards, table, two_schemas, write_partitioned


def prefix_scan(*suffixes: str, pattern: str | None = None):
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        prefix = Prefix(engine_session(spark), lake(spark, sf_dir), suffixes or ("",), pattern)
        return prefix.read(prefix.infer_schema())

    return query


ROLLUP_SUFFIXES = ("", "year=1996", "year=1996/month=1", "year=1996/month=12", "year=2030")


def segments_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whether each segment counts as many files as it has: how many files hold a month is
    up to the writer, so the months are returned."""
    prefix = Prefix(engine_session(spark), lake(spark, sf_dir), ROLLUP_SUFFIXES)
    found = prefix.files().groupBy("path_suffix").agg(
        F.countDistinct(F.regexp_extract("rel", r"^(.*)/[^/]*$", 1)).alias("months"),
        F.count("*").alias("files"),
    )
    return prefix.rollup().join(found, "path_suffix", "left").select(
        "path_suffix",
        F.coalesce("months", F.lit(0)).alias("months"),
        (F.col("file_count") == F.coalesce("files", F.lit(0))).alias("all_counted"),
    )


def segment_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Directories of the matched files."""
    prefix = Prefix(engine_session(spark), lake(spark, sf_dir), ("year=1996", "year=1997/month=1"))
    return prefix.files().select(
        "path_suffix", F.regexp_extract("rel", r"^(.*)/[^/]*$", 1).alias("directory")
    ).distinct()


def newest_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Times differ from run to run, so the ranking is returned as facts about it."""
    prefix = Prefix(engine_session(spark), lake(spark, sf_dir))
    newest = prefix.newest(16).select("rel", F.lit(True).alias("chosen"))
    ranked = prefix.files().join(newest, "rel", "left")
    rank = F.struct("modificationTime", "rel")
    return ranked.agg(
        F.count("chosen").alias("chosen"),
        (F.count("*") > 16).alias("some_left"),
        (
            F.min(F.when(F.col("chosen"), rank)) > F.max(F.when(F.col("chosen").isNull(), rank))
        ).alias("all_newer"),
    )


def infer_capped_schema(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The inferred columns, with the values each holds over the whole prefix."""
    prefix = Prefix(engine_session(spark), lake(spark, sf_dir))
    schema = prefix.infer_schema()
    counts = prefix.read(schema).agg(*(F.count(name).alias(name) for name in schema.names))
    described = F.explode(
        F.array(
            *(
                F.struct(
                    F.lit(ordinal).cast("bigint").alias("ordinal"),
                    F.lit(field.name).alias("column_name"),
                    F.lit(field.dataType.simpleString()).alias("data_type"),
                    F.col(field.name).alias("value_count"),
                )
                for ordinal, field in enumerate(schema.fields)
            )
        )
    )
    return counts.select(described.alias("c")).select("c.*")


def synced_table(spark: SparkSession, label: str, source) -> DataFrame:
    """Full refresh of a new managed table from a source."""
    spec = SyncSpec(
        target=label,
        location=scratch_dir(spark, label),
        source=source,
        strategy="full_refresh",
        incremental_predicate="true" if source.is_sliced else None,
    )
    sync(spark, spec)
    return read_table(spark, spec.location)


def shard_scan(*suffixes: str, skip_missing: bool = False):
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        source = TableSource(
            shards(spark, sf_dir),
            "events_*",
            full_refresh_predicates=suffixes,
            skip_missing=skip_missing,
        )
        return synced_table(spark, "shards", source)

    return query


def concrete_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return synced_table(spark, "supplier", TableSource(sf_dir, "supplier"))


def time_partitions(*ids: str):
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        source = TableSource(
            sf_dir, "events", partition=TimePartition("ts"), full_refresh_predicates=ids
        )
        return synced_table(spark, "partitions", source)

    return query


def partition_int_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    source = TableSource(
        sf_dir,
        "customer",
        partition=RangePartition("c_nationkey", 0, 25, 5),
        full_refresh_predicates=("5", "20"),
    )
    return synced_table(spark, "ranges", source)


def partition_pruned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every range of a table laid out by the partition column itself."""
    location = f"{scratch_dir(spark, 'laid-out')}/nation_customers"
    customers = table(spark, sf_dir, "customer")
    write_partitioned(customers, location, "c_nationkey")
    source = TableSource(
        location.rpartition("/")[0],
        "nation_customers",
        partition=RangePartition("c_nationkey", 0, 25, 5),
        full_refresh_predicates=("0", "5", "10", "15", "20"),
    )
    return synced_table(spark, "pruned", source)


def partition_auto(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Days of a table that nobody declared as partitioned: its directories tell."""
    location = f"{scratch_dir(spark, 'auto')}/daily"
    events = table(spark, sf_dir, "events").withColumn("day", F.to_date("ts"))
    write_partitioned(events, location, "day")
    source = TableSource(
        location.rpartition("/")[0],
        "daily",
        predicate_type="auto",
        full_refresh_predicates=("20240105", "20240107"),
    )
    return synced_table(spark, "auto", source)


MAPPED_FIELDS = (
    {"name": "event_id", "type": "INT64", "mode": "REQUIRED"},
    {"name": "ts", "type": "TIMESTAMP"},
    {"name": "user_id", "type": "INTEGER"},
    {"name": "event_type", "type": "STRING"},
    {"name": "value", "type": "NUMERIC"},
    {"name": "props", "type": "STRING"},
)


def type_mapping(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``events`` loaded under a mapped source schema, with the type each column got."""
    source = TableSource(sf_dir, "events", schema_fields=MAPPED_FIELDS)
    loaded = synced_table(spark, "mapped", source)
    types = ",".join(kind for _, kind in loaded.dtypes)
    return loaded.withColumns(
        {"value": F.col("value").cast("double"), "loaded_types": F.lit(types)}
    )


# --- SQL ----------------------------------------------------------------------


def _join_sql(sf_dir: str) -> str:
    return f"""
        SELECT c.c_mktsegment AS segment, year(o.o_orderdate) AS order_year,
               count(*) AS order_count,
               CAST(sum(CAST(o.o_totalprice AS DECIMAL(18, 2))) AS DECIMAL(38, 2)) AS revenue
        FROM parquet.`{sf_dir}/orders.parquet` o
        JOIN parquet.`{sf_dir}/customer.parquet` c ON o.o_custkey = c.c_custkey
        GROUP BY 1, 2;
    """


def select_join_agg(spark: SparkSession, sf_dir: str) -> DataFrame:
    source = SqlSource(_join_sql(sf_dir), scratch_dir(spark, "staging"))
    joined = synced_table(spark, "join_agg", source)
    return joined.withColumn("revenue", F.col("revenue").cast("double"))


def select_where_or(spark: SparkSession, sf_dir: str) -> DataFrame:
    source = SqlSource(
        f"SELECT * FROM parquet.`{sf_dir}/orders.parquet`",
        scratch_dir(spark, "staging"),
        full_refresh_predicates=("o_orderstatus = 'F'", "o_totalprice > 400000"),
    )
    return synced_table(spark, "where_or", source)


def staged(force_rebuild: bool):
    """Sync, add every customer's order counts to the source, sync again."""

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        root = scratch_dir(spark, "staged")
        orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus")
        orders.write.parquet(f"{root}/source")
        spec = SyncSpec(
            target="staged",
            location=f"{root}/table",
            source=SqlSource(
                f"SELECT o_orderstatus, count(*) AS order_count FROM parquet.`{root}/source` "
                "GROUP BY o_orderstatus",
                f"{root}/staging",
                force_rebuild=force_rebuild,
            ),
        )
        first = sync(spark, spec)
        orders.write.mode("append").parquet(f"{root}/source")
        second = sync(spark, spec)
        queries = [
            sum(job["operation"] == "query" for job in result.job_references)
            for result in (first, second)
        ]
        counts = read_view(spark, spec.location)
        return counts.withColumn("query_runs", F.lit(sum(queries)).cast("bigint"))

    return query


def export_codecs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two slices of ``orders`` exported with each codec, counted per slice."""
    engine = engine_session(spark)
    location = scratch_dir(spark, "export")
    orders = table(engine, sf_dir, "orders")
    cut = F.lit("1998-01-01")
    slices = [orders.where(F.col("o_orderdate") < cut), orders.where(F.col("o_orderdate") >= cut)]
    counts = []
    for codec in ("NONE", "SNAPPY", "GZIP", "ZSTD"):
        export_slices(slices, location, codec, codec)
        exported = engine.read.parquet(f"{location}/{codec}")
        counts.append(
            exported.groupBy(F.col("segment").cast("bigint").alias("segment"))
            .agg(F.count("*").alias("row_count"))
            .withColumn("codec", F.lit(codec))
        )
    return reduce(DataFrame.unionByName, counts)


def exported_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shards that go through a Parquet export before they are loaded."""
    source = TableSource(
        shards(spark, sf_dir),
        "events_*",
        full_refresh_predicates=("20240103", "20240104"),
        export_location=scratch_dir(spark, "export"),
        compression="GZIP",
    )
    return synced_table(spark, "exported", source)


def exported_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A month and a day in it go through one export, from one scan."""
    source = TableSource(
        sf_dir,
        "events",
        partition=TimePartition("ts"),
        full_refresh_predicates=("202401", "20240105"),
        export_location=scratch_dir(spark, "export"),
    )
    return synced_table(spark, "exported_partitions", source)


def infer_all_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A column that only the oldest of many files has."""
    return synced_table(spark, "aged", PrefixSource(aged_lake(spark, sf_dir)))


def table_dir_two_schemas(spark: SparkSession, sf_dir: str) -> DataFrame:
    source = TableSource(f"{two_schemas(spark, sf_dir)}/suppliers", "t")
    return synced_table(spark, "two_schemas", source)


def shards_first_schema(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Later shards lose what the first lacks and read as NULL what they lack."""
    source = TableSource(f"{two_schemas(spark, sf_dir)}/days", "events_*")
    return synced_table(spark, "first_schema", source)


def select_where_quoted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One quoted predicate selects the source's slice and the table's rows to delete."""
    quoted = "\"o_orderstatus\" = 'F'"

    def spec(price: str, location: str, staging: str) -> SyncSpec:
        source = SqlSource(
            f"SELECT o_orderkey, o_orderstatus, {price} AS o_totalprice "
            f"FROM parquet.`{sf_dir}/orders.parquet`",
            staging,
            incremental_predicates=(quoted,),
        )
        return SyncSpec(
            target="quoted", location=location, source=source, incremental_predicate=quoted
        )

    location, staging = scratch_dir(spark, "quoted"), scratch_dir(spark, "staging")
    sync(spark, spec("o_totalprice", location, staging))
    sync(spark, spec("o_totalprice + 1", location, staging))
    return read_table(spark, location)


def normalise_suffixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    padded = F.concat(F.lit(" //"), F.col("url"), F.lit("/ "))
    return pages.select("page_id", normalise_suffix(padded).alias("suffix"))


QUERIES = {
    "scan_prefix_all": prefix_scan(),
    "scan_month_sibling_guard": prefix_scan("year=1996/month=1"),
    "scan_two_suffixes": prefix_scan("year=1996/month=1", "year=1997/month=12"),
    "scan_overlapping_suffixes": prefix_scan("year=1996", "year=1996/month=1"),
    "scan_repeated_suffix": prefix_scan("year=1996", "year=1996"),
    "scan_regex": prefix_scan(pattern="month=1[0-2]/"),
    "scan_regex_per_segment": prefix_scan("year=1996", "", pattern="^month=1/"),
    "segments_rollup": segments_rollup,
    "segment_files": segment_files,
    "newest_files": newest_files,
    "infer_capped_schema": infer_capped_schema,
    "shards_all": shard_scan(),
    "shards_suffix": shard_scan("20240101", "20240115"),
    "shards_skip_missing": shard_scan("20240102", "20230102", skip_missing=True),
    "concrete_table": concrete_table,
    "partition_day": time_partitions("20240105"),
    "partition_month": time_partitions("202401"),
    "partition_hours": time_partitions("2024010510", "2024010511"),
    "partition_overlapping": time_partitions("202401", "20240105"),
    "partition_int_range": partition_int_range,
    "partition_pruned": partition_pruned,
    "type_mapping": type_mapping,
    "select_join_agg": select_join_agg,
    "select_where_or": select_where_or,
    "staging_reuse": staged(force_rebuild=False),
    "staging_rebuild": staged(force_rebuild=True),
    "export_codecs": export_codecs,
    "exported_shards": exported_shards,
    "normalise_suffixes": normalise_suffixes,
    "partition_auto": partition_auto,
    "exported_partitions": exported_partitions,
    "infer_all_files": infer_all_files,
    "table_dir_two_schemas": table_dir_two_schemas,
    "shards_first_schema": shards_first_schema,
    "select_where_quoted": select_where_quoted,
}

_MONTH = "year(o_orderdate) = {} AND month(o_orderdate) = {}"
_FILES = (
    "SELECT count(DISTINCT (year(o_orderdate), month(o_orderdate))) AS n FROM orders WHERE {}"
)

ORACLE = {
    "scan_prefix_all": "SELECT * FROM orders",
    "scan_month_sibling_guard": f"SELECT * FROM orders WHERE {_MONTH.format(1996, 1)}",
    "scan_two_suffixes": (
        f"SELECT * FROM orders WHERE {_MONTH.format(1996, 1)} "
        f"UNION ALL SELECT * FROM orders WHERE {_MONTH.format(1997, 12)}"
    ),
    "scan_overlapping_suffixes": (
        "SELECT * FROM orders WHERE year(o_orderdate) = 1996 "
        f"UNION ALL SELECT * FROM orders WHERE {_MONTH.format(1996, 1)}"
    ),
    "scan_repeated_suffix": (
        "SELECT * FROM orders WHERE year(o_orderdate) = 1996 "
        "UNION ALL SELECT * FROM orders WHERE year(o_orderdate) = 1996"
    ),
    "scan_regex": "SELECT * FROM orders WHERE month(o_orderdate) >= 10",
    "scan_regex_per_segment": f"SELECT * FROM orders WHERE {_MONTH.format(1996, 1)}",
    "segments_rollup": " UNION ALL ".join(
        f"SELECT '{suffix}' AS path_suffix, n AS months, true AS all_counted "
        f"FROM ({_FILES.format(condition)})"
        for suffix, condition in zip(
            ROLLUP_SUFFIXES,
            (
                "true",
                "year(o_orderdate) = 1996",
                _MONTH.format(1996, 1),
                _MONTH.format(1996, 12),
                "year(o_orderdate) = 2030",
            ),
        )
    ),
    "segment_files": (
        "SELECT DISTINCT 'year=1996' AS path_suffix, "
        "'year=1996/month=' || month(o_orderdate) AS directory "
        "FROM orders WHERE year(o_orderdate) = 1996 UNION ALL "
        "SELECT DISTINCT 'year=1997/month=1', 'year=1997/month=1' FROM orders "
        f"WHERE {_MONTH.format(1997, 1)}"
    ),
    "newest_files": (
        "SELECT CAST(16 AS BIGINT) AS chosen, n > 16 AS some_left, true AS all_newer "
        f"FROM ({_FILES.format('true')})"
    ),
    "infer_capped_schema": " UNION ALL ".join(
        f"SELECT CAST({ordinal} AS BIGINT) AS ordinal, '{name}' AS column_name, "
        f"'{kind}' AS data_type, count({name}) AS value_count FROM orders"
        for ordinal, (name, kind) in enumerate(
            (
                ("o_orderkey", "bigint"),
                ("o_custkey", "bigint"),
                ("o_orderstatus", "string"),
                ("o_totalprice", "double"),
                ("o_orderdate", "timestamp_ntz"),
                ("o_orderpriority", "string"),
            )
        )
    ),
    "shards_all": "SELECT * FROM events",
    "shards_suffix": (
        "SELECT * FROM events WHERE CAST(ts AS DATE) IN (DATE '2024-01-01', DATE '2024-01-15')"
    ),
    "shards_skip_missing": "SELECT * FROM events WHERE CAST(ts AS DATE) = DATE '2024-01-02'",
    "concrete_table": "SELECT * FROM supplier",
    "partition_day": "SELECT * FROM events WHERE CAST(ts AS DATE) = DATE '2024-01-05'",
    "partition_month": "SELECT * FROM events WHERE year(ts) = 2024 AND month(ts) = 1",
    "partition_hours": (
        "SELECT * FROM events WHERE CAST(ts AS DATE) = DATE '2024-01-05' AND hour(ts) IN (10, 11)"
    ),
    "partition_overlapping": (
        "SELECT * FROM events WHERE year(ts) = 2024 AND month(ts) = 1 "
        "UNION ALL SELECT * FROM events WHERE CAST(ts AS DATE) = DATE '2024-01-05'"
    ),
    "partition_int_range": (
        "SELECT * FROM customer WHERE c_nationkey BETWEEN 5 AND 9 OR c_nationkey BETWEEN 20 AND 24"
    ),
    "partition_pruned": "SELECT * FROM customer",
    "type_mapping": (
        "SELECT event_id, ts, user_id, event_type, "
        "CAST(CAST(value AS DECIMAL(38, 9)) AS DOUBLE) AS value, props, "
        "'bigint,timestamp_ntz,bigint,string,decimal(38,9),string' AS loaded_types FROM events"
    ),
    "select_join_agg": (
        "SELECT c_mktsegment AS segment, CAST(year(o_orderdate) AS INTEGER) AS order_year, "
        "count(*) AS order_count, "
        "CAST(sum(CAST(o_totalprice AS DECIMAL(18, 2))) AS DOUBLE) AS revenue "
        "FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1, 2"
    ),
    "select_where_or": (
        "SELECT * FROM orders WHERE o_orderstatus = 'F' OR o_totalprice > 400000"
    ),
    "staging_reuse": (
        "SELECT o_orderstatus, count(*) AS order_count, CAST(1 AS BIGINT) AS query_runs "
        "FROM orders GROUP BY o_orderstatus"
    ),
    "staging_rebuild": (
        "SELECT o_orderstatus, 2 * count(*) AS order_count, CAST(2 AS BIGINT) AS query_runs "
        "FROM orders GROUP BY o_orderstatus"
    ),
    "export_codecs": (
        "SELECT codec, segment, row_count FROM (SELECT CAST(o_orderdate >= DATE '1998-01-01' "
        "AS BIGINT) AS segment, count(*) AS row_count FROM orders GROUP BY 1) "
        "CROSS JOIN (VALUES ('NONE'), ('SNAPPY'), ('GZIP'), ('ZSTD')) codecs(codec)"
    ),
    "exported_shards": (
        "SELECT * FROM events WHERE CAST(ts AS DATE) IN (DATE '2024-01-03', DATE '2024-01-04')"
    ),
    "normalise_suffixes": "SELECT page_id, trim(url, '/') AS suffix FROM pages",
    "partition_auto": (
        "SELECT *, CAST(ts AS DATE) AS day FROM events "
        "WHERE CAST(ts AS DATE) IN (DATE '2024-01-05', DATE '2024-01-07')"
    ),
    "exported_partitions": (
        "SELECT * FROM events WHERE year(ts) = 2024 AND month(ts) = 1 "
        "UNION ALL SELECT * FROM events WHERE CAST(ts AS DATE) = DATE '2024-01-05'"
    ),
    "infer_all_files": (
        f"SELECT *, CASE WHEN {_MONTH.format(1995, 1)} THEN upper(o_orderpriority) END AS legacy "
        "FROM orders"
    ),
    "table_dir_two_schemas": (
        "SELECT *, CASE WHEN s_suppkey % 2 = 1 THEN s_acctbal * 2 END AS s_double FROM supplier"
    ),
    "shards_first_schema": (
        "SELECT event_id, ts, event_type, CASE WHEN CAST(ts AS DATE) = DATE '2024-01-01' "
        "THEN user_id END AS user_id FROM events WHERE CAST(ts AS DATE) >= DATE '2024-01-01'"
    ),
    "select_where_quoted": (
        "SELECT o_orderkey, o_orderstatus, CASE WHEN o_orderstatus = 'F' THEN o_totalprice + 1 "
        "ELSE o_totalprice END AS o_totalprice FROM orders"
    ),
}
