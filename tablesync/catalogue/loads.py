"""Loads: delete+copy, views, expressions, evolution, retention."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import replace

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..errors import TableSyncError
from ..operators.load import delete_and_copy
from ..operators.store import ManagedTable
from ..operators.views import read_table, read_view
from ..plans.evolution import check_compatible
from ..plans.types import map_declared_columns
from ..session import engine_session, scratch_dir
from ..sources.base import SourceContext, SourcePlan, register_source
from ..spec import ColumnSpec, PrefixSource, SyncSpec, TableSource
from ..sync import evolve, plan, sync
from .layout import eras, lake, once, revised_lake, table

JANUARY = "\"o_orderdate\" >= '1996-01-01' AND \"o_orderdate\" < '1996-02-01'"


def lake_spec(spark: SparkSession, sf_dir: str, label: str, **changes) -> SyncSpec:
    """``orders`` followed month by month; one incremental run replaces 1996-01."""
    source = changes.pop(
        "source", PrefixSource(lake(spark, sf_dir), incremental_paths=("year=1996/month=1",))
    )
    values = {
        "target": label,
        "location": scratch_dir(spark, label),
        "source": source,
        "incremental_predicate": JANUARY,
    }
    return SyncSpec(**(values | changes))


def delete_copy(incremental_runs: int):
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        spec = lake_spec(spark, sf_dir, "delete_copy")
        sync(spark, spec)
        # The source is corrected before the incremental runs, which load one month of it.
        source = PrefixSource(revised_lake(spark, sf_dir), incremental_paths=("year=1996/month=1",))
        later = lake_spec(spark, sf_dir, "delete_copy", source=source, location=spec.location)
        for _ in range(incremental_runs):
            sync(spark, later)
        return read_table(spark, spec.location)

    return query


def delete_copy_other_slice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The slice that is copied holds other rows than the window that is deleted, so
    both halves of the operation show in the result."""
    source = PrefixSource(lake(spark, sf_dir), incremental_paths=("year=1997/month=2",))
    spec = lake_spec(spark, sf_dir, "other_slice", source=source)
    sync(spark, spec)
    sync(spark, spec)
    return read_table(spark, spec.location)


def delete_copy_algebra(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same run as one lazy plan over the whole table."""
    engine = engine_session(spark)
    orders = table(engine, sf_dir, "orders")
    incoming = orders.where("year(o_orderdate) = 1997 AND month(o_orderdate) = 2")
    return delete_and_copy(orders, JANUARY, incoming)


def delete_keeps_null_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows whose predicate is NULL survive the delete."""

    def write(location: str) -> None:
        orders = table(spark, sf_dir, "orders")
        price = F.when(F.col("o_orderstatus") != "P", F.col("o_totalprice"))
        nulled = orders.withColumn("o_totalprice", price)
        nulled.write.parquet(f"{location}/all")
        nulled.where("o_totalprice > 450000").write.parquet(f"{location}/high")

    location = once(spark, sf_dir, "nulled", write)
    spec = SyncSpec(
        target="nulls",
        location=scratch_dir(spark, "nulls"),
        source=PrefixSource(location, full_refresh_paths=("all",), incremental_paths=("high",)),
        incremental_predicate='"o_totalprice" > 300000',
    )
    sync(spark, spec)
    sync(spark, spec)
    return read_table(spark, spec.location)


def delete_all_when_unpaired(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Without slices and predicate, an incremental run replaces everything."""
    spec = lake_spec(
        spark, sf_dir, "unpaired", source=PrefixSource(lake(spark, sf_dir)),
        incremental_predicate=None,
    )
    sync(spark, spec)
    other = PrefixSource(f"{revised_lake(spark, sf_dir)}/year=1996")
    later = lake_spec(
        spark, sf_dir, "unpaired", source=other, incremental_predicate=None,
        location=spec.location,
    )
    sync(spark, later)
    return read_table(spark, spec.location)


def full_refresh_slices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A full refresh with a slice list deletes everything and loads only the slices."""
    every = lake_spec(spark, sf_dir, "sliced")
    sync(spark, every)
    slices = PrefixSource(
        lake(spark, sf_dir),
        full_refresh_paths=("year=1996", "year=1997"),
        incremental_paths=("year=1996/month=1",),
    )
    some = lake_spec(
        spark, sf_dir, "sliced", source=slices, location=every.location, full_refresh=True
    )
    sync(spark, some)
    return read_table(spark, every.location)


def affected_file_rewrite(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two overlapping deletes, by month slices: the first empties a slice, the second, which
    cuts across slices, rewrites the one it touches in part and drops the others."""
    spec = lake_spec(
        spark, sf_dir, "affected", slice_by="date_trunc('month', \"o_orderdate\")",
        source=PrefixSource(lake(spark, sf_dir), incremental_paths=("year=1996/month=1",)),
    )
    sync(spark, spec)
    nothing = once(
        spark, sf_dir, "no-orders",
        lambda to: table(spark, sf_dir, "orders").where("o_orderkey < 0").write.parquet(f"{to}/none"),
    )
    for predicate in (JANUARY, "year(\"o_orderdate\") = 1996"):
        empty = PrefixSource(nothing, incremental_paths=("none",))
        sync(spark, replace(spec, source=empty, incremental_predicate=predicate))
    return read_table(spark, spec.location)


def time_travel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Who reads the table while it is replaced has the rows from before: a frame that was
    opened first does not change."""
    spec = lake_spec(spark, sf_dir, "travel")
    sync(spark, spec)
    before = read_table(spark, spec.location)
    source = PrefixSource(lake(spark, sf_dir), full_refresh_paths=("year=1995",))
    sync(
        spark,
        SyncSpec(target="travel", location=spec.location, source=source, strategy="full_refresh"),
    )
    return before


def expired_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The head after what only earlier records named is gone."""
    spec = lake_spec(spark, sf_dir, "expired")
    for _ in range(3):
        sync(spark, spec)
    managed = ManagedTable(engine_session(spark), spec.location)
    managed.expire(retention_days=0)
    versions = len(managed.version_numbers())
    return managed.read().withColumn("versions", F.lit(versions).cast("bigint"))


class Contested:
    """Orders from a directory; while they are read, another run publishes first, once."""

    kind = "contested"
    full_refresh_slices = incremental_slices = ()

    def __init__(self, path: str, location: str):
        self.path, self.location, self.races = path, location, 1


def _plan_contested(context: SourceContext, source: Contested) -> SourcePlan:
    frame = context.engine.read.option("recursiveFileLookup", True).parquet(source.path)

    def rows() -> DataFrame:
        if source.races:
            source.races = 0
            managed = ManagedTable(context.engine, source.location)
            managed.publish(managed.head(), managed.head().schema, managed.head().parts, "other")
        return frame

    return SourcePlan(schema=frame.schema, rows=rows)


def retry_after_conflict(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A run that loses the race to publish computes against the new head and publishes after."""
    register_source(Contested, _plan_contested)
    location = scratch_dir(spark, "contested")
    source = Contested(lake(spark, sf_dir), location)
    spec = SyncSpec(target="contested", location=location, source=source)
    result = sync(spark, spec, sleep=lambda seconds: None)
    log = (F.lit(result.retry["attempts"]), F.lit(len(result.retry["retryable_errors"])), F.lit(result.version))
    names = ("attempts", "conflicts", "version")
    rows = read_table(spark, location)
    return rows.withColumns({n: c.cast("bigint") for n, c in zip(names, log)})


def failed_first_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A first run that fails leaves no table behind; the next one, corrected, is a first run."""
    dropped = F.lit(False)
    bad = (ColumnSpec("o_orderkey", "bigint"), ColumnSpec("o_custkey", "bigint", expression="no_such(1)"))
    spec = lake_spec(spark, sf_dir, "first_run", columns=bad)
    try:
        sync(spark, spec)
    except AnalysisException:
        managed = ManagedTable(engine_session(spark), spec.location)
        dropped = F.lit(not managed.exists())
    good = replace(spec, columns=bad[:1])
    mode = sync(spark, good).effective_mode
    rows = read_table(spark, spec.location)
    return rows.select("o_orderkey", dropped.alias("dropped"), F.lit(mode).alias("mode"))


def refusals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What planning refuses, by the kind of error, beside the rows the table keeps."""
    spec = lake_spec(spark, sf_dir, "refusing")
    sync(spark, spec)
    stored = read_table(spark, spec.location).schema
    key, twice = ColumnSpec("o_orderkey", "bigint"), ColumnSpec("OOrderkey", "bigint", alias="o_orderkey")
    narrower = stored.fields[0].name
    tries = {
        "alias_collision": lambda: sync(spark, replace(spec, columns=(key, twice))),
        "duplicate_name": lambda: map_declared_columns((key, key)),
        "predicate_type": lambda: plan(
            spark, replace(spec, source=TableSource(
                sf_dir, "orders", predicate_type="table_suffix", full_refresh_predicates=("x",),
                incremental_predicates=("x",),
            )),
        ),
        "unpaired_predicate": lambda: replace(spec, incremental_predicate=None),
        "incompatible_type": lambda: check_compatible(
            stored, T.StructType([T.StructField(narrower, T.StringType()), *stored.fields[1:]])
        ),
        "removed_column": lambda: check_compatible(stored, T.StructType(stored.fields[1:])),
    }
    found = []
    for rule, attempt in tries.items():
        try:
            attempt()
            found.append(f"{rule}=accepted")
        except TableSyncError as error:
            found.append(f"{rule}={type(error).__name__}")
    rows = read_table(spark, spec.location).agg(F.count("*").alias("table_rows"))
    pairs = rows.select("table_rows", F.explode(F.lit(found)).alias("pair"))
    return pairs.select(
        F.substring_index("pair", "=", 1).alias("rule"),
        F.substring_index("pair", "=", -1).alias("error"), "table_rows",
    )


# --- names, types, expressions --------------------------------------------------


def camel(orders: DataFrame) -> DataFrame:
    """Orders under mixed-case names, prices partly not numbers."""
    text = F.format_string("%.2f", "o_totalprice")
    return orders.select(
        F.col("o_orderkey").alias("OrderID"),
        F.col("o_custkey").alias("HTTPCustomerKey"),
        F.when(F.col("o_orderstatus") == "P", F.lit("pending")).otherwise(text).alias("AmountText"),
        F.col("o_orderdate").alias("2ndDate Value"),
    )


def camel_orders(spark: SparkSession, sf_dir: str) -> str:
    def write(location: str) -> None:
        camel(table(spark, sf_dir, "orders")).write.parquet(location)

    return once(spark, sf_dir, "camel", write)


def view_lower_snake(spark: SparkSession, sf_dir: str) -> DataFrame:
    source = PrefixSource(camel_orders(spark, sf_dir))
    spec = lake_spec(spark, sf_dir, "snake", source=source, incremental_predicate=None)
    sync(spark, spec)
    return read_view(spark, spec.location)


def view_catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The view in the catalog after an incremental run, as a session of its own reads it."""
    schema = f"tablesync_{uuid.uuid4().hex[:12]}"
    columns = (
        ColumnSpec("OrderID", "BIGINT"),
        ColumnSpec("HTTPCustomerKey", "BIGINT"),
        ColumnSpec("AmountText", "STRING", alias="amount", expression='try_cast("AmountText" AS DOUBLE)'),
        ColumnSpec("2ndDate Value", "timestamp_ntz", alias="order_date"),
    )
    location = camel_orders(spark, sf_dir)
    spec = lake_spec(
        spark, sf_dir, "sales.catalog_orders", columns=columns, catalog_schema=schema,
        source=PrefixSource(location, incremental_paths=("later",)),
        incremental_predicate='year("2ndDate Value") = 1996',
        slice_by='year("2ndDate Value")',
    )
    sync(spark, spec)
    opened = spark.newSession().table(f"{schema}.catalog_orders")
    rows = table(spark, sf_dir, "orders").where("year(o_orderdate) = 1996")
    later = once(
        spark, sf_dir, "camel-1996",
        lambda to: camel(rows.withColumn("o_custkey", F.col("o_custkey") + 1)).write.parquet(
            f"{to}/later"
        ),
    )
    sync(spark, replace(spec, source=PrefixSource(later, incremental_paths=("later",))))
    fresh = spark.newSession().table(f"{schema}.catalog_orders")
    # A reader that opened the view before the second run still has the table as it was.
    both = opened.select(F.lit("before").alias("opened"), "*")
    return both.unionByName(fresh.select(F.lit("after").alias("opened"), "*"))


def view_expression_try_cast(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tolerant casts computed by the view; the table keeps the text."""
    columns = (
        ColumnSpec("OrderID", "BIGINT", nullable=False),
        ColumnSpec(
            "AmountText", "VARCHAR", alias="amount", expression='try_cast("AmountText" AS DOUBLE)'
        ),
        ColumnSpec(
            "HTTPCustomerKey", "bigint", expression='CAST("HTTPCustomerKey" AS STRING)'
        ),
    )
    source = PrefixSource(camel_orders(spark, sf_dir))
    spec = lake_spec(
        spark, sf_dir, "try_cast", source=source, incremental_predicate=None, columns=columns
    )
    sync(spark, spec)
    return read_view(spark, spec.location)


def full_ingest_expression(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Expressions applied while loading, to the file's own fields."""
    columns = (
        ColumnSpec("OrderID", "NUMBER(38,0)"),
        ColumnSpec("amount", "DOUBLE", expression='try_cast($1:"AmountText" AS DOUBLE)'),
        ColumnSpec("2ndDate Value", "DATE", alias="order_date"),
        ColumnSpec("not_in_files", "BIGINT"),
    )
    source = PrefixSource(camel_orders(spark, sf_dir), load_mode="full_ingest")
    spec = lake_spec(
        spark, sf_dir, "ingest", source=source, incremental_predicate=None, columns=columns
    )
    sync(spark, spec)
    view = read_view(spark, spec.location)
    return view.withColumns(
        {
            "order_id": F.col("order_id").cast("bigint"),
            "order_date": F.col("order_date").cast("string"),
            "not_in_files": F.col("not_in_files").cast("double"),
            "loaded_types": F.lit(",".join(kind for _, kind in view.dtypes)),
        }
    )


def full_ingest_nested(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Structs and arrays of structs of text, converted to declared types while loading."""

    def write(location: str) -> None:
        key, text = F.col("o_orderkey"), F.col("o_custkey").cast("string")
        entry = F.struct(text.alias("cust"), F.col("o_orderstatus").alias("Status"))
        table(spark, sf_dir, "orders").select(
            key.alias("k"), entry.alias("one"), F.array(entry, entry).alias("many")
        ).write.parquet(location)

    columns = (
        ColumnSpec("k", "bigint"),
        ColumnSpec("one", "struct<status:string,cust:bigint,absent:int>"),
        ColumnSpec("many", "array<struct<cust:bigint>>"),
    )
    location = once(spark, sf_dir, "nested-text", write)
    spec = SyncSpec(
        target="nested_ingest",
        location=scratch_dir(spark, "nested_ingest"),
        source=PrefixSource(location, load_mode="full_ingest"),
        columns=columns,
    )
    sync(spark, spec)
    return read_table(spark, spec.location).select(
        "k", "one.status", "one.cust", "one.absent",
        F.element_at("many", 2)["cust"].alias("second"), F.size("many").alias("entries"),
    )


def load_by_name_case_sensitive(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A strict load into declared columns: wrong case reads as NULL, extra columns are
    dropped, order is the table's."""
    columns = (
        ColumnSpec("o_totalprice", "double"),
        ColumnSpec("O_ORDERPRIORITY", "string"),
        ColumnSpec("o_orderkey", "bigint"),
    )
    spec = lake_spec(spark, sf_dir, "strict", columns=columns)
    sync(spark, spec)
    loaded = read_table(spark, spec.location)
    return loaded.select("o_totalprice", F.col("O_ORDERPRIORITY").alias("wrong_case"), "o_orderkey")


def not_null_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """NOT NULL columns, checked in the pass that writes."""
    columns = tuple(
        ColumnSpec(name, kind, nullable=False)
        for name, kind in (("event_id", "bigint"), ("ts", "timestamp_ntz"), ("value", "double"))
    )

    def write(location: str) -> None:
        table(spark, sf_dir, "events").write.parquet(location)

    source = PrefixSource(once(spark, sf_dir, "events", write))
    spec = lake_spec(
        spark, sf_dir, "not_null", source=source, incremental_predicate=None, columns=columns
    )
    sync(spark, spec)
    return read_view(spark, spec.location)


# --- evolution ------------------------------------------------------------------

def evolved(
    name: str,
    old: Callable[[], list[Column]],
    new: Callable[[], list[Column]],
    flat: dict[str, str],
):
    """Load the older orders with one schema and the newer ones with the next, then
    read all of them under the evolved schema, flattened."""

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        location = eras(
            spark, sf_dir, name, [*_keys(), *old()], [*_keys(), *new()]
        )
        spec = SyncSpec(
            target=name,
            location=scratch_dir(spark, name),
            source=PrefixSource(
                location, full_refresh_paths=("era=old",), incremental_paths=("era=new",)
            ),
            incremental_predicate="\"o_orderdate\" >= '1998-01-01'",
        )
        sync(spark, spec)
        sync(spark, spec)
        return read_table(spark, spec.location).select(
            "o_orderkey", *(F.expr(text).alias(column) for column, text in flat.items())
        )

    return query


def _keys() -> list[Column]:
    return [F.col("o_orderkey"), F.col("o_orderdate")]


def _field(source: str, name: str, kind: str | None = None) -> Column:
    column = F.col(source)
    return (column.cast(kind) if kind else column).alias(name)


def _limit(value: str) -> Column:
    """A whole decimal: the given limit for some rows, the order's customer for others."""
    narrow = F.lit(value).cast("decimal(10,0)")
    own = F.col("o_custkey").cast("decimal(10,0)")
    return F.when(F.col("o_orderkey") % 7 == 0, narrow).when(F.col("o_orderkey") % 7 > 1, own)


def _wide(value: str) -> Column:
    own = F.col("o_custkey").cast("bigint")
    return F.when(F.col("o_orderkey") % 7 == 0, F.lit(value).cast("bigint")).otherwise(own)


def _alpha_beta() -> list[Column]:
    return [
        F.struct(_field("o_orderpriority", "alpha"), _field("o_custkey", "beta")).alias("payload")
    ]


EVOLUTIONS: dict[str, tuple] = {
    "evolve_add_column": (
        lambda: [_field("o_custkey", "CustKey")],
        lambda: [_field("o_custkey", "CustKey"), _field("o_orderstatus", "Status")],
        {"cust": "CustKey", "status": "Status"},
    ),
    "evolve_nested_add": (
        _alpha_beta,
        lambda: [
            F.struct(
                _field("o_orderpriority", "alpha"),
                _field("o_custkey", "beta"),
                _field("o_orderstatus", "gamma"),
            ).alias("payload")
        ],
        {"alpha": "payload.alpha", "beta": "payload.beta", "gamma": "payload.gamma"},
    ),
    "evolve_nested_reorder": (
        _alpha_beta,
        lambda: [
            F.struct(_field("o_custkey", "beta"), _field("o_orderpriority", "alpha")).alias(
                "payload"
            )
        ],
        {"alpha": "payload.alpha", "beta": "payload.beta"},
    ),
    "evolve_nested_widen": (
        lambda: [
            F.struct(
                _field("o_custkey", "item_count", "int"),
                _field("o_totalprice", "price", "decimal(12,2)"),
            ).alias("payload")
        ],
        lambda: [
            F.struct(
                _field("o_custkey", "item_count", "bigint"),
                _field("o_totalprice", "price", "decimal(20,2)"),
            ).alias("payload")
        ],
        {"item_count": "payload.item_count", "price": "CAST(payload.price AS DOUBLE)"},
    ),
    # Values at the limits of the narrower type; the newer files exceed them.
    "evolve_nested_decimal": (
        lambda: [
            F.struct(
                _limit("9999999999").alias("code"),
                F.array(F.struct(_limit("-9999999999").alias("n"))).alias("parts"),
            ).alias("payload")
        ],
        lambda: [
            F.struct(
                _wide("9223372036854775807").alias("code"),
                F.array(F.struct(_wide("-9223372036854775808").alias("n"))).alias("parts"),
            ).alias("payload")
        ],
        {"code": "payload.code", "n": "payload.parts[0].n"},
    ),
    "evolve_nested_keep_missing": (
        _alpha_beta,
        lambda: [F.struct(_field("o_orderpriority", "alpha")).alias("payload")],
        {"alpha": "payload.alpha", "beta": "CAST(payload.beta AS STRING)"},
    ),
    "evolve_nested_deep": (
        lambda: [F.struct(F.struct(_field("o_custkey", "inner_a")).alias("outer")).alias("p")],
        lambda: [
            F.struct(
                F.struct(
                    _field("o_custkey", "inner_a"), _field("o_orderstatus", "inner_b")
                ).alias("outer")
            ).alias("p")
        ],
        {"inner_a": "p.outer.inner_a", "inner_b": "p.outer.inner_b"},
    ),
    "evolve_nested_array_struct": (
        lambda: [
            F.array(
                F.struct(_field("o_orderpriority", "sku")), F.struct(_field("o_orderstatus", "sku"))
            ).alias("items")
        ],
        lambda: [
            F.array(
                F.struct(_field("o_orderpriority", "sku"), _field("o_custkey", "qty")),
                F.struct(_field("o_orderstatus", "sku"), _field("o_custkey", "qty")),
            ).alias("items")
        ],
        {"skus": "array_join(items.sku, '|')", "qty": "CAST(items[1].qty AS STRING)"},
    ),
    "evolve_nested_combined": (
        lambda: [
            F.struct(
                _field("o_custkey", "alpha", "int"), _field("o_orderpriority", "beta")
            ).alias("payload")
        ],
        lambda: [
            F.struct(
                _field("o_orderpriority", "beta"),
                _field("o_custkey", "alpha"),
                _field("o_orderstatus", "gamma"),
            ).alias("payload")
        ],
        {"alpha": "payload.alpha", "beta": "payload.beta", "gamma": "payload.gamma"},
    ),
    "evolve_nested_other_case": (
        _alpha_beta,
        lambda: [
            F.struct(_field("o_orderpriority", "Alpha"), _field("o_custkey", "BETA")).alias(
                "payload"
            )
        ],
        {"alpha": "payload.alpha", "beta": "payload.beta"},
    ),
}


def evolve_plan_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every planned change, with the rows that hold a value at its path afterwards."""
    engine = engine_session(spark)
    orders = table(engine, sf_dir, "orders")
    stored = orders.select(
        F.struct(
            _field("o_custkey", "n", "int"),
            _field("o_orderstatus", "s"),
            _field("o_orderpriority", "old"),
        ).alias("p")
    )
    wanted = orders.select(
        F.struct(
            _field("o_orderstatus", "s"), _field("o_custkey", "n"), _field("o_orderdate", "at")
        ).alias("p"),
        _field("o_totalprice", "price"),
    )
    managed = ManagedTable(engine, scratch_dir(spark, "report"))
    managed.create(stored.schema, "report")
    managed.publish(
        managed.head(), stored.schema, (), "report", [managed.write(stored, "first")]
    )
    steps = evolve(spark, managed.location, wanted.schema)
    counts = managed.read().agg(
        *(F.count(F.expr(change.path)).alias(str(i)) for i, change in enumerate(steps.changes))
    )
    report = F.explode(
        F.array(
            *(
                F.struct(
                    F.lit(change.path).alias("path"),
                    F.lit(change.action).alias("action"),
                    F.lit(change.from_type).cast("string").alias("from_type"),
                    F.lit(change.to_type).cast("string").alias("to_type"),
                    F.col(str(i)).alias("row_count"),
                )
                for i, change in enumerate(steps.changes)
            )
        )
    )
    return counts.select(report.alias("r")).select("r.*")


QUERIES = {
    "delete_copy_incremental": delete_copy(1),
    "delete_copy_repeat": delete_copy(3),
    "delete_copy_other_slice": delete_copy_other_slice,
    "delete_copy_algebra": delete_copy_algebra,
    "delete_keeps_null_rows": delete_keeps_null_rows,
    "delete_all_when_unpaired": delete_all_when_unpaired,
    "full_refresh_slices": full_refresh_slices,
    "affected_file_rewrite": affected_file_rewrite,
    "retry_after_conflict": retry_after_conflict,
    "failed_first_run": failed_first_run,
    "refusals": refusals,
    "time_travel": time_travel,
    "expired_versions": expired_versions,
    "view_lower_snake": view_lower_snake,
    "view_catalog": view_catalog,
    "view_expression_try_cast": view_expression_try_cast,
    "full_ingest_expression": full_ingest_expression,
    "full_ingest_nested": full_ingest_nested,
    "load_by_name_case_sensitive": load_by_name_case_sensitive,
    "not_null_columns": not_null_columns,
    "evolve_plan_report": evolve_plan_report,
    **{name: evolved(name, *case) for name, case in EVOLUTIONS.items()},
}

_IN_JANUARY = "o_orderdate >= DATE '1996-01-01' AND o_orderdate < DATE '1996-02-01'"
_OTHER_SLICE = (
    f"SELECT * FROM orders WHERE NOT ({_IN_JANUARY}) UNION ALL "
    "SELECT * FROM orders WHERE year(o_orderdate) = 1997 AND month(o_orderdate) = 2"
)
_CORRECTED = (
    f"SELECT * REPLACE (CASE WHEN {_IN_JANUARY} THEN o_totalprice + 1 ELSE o_totalprice END "
    "AS o_totalprice) FROM orders"
)
_NEW = "o_orderdate >= DATE '1998-01-01'"
_NULLED = (
    "SELECT o_orderkey, o_custkey, o_orderstatus, "
    "CASE WHEN o_orderstatus <> 'P' THEN o_totalprice END AS o_totalprice, "
    "o_orderdate, o_orderpriority FROM orders"
)
_AMOUNT = "CASE WHEN o_orderstatus = 'P' THEN 'pending' ELSE printf('%.2f', o_totalprice) END"

ORACLE = {
    "delete_copy_incremental": _CORRECTED,
    "delete_copy_repeat": _CORRECTED,
    "delete_copy_other_slice": _OTHER_SLICE,
    "delete_copy_algebra": _OTHER_SLICE,
    "delete_keeps_null_rows": (
        f"SELECT * FROM ({_NULLED}) WHERE (o_totalprice > 300000) IS NOT TRUE "
        f"UNION ALL SELECT * FROM ({_NULLED}) WHERE o_totalprice > 450000"
    ),
    "delete_all_when_unpaired": (
        "SELECT * REPLACE (o_totalprice + 1 AS o_totalprice) FROM orders "
        "WHERE year(o_orderdate) = 1996"
    ),
    "full_refresh_slices": "SELECT * FROM orders WHERE year(o_orderdate) IN (1996, 1997)",
    "affected_file_rewrite": "SELECT * FROM orders WHERE year(o_orderdate) <> 1996",
    "retry_after_conflict": (
        "SELECT *, CAST(2 AS BIGINT) AS attempts, CAST(1 AS BIGINT) AS conflicts, "
        "CAST(2 AS BIGINT) AS version FROM orders"
    ),
    "failed_first_run": "SELECT o_orderkey, true AS dropped, 'full_refresh' AS mode FROM orders",
    "refusals": (
        "SELECT rule, error, (SELECT count(*) FROM orders) AS table_rows FROM (VALUES "
        "('alias_collision', 'SchemaError'), ('duplicate_name', 'SchemaError'), "
        "('predicate_type', 'SpecError'), ('unpaired_predicate', 'SpecError'), "
        "('incompatible_type', 'SchemaError'), ('removed_column', 'SchemaError')) t(rule, error)"
    ),
    "time_travel": "SELECT * FROM orders",
    "expired_versions": "SELECT *, CAST(1 AS BIGINT) AS versions FROM orders",
    "view_lower_snake": (
        "SELECT o_orderkey AS order_id, o_custkey AS http_customer_key, "
        f'{_AMOUNT} AS amount_text, o_orderdate AS "_2nd_date_value" FROM orders'
    ),
    "view_catalog": (
        "SELECT opened, o_orderkey AS order_id, o_custkey + "
        "CASE WHEN opened = 'after' AND year(o_orderdate) = 1996 THEN 1 ELSE 0 END "
        f"AS http_customer_key, TRY_CAST({_AMOUNT} AS DOUBLE) AS amount, "
        "o_orderdate AS order_date FROM orders, (VALUES ('before'), ('after')) AS t(opened)"
    ),
    "view_expression_try_cast": (
        f"SELECT o_orderkey AS order_id, TRY_CAST({_AMOUNT} AS DOUBLE) AS amount, "
        "CAST(o_custkey AS VARCHAR) AS http_customer_key FROM orders"
    ),
    "full_ingest_expression": (
        f"SELECT o_orderkey AS order_id, TRY_CAST({_AMOUNT} AS DOUBLE) AS amount, "
        "CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS order_date, "
        "CAST(NULL AS DOUBLE) AS not_in_files, "
        "'decimal(38,0),double,date,bigint' AS loaded_types FROM orders"
    ),
    "full_ingest_nested": (
        "SELECT o_orderkey AS k, o_orderstatus AS status, o_custkey AS cust, "
        "CAST(NULL AS INTEGER) AS absent, o_custkey AS second, CAST(2 AS INTEGER) AS entries "
        "FROM orders"
    ),
    "load_by_name_case_sensitive": (
        "SELECT o_totalprice, CAST(NULL AS VARCHAR) AS wrong_case, o_orderkey FROM orders"
    ),
    "not_null_columns": "SELECT event_id, ts, value FROM events",
    "evolve_plan_report": " UNION ALL ".join(
        f"SELECT {path} AS path, {action} AS action, CAST({old} AS VARCHAR) AS from_type, "
        f"CAST({new} AS VARCHAR) AS to_type, count({counted}) AS row_count FROM orders"
        for path, action, old, new, counted in (
            ("'p.n'", "'widen'", "'int'", "'bigint'", "o_custkey"),
            ("'p.at'", "'add_field'", "NULL", "'timestamp_ntz'", "NULL"),
            ("'p'", "'reorder'", "'n,s'", "'s,n'", "*"),
            ("'p.old'", "'keep'", "'string'", "NULL", "o_orderpriority"),
            ("'price'", "'add_column'", "NULL", "'double'", "NULL"),
        )
    ),
    "evolve_add_column": (
        f"SELECT o_orderkey, o_custkey AS cust, CASE WHEN {_NEW} THEN o_orderstatus END AS status "
        "FROM orders"
    ),
    "evolve_nested_add": (
        "SELECT o_orderkey, o_orderpriority AS alpha, o_custkey AS beta, "
        f"CASE WHEN {_NEW} THEN o_orderstatus END AS gamma FROM orders"
    ),
    "evolve_nested_reorder": (
        "SELECT o_orderkey, o_orderpriority AS alpha, o_custkey AS beta FROM orders"
    ),
    "evolve_nested_widen": (
        "SELECT o_orderkey, o_custkey AS item_count, "
        "CAST(CAST(o_totalprice AS DECIMAL(20, 2)) AS DOUBLE) AS price FROM orders"
    ),
    "evolve_nested_decimal": (
        f"SELECT o_orderkey, CASE WHEN {_NEW} THEN CASE WHEN o_orderkey % 7 = 0 "
        "THEN 9223372036854775807 ELSE o_custkey END "
        "WHEN o_orderkey % 7 = 0 THEN 9999999999 WHEN o_orderkey % 7 > 1 THEN o_custkey END AS code, "
        f"CASE WHEN {_NEW} THEN CASE WHEN o_orderkey % 7 = 0 "
        "THEN CAST(-9223372036854775808 AS BIGINT) ELSE o_custkey END "
        "WHEN o_orderkey % 7 = 0 THEN -9999999999 WHEN o_orderkey % 7 > 1 THEN o_custkey END AS n "
        "FROM orders"
    ),
    "evolve_nested_keep_missing": (
        "SELECT o_orderkey, o_orderpriority AS alpha, "
        f"CASE WHEN NOT ({_NEW}) THEN CAST(o_custkey AS VARCHAR) END AS beta FROM orders"
    ),
    "evolve_nested_deep": (
        "SELECT o_orderkey, o_custkey AS inner_a, "
        f"CASE WHEN {_NEW} THEN o_orderstatus END AS inner_b FROM orders"
    ),
    "evolve_nested_array_struct": (
        "SELECT o_orderkey, o_orderpriority || '|' || o_orderstatus AS skus, "
        f"CASE WHEN {_NEW} THEN CAST(o_custkey AS VARCHAR) END AS qty FROM orders"
    ),
    "evolve_nested_combined": (
        "SELECT o_orderkey, o_custkey AS alpha, o_orderpriority AS beta, "
        f"CASE WHEN {_NEW} THEN o_orderstatus END AS gamma FROM orders"
    ),
    "evolve_nested_other_case": (
        "SELECT o_orderkey, o_orderpriority AS alpha, o_custkey AS beta FROM orders"
    ),
}
