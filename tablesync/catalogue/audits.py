"""Audits: the run log, reconciliation, scalar functions over whole texts."""

from __future__ import annotations

from datetime import UTC, timedelta

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..errors import SourceError
from ..functions import (
    error_text,
    json_count,
    json_field,
    log_timestamp,
    lower_snake,
    redact,
    stable_hash,
    try_double,
    try_number,
)
from ..operators.reconcile import differing_slices
from ..operators.runlog import (
    RUN_LOG_SCHEMA, append_run, latest_runs, merge_days, mode_history, read_runs, status_counts,
)
from ..operators.views import read_table, read_view
from ..session import engine_session, scratch_dir
from ..sources.base import SourcePlan, register_source
from ..spec import PrefixSource, SyncSpec, TableSource
from ..sync import sync
from .layout import lake, shards, table
from .loads import lake_spec

_SEGMENTS = "array<struct<file_count:bigint,path_suffix:string,total_bytes:bigint>>"


def _planned_files() -> Column:
    segments = F.from_json("export_segments", _SEGMENTS)
    counts = F.transform(segments, lambda segment: F.coalesce(segment["file_count"], F.lit(0)))
    return F.aggregate(counts, F.lit(0).cast("bigint"), lambda total, n: total + n)


def run_log_modes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three runs of one target, oldest first."""
    log = scratch_dir(spark, "log")
    spec = lake_spec(spark, sf_dir, "modes", run_log=log)
    for _ in range(3):
        sync(spark, spec)
    runs = mode_history(read_runs(engine_session(spark), log), "modes")
    position = F.row_number().over(Window.partitionBy("target_view").orderBy("started_at"))
    return runs.select(
        position.cast("bigint").alias("run"),
        "effective_mode",
        "status",
        (_planned_files() >= F.lit(1)).alias("planned_some"),
        json_count(F.col("publish_ids")).cast("bigint").alias("published"),
    )


def run_log_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The latest run of each of two targets."""
    log = scratch_dir(spark, "log")
    orders = lake_spec(spark, sf_dir, "latest_orders", run_log=log)
    events = SyncSpec(
        target="latest_events",
        location=scratch_dir(spark, "latest_events"),
        source=TableSource(shards(spark, sf_dir), "events_*"),
        run_log=log,
    )
    for spec in (orders, events, orders):
        sync(spark, spec)
    return latest_runs(read_runs(engine_session(spark), log)).select(
        F.col("target_view").alias("target"),
        "source_type",
        "effective_mode",
        json_count(F.col("export_segments")).cast("bigint").alias("segments"),
    )


def run_log_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A log with the runs of many days, derived from events: the days before the last one are
    merged, and a week of it is read."""
    log = scratch_dir(spark, "log")
    engine = engine_session(spark)
    events = table(engine, sf_dir, "events")
    last = events.agg(F.max(F.to_date("ts")).alias("d")).first()["d"]
    window = events.where(F.to_date("ts") > F.lit(last - timedelta(days=10)))
    window = window.groupBy(F.to_date("ts").alias("day"), (F.col("user_id") % 3).alias("part"))
    runs = window.agg(F.max("ts").alias("at"), F.count("*").alias("n")).collect()
    for run in runs:  # thirty runs, a row each
        values = dict.fromkeys(RUN_LOG_SCHEMA.names) | {
            "run_id": f"{run['day']}-{run['part']}", "target_view": f"events_{run['part']}",
            "status": "success", "finished_at": run["at"].replace(tzinfo=UTC),
            "retry": {"rows": run["n"]},
        }
        append_run(engine, log, values)
    merge_days(engine, log, last)
    week = read_runs(engine, log, last - timedelta(days=6), last)
    return week.groupBy(F.to_date("finished_at").cast("string").alias("day")).agg(
        F.count("*").alias("runs"), F.sum(json_field(F.col("retry"), "$.rows", "bigint")).alias("events")
    )


def run_log_skip_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Successful, skipped and failed runs, beside the rows the table still has."""
    log = scratch_dir(spark, "log")
    good = lake_spec(spark, sf_dir, "counted", run_log=log)
    sync(spark, good)
    for skip in (True, False):
        missing = PrefixSource(
            lake(spark, sf_dir),
            full_refresh_paths=("year=1890",),
            incremental_paths=("year=1890",),
            skip_missing=skip,
        )
        spec = lake_spec(
            spark, sf_dir, "counted", run_log=log, location=good.location, source=missing
        )
        try:
            sync(spark, spec)
        except SourceError:
            pass
    rows = read_table(spark, good.location).groupBy(F.lit("counted").alias("target_view"))
    return status_counts(read_runs(engine_session(spark), log)).join(
        rows.agg(F.count("*").alias("table_rows")), "target_view"
    )


def reconcile_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of the view and of the internal table."""
    spec = lake_spec(spark, sf_dir, "reconcile")
    sync(spark, spec)
    view = read_view(spark, spec.location).select(F.lit("view").alias("side"))
    internal = read_table(spark, spec.location).select(F.lit("internal").alias("side"))
    counted = view.unionAll(internal).groupBy("side").agg(F.count("*").alias("row_count"))
    return counted


_PLANTED = {"lost": "1995-03", "doubled": "1996-05", "changed": "1997-07"}


def reconcile_slices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Months in which a table and its source differ: the source has since lost a row of one
    month, has one of another twice and a changed one in a third."""
    spec = lake_spec(spark, sf_dir, "reconcile_slices")
    sync(spark, spec)
    stored = read_table(spark, spec.location)
    month = F.date_format("o_orderdate", "yyyy-MM")
    orders = table(stored.sparkSession, sf_dir, "orders").withColumn("_month", month)
    marked = orders.groupBy("_month").agg(F.min("o_orderkey").alias("_first"))
    marked = marked.where(F.col("_month").isin(*_PLANTED.values()))
    source = orders.join(marked.drop("_month"), F.col("o_orderkey") == F.col("_first"), "left")
    hit = F.col("_first").isNotNull()
    times = F.when(hit & (F.col("_month") == _PLANTED["lost"]), 0).when(
        hit & (F.col("_month") == _PLANTED["doubled"]), 2
    )
    copies = F.array_repeat(F.lit(1), F.coalesce(times, F.lit(1)))
    price = F.when(
        hit & (F.col("_month") == _PLANTED["changed"]), F.col("o_totalprice") + 1
    ).otherwise(F.col("o_totalprice"))
    source = source.withColumn("o_totalprice", price).select(*stored.columns, F.explode(copies))
    return differing_slices(stored, source.select(*stored.columns), month)


def variant_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fields of JSON text, some of it cut short: what is not JSON is NULL."""
    events = table(spark, sf_dir, "events")
    nested = F.concat(F.lit('{"user": {"id": '), "user_id", F.lit("}, \"kinds\": [\""),
                      "event_type", F.lit('"], "props": '), "props", F.lit("}"))
    cut = F.when(F.col("event_id") % 5 == 0, F.expr("substr(props, 1, length(props) - 1)"))
    return events.select(
        "event_id",
        json_field(F.coalesce(cut, F.col("props")), "$.k", "bigint").alias("k"),
        json_field(nested, "$.user.id", "bigint").alias("user"),
        json_field(nested, "$.kinds[0]", "string").alias("kind"),
        json_field(nested, "$.kinds[0]", "bigint").alias("not_a_number"),
        json_field(nested, "$.props.k", "double").alias("deep"),
        json_field(nested, "$.absent", "string").alias("absent"),
    )


class TableRows:
    """A source plugged in by a caller: a DataFrame-producing function."""

    kind = "rows"
    full_refresh_slices = incremental_slices = ()

    def __init__(self, rows):
        self.rows = rows


def _plan_rows(context, source: TableRows) -> SourcePlan:
    frame = source.rows(context.engine)
    return SourcePlan(schema=frame.schema, rows=lambda: frame)


def custom_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A registered source: documents joined with their labels."""
    register_source(TableRows, _plan_rows)

    def rows(session: SparkSession) -> DataFrame:
        documents = table(session, sf_dir, "documents").select("doc_id", "lang", "source", "n_chars")
        labels = table(session, sf_dir, "labels").select(
            "doc_id", F.concat_ws("/", "quality", "toxic").alias("label")
        )
        return documents.join(labels, "doc_id", "left")

    spec = SyncSpec(
        target="labelled", location=scratch_dir(spark, "labelled"), source=TableRows(rows)
    )
    sync(spark, spec)
    return read_view(spark, spec.location)


# --- scalar functions -----------------------------------------------------------


def _texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select(
        F.lit("documents").alias("origin"), F.col("doc_id").alias("id"), "text"
    )
    pages = table(spark, sf_dir, "pages").select(
        F.lit("pages").alias("origin"), F.col("page_id").alias("id"), F.col("html").alias("text")
    )
    urls = table(spark, sf_dir, "pages").select(
        F.lit("urls").alias("origin"), F.col("page_id").alias("id"), F.col("url").alias("text")
    )
    return documents.unionAll(pages).unionAll(urls)


def redact_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _texts(spark, sf_dir).select("origin", "id", redact(F.col("text")).alias("clean"))


def redact_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts as error messages; the length limit is the operator's own."""
    message = error_text(F.concat(F.col("origin"), F.lit("Error")), F.col("text"))
    return _texts(spark, sf_dir).select("origin", "id", message.alias("message"))


def lower_snake_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _texts(spark, sf_dir).select("origin", "id", lower_snake(F.col("text")).alias("snake"))


def stable_hashes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _texts(spark, sf_dir).select("origin", "id", stable_hash(F.col("text"), 24).alias("h"))


def json_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = F.to_json(F.split("text", " "))
    return _texts(spark, sf_dir).select(
        "origin", "id", json_count(words).cast("bigint").alias("words")
    )


def log_timestamps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Event times as log text, in UTC and nine hours east."""
    tokyo = F.convert_timezone(F.lit("UTC"), F.lit("Asia/Tokyo"), F.col("ts"))
    return table(spark, sf_dir, "events").select(
        "event_id", log_timestamp(F.col("ts")).alias("utc"), log_timestamp(tokyo).alias("tokyo")
    )


def tolerant_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Number-like and other text of ``events``, read tolerantly."""
    events = table(spark, sf_dir, "events")
    text = F.when(F.col("event_type") == "error", F.col("event_type")).otherwise(
        F.col("user_id").cast("string")
    )
    return events.select(
        "event_id",
        try_number(text).cast("string").alias("as_number"),
        try_double(text).alias("as_double"),
    )


QUERIES = {
    "run_log_modes": run_log_modes,
    "run_log_latest": run_log_latest,
    "run_log_skip_counts": run_log_skip_counts,
    "run_log_days": run_log_days,
    "reconcile_counts": reconcile_counts,
    "reconcile_slices": reconcile_slices,
    "variant_fields": variant_fields,
    "custom_source": custom_source,
    "redact_texts": redact_texts,
    "redact_errors": redact_errors,
    "lower_snake_values": lower_snake_values,
    "stable_hashes": stable_hashes,
    "json_counts": json_counts,
    "log_timestamps": log_timestamps,
    "tolerant_numbers": tolerant_numbers,
}

_TEXTS = (
    "SELECT 'documents' AS origin, doc_id AS id, text FROM documents "
    "UNION ALL SELECT 'pages', page_id, html FROM pages "
    "UNION ALL SELECT 'urls', page_id, url FROM pages"
)


# Written out, so that a changed rule of the engine shows.
_SPACED = (
    "trim(regexp_replace(text, "
    "'[\\x{9}-\\x{D}\\x{1C}-\\x{20}\\x{85}\\p{Z}]+', ' ', 'g'))"
)
_NO_BEARER = f"regexp_replace({_SPACED}, '(?i)bearer [a-z0-9._~+/=-]+', 'Bearer <redacted>', 'g')"
_NO_STORE = f"regexp_replace({_NO_BEARER}, '(?i)(?:gs|gcs|s3)://[^ ]+', '<redacted-uri>', 'g')"
_NO_WEB = f"regexp_replace({_NO_STORE}, '(?i)https?://[^ ]+', '<redacted-uri>', 'g')"
_NO_STAGE = (
    f"regexp_replace({_NO_WEB}, '(?i)@[a-z0-9_\".]+/[^ ]+', '@<redacted-stage-path>', 'g')"
)
_REDACTED = (
    f"regexp_replace({_NO_STAGE}, '(?i)(password|token|secret|credential|private[_-]?key)"
    "( ?[:=] ?)(?:''[^'']*''|\"[^\"]*\"|[^ ]+)', '\\1\\2<redacted>', 'g')"
)
_SPLIT = (
    "regexp_replace(regexp_replace(text, '([a-z0-9])([A-Z])', '\\1_\\2', 'g'), "
    "'([A-Z]+)([A-Z][a-z])', '\\1_\\2', 'g')"
)
_SNAKE = f"lower(trim(regexp_replace({_SPLIT}, '[^0-9A-Za-z]+', '_', 'g'), '_'))"


ORACLE = {
    "run_log_modes": (
        "SELECT CAST(1 AS BIGINT) AS run, 'full_refresh' AS effective_mode, "
        "'success' AS status, true AS planned_some, CAST(1 AS BIGINT) AS published "
        "UNION ALL SELECT run, 'incremental', 'success', true, CAST(1 AS BIGINT) "
        "FROM (VALUES (2), (3)) runs(run)"
    ),
    "run_log_latest": (
        "SELECT 'latest_orders' AS target, 'prefix' AS source_type, "
        "'incremental' AS effective_mode, CAST(1 AS BIGINT) AS segments "
        "UNION ALL SELECT 'latest_events', 'table', 'full_refresh', "
        "count(DISTINCT CAST(ts AS DATE)) FROM events"
    ),
    "run_log_skip_counts": (
        "SELECT 'counted' AS target_view, CAST(3 AS BIGINT) AS runs, "
        "CAST(1 AS BIGINT) AS success, CAST(1 AS BIGINT) AS skipped, "
        "CAST(1 AS BIGINT) AS failure, count(*) AS table_rows FROM orders"
    ),
    "run_log_days": (
        "SELECT CAST(CAST(ts AS DATE) AS VARCHAR) AS day, count(DISTINCT user_id % 3) AS runs, "
        "CAST(count(*) AS BIGINT) AS events FROM events WHERE CAST(ts AS DATE) > "
        "(SELECT max(CAST(ts AS DATE)) FROM events) - INTERVAL 7 DAY GROUP BY 1"
    ),
    "reconcile_counts": (
        "SELECT 'view' AS side, count(*) AS row_count FROM orders "
        "UNION ALL SELECT 'internal', count(*) FROM orders"
    ),
    "reconcile_slices": (
        "SELECT slice, n AS left_rows, n + CASE slice WHEN '1995-03' THEN -1 "
        "WHEN '1996-05' THEN 1 ELSE 0 END AS right_rows FROM (SELECT "
        "strftime(o_orderdate, '%Y-%m') AS slice, count(*) AS n FROM orders GROUP BY 1) "
        "WHERE slice IN ('1995-03', '1996-05', '1997-07')"
    ),
    "variant_fields": (
        "SELECT event_id, CASE WHEN event_id % 5 <> 0 THEN CAST(props ->> '$.k' AS BIGINT) END AS k, "
        'user_id AS "user", event_type AS kind, CAST(NULL AS BIGINT) AS not_a_number, '
        "CAST(props ->> '$.k' AS DOUBLE) AS deep, CAST(NULL AS VARCHAR) AS absent FROM events"
    ),
    "custom_source": (
        "SELECT doc_id, lang, source, n_chars, quality || '/' || toxic AS label "
        "FROM documents LEFT JOIN labels USING (doc_id)"
    ),
    "redact_texts": f"SELECT origin, id, {_REDACTED} AS clean FROM ({_TEXTS})",
    "redact_errors": (
        "SELECT origin, id, CASE WHEN clean = '' THEN kind ELSE kind || ': ' || clean END "
        "AS message FROM (SELECT origin, id, origin || 'Error' AS kind, "
        f"{_REDACTED} AS clean FROM ({_TEXTS}))"
    ),
    "lower_snake_values": (
        "SELECT origin, id, CASE WHEN bare = '' THEN 'field' WHEN bare SIMILAR TO '[0-9].*' "
        f"THEN '_' || bare ELSE bare END AS snake FROM (SELECT origin, id, {_SNAKE} AS bare "
        f"FROM ({_TEXTS}))"
    ),
    "stable_hashes": f"SELECT origin, id, left(sha256(text), 24) AS h FROM ({_TEXTS})",
    "json_counts": (
        "SELECT origin, id, CAST(len(string_split(text, ' ')) AS BIGINT) AS words "
        f"FROM ({_TEXTS})"
    ),
    "log_timestamps": (
        "SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS utc, "
        "strftime(ts + INTERVAL 9 HOUR, '%Y-%m-%d %H:%M:%S.%f') AS tokyo FROM events"
    ),
    "tolerant_numbers": (
        "SELECT event_id, CAST(TRY_CAST(t AS DECIMAL(38, 0)) AS VARCHAR) AS as_number, "
        "TRY_CAST(t AS DOUBLE) AS as_double FROM (SELECT event_id, CASE WHEN event_type = 'error' "
        "THEN event_type ELSE CAST(user_id AS VARCHAR) END AS t FROM events)"
    ),
}
