"""The run log: one row per run, appended as its own small Parquet directory of its day.

``<location>/day=YYYY-MM-DD/run=<id>/``: concurrent runs never share a commit path, so there is
no lock to wait for, and a read lists the days it wants. The runs of a finished day are merged
into one directory; while a merge deletes what it merged, readers may meet a run in both places
and count it once.
"""

from __future__ import annotations

import json
import uuid
from datetime import UTC, date, datetime
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import error_text
from ..session import Files, literal_path

_TEXT_COLUMNS = (
    "run_id", "invocation_id", "model_unique_id", "target_view", "internal_table",
    "source_type", "effective_mode", "predicate_json", "export_segments",
    "source_job_references", "staging_table_reference", "publish_ids", "retry", "cleanup",
    "status", "error_message",
)
RUN_LOG_SCHEMA = T.StructType(
    [T.StructField(name, T.StringType()) for name in _TEXT_COLUMNS]
    + [T.StructField(name, T.TimestampType()) for name in ("started_at", "finished_at")]
)
_JSON_COLUMNS = (
    "predicate_json", "export_segments", "source_job_references", "publish_ids", "retry",
    "cleanup",
)


def append_run(
    spark: SparkSession, location: str, row: dict[str, Any], error_kind: str | None = None
) -> None:
    """Append one row; with ``error_kind`` its message is redacted on the way in."""
    values = {
        name: json.dumps(row[name], sort_keys=True) if name in _JSON_COLUMNS else row.get(name)
        for name in RUN_LOG_SCHEMA.names
    }
    frame = spark.createDataFrame([tuple(values.values())], RUN_LOG_SCHEMA).coalesce(1)
    if error_kind:
        message = F.coalesce("error_message", F.lit(""))
        frame = frame.withColumn("error_message", error_text(F.lit(error_kind), message))
    day = row["finished_at"].astimezone(UTC).date()
    frame.write.parquet(f"{_day(location, day)}/{_RUN}{row['run_id']}")


_DAY, _RUN, _MERGED = "day=", "run=", "run=merged-"


def _day(location: str, day: date) -> str:
    return f"{location.rstrip('/')}/{_DAY}{day.isoformat()}"


def logged_days(spark: SparkSession, location: str) -> list[date]:
    """The days that have runs, from directory names."""
    names = Files(spark, location).names(location)
    return [date.fromisoformat(name.removeprefix(_DAY)) for name in names if name.startswith(_DAY)]


def read_runs(
    spark: SparkSession, location: str, since: date | None = None, until: date | None = None
) -> DataFrame:
    """The runs that finished on the days (UTC) from ``since`` to ``until``, both included.

    Other days are not even listed.
    """
    days = [
        day for day in logged_days(spark, location)
        if (since is None or day >= since) and (until is None or day <= until)
    ]
    if not days:
        return spark.createDataFrame([], RUN_LOG_SCHEMA)
    files = Files(spark, location)
    merging = False
    for day in days[:-1]:  # the last day is merged by no one yet
        names = files.names(_day(location, day))
        merging |= len(names) > 1 and any(name.startswith(_MERGED) for name in names)
    runs = _scan(spark, [_day(location, day) for day in days])
    return runs.dropDuplicates(["run_id"]) if merging else runs


def _scan(spark: SparkSession, paths: list[str]) -> DataFrame:
    reader = spark.read.schema(RUN_LOG_SCHEMA).option("recursiveFileLookup", True)
    return reader.parquet(*map(literal_path, paths))


def merge_days(spark: SparkSession, location: str, before: date | None = None) -> int:
    """Merge the runs of each day before ``before`` (by default: today) into one directory;
    returns how many days were merged. The merged directory is complete before it gets its
    name, so a merge that is cut short loses nothing and is repeated by the next one."""
    before = before or datetime.now(UTC).date()
    files, merged = Files(spark, location), 0
    for day in logged_days(spark, location):
        folder = _day(location, day)
        names = [name for name in files.names(folder) if name.startswith(_RUN)]
        if day >= before or len(names) < 2:
            continue
        paths = [f"{folder}/{name}" for name in names]
        token = uuid.uuid4().hex
        rows = _scan(spark, paths).dropDuplicates(["run_id"]).coalesce(1)
        rows.write.parquet(f"{folder}/.{token}")
        files.rename(f"{folder}/.{token}", f"{folder}/{_MERGED}{token}")
        for path in paths:
            files.delete(path)
        merged += 1
    return merged


def latest_run(spark: SparkSession, location: str, target: str) -> DataFrame:
    """The latest run of one target: days are read from the newest back until one has it."""
    for day in sorted(logged_days(spark, location), reverse=True):
        found = latest_runs(read_runs(spark, location, day, day).where(F.col("target_view") == target))
        if not found.isEmpty():
            return found
    return spark.createDataFrame([], RUN_LOG_SCHEMA)


def latest_runs(runs: DataFrame) -> DataFrame:
    """The latest run of every target, without sorting the log."""
    newest = F.max_by(F.struct(*runs.columns), "finished_at").alias("run")
    return runs.groupBy(F.col("target_view").alias("target")).agg(newest).select("run.*")


def mode_history(runs: DataFrame, target: str) -> DataFrame:
    """The runs of one target, oldest first."""
    return runs.where(F.col("target_view") == target).orderBy("started_at")


def status_counts(runs: DataFrame) -> DataFrame:
    """Runs per target and how they ended."""
    return runs.groupBy("target_view").agg(
        F.count("*").alias("runs"),
        *(
            F.count_if(F.col("status") == status).alias(status)
            for status in ("success", "skipped", "failure")
        ),
    )
