"""Headline workloads, timed. Prints one JSON line.

``BENCH_SF_DIR`` (default ``/root/testdata/sf0.1``) holds the tables, Spark runs on
``local[BENCH_CPUS]`` and each workload runs ``BENCH_REPEATS`` times (default 3)
after its source layout exists; the best time counts. ``spark_copy`` is a plain
Spark read and write of the same files, as a yardstick for the full refresh.
"""

from __future__ import annotations

import json
import os
import sys
import time
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablesync import (
    ManagedTable,
    PrefixSource,
    SqlSource,
    SyncSpec,
    TableSource,
    read_table,
    sync,
)
from tablesync.catalogue import layout, scans
from tablesync.catalogue.loads import EVOLUTIONS
from tablesync.operators.load import delete_and_copy
from tablesync.session import engine_session, scratch_dir
from tablesync.sources.prefix import Prefix

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
REPEATS = int(os.environ.get("BENCH_REPEATS", "3"))
MONTH = "\"l_shipdate\" >= '1997-03-01' AND \"l_shipdate\" < '1997-04-01'"


def drain(frame: DataFrame) -> None:
    frame.write.format("noop").mode("overwrite").save()


class Bench:
    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.engine = engine_session(spark)
        self.times: dict[str, float] = {}
        self.facts: dict[str, int] = {}

    def lineitem_lake(self) -> str:
        def write(location: str) -> None:
            items = layout.table(self.spark, SF_DIR, "lineitem")
            dated = items.withColumns({"year": F.year("l_shipdate"), "month": F.month("l_shipdate")})
            layout.write_partitioned(dated, location, "year", "month")

        return layout.once(self.spark, SF_DIR, "lineitem-lake", write)

    def time(self, name: str, run, prepare=lambda: None) -> None:
        best = None
        for _ in range(REPEATS):
            given = prepare()
            started = time.perf_counter()
            result = run() if given is None else run(given)
            took = time.perf_counter() - started
            best = took if best is None else min(best, took)
        self.times[name] = round(best, 3)
        if hasattr(result, "slices_rewritten"):
            self.facts[f"{name}_slices_rewritten"] = result.slices_rewritten
            self.facts[f"{name}_slices_dropped"] = result.slices_dropped

    def spec(self, **changes) -> SyncSpec:
        source = PrefixSource(
            self.lineitem_lake(), incremental_paths=("year=1997/month=3",)
        )
        values = {
            "target": "lineitem",
            "location": scratch_dir(self.spark, "bench"),
            "source": source,
            "incremental_predicate": MONTH,
        }
        return SyncSpec(**(values | changes))

    def loads(self) -> None:
        lake = self.lineitem_lake()
        self.time("full_refresh", lambda: sync(self.spark, self.spec()))

        def loaded() -> SyncSpec:
            spec = self.spec()
            sync(self.spark, spec)
            return spec

        def twice() -> SyncSpec:
            spec = loaded()
            sync(self.spark, spec)
            return spec

        self.time("incremental_month", lambda spec: sync(self.spark, spec), loaded)
        self.time("incremental_month_again", lambda spec: sync(self.spark, spec), twice)

        def rewrite(spec: SyncSpec) -> None:
            current = read_table(self.spark, spec.location)
            incoming = Prefix(self.engine, lake, ("year=1997/month=3",)).read()
            whole = delete_and_copy(current, MONTH, incoming)
            whole.write.parquet(scratch_dir(self.spark, "whole"))

        self.time("whole_table_rewrite", rewrite, loaded)
        copy = self.engine.read.option("recursiveFileLookup", True)
        self.time(
            "spark_copy",
            lambda: copy.parquet(lake).write.parquet(scratch_dir(self.spark, "copy")),
        )

        spec = twice()
        self.time("read_after_increments", lambda: drain(read_table(self.spark, spec.location)))

    def planning(self) -> None:
        lake = layout.lake(self.spark, SF_DIR)
        suffixes = ("", *(f"year={year}" for year in range(1995, 2002)), "year=1996/month=1")
        self.time("prefix_planning", lambda: Prefix(self.engine, lake, suffixes).rollup().collect())

    def tables(self) -> None:
        location = layout.shards(self.spark, SF_DIR)
        self.time(
            "shard_scan",
            lambda: scans.synced_table(self.spark, "shards", TableSource(location, "events_*")),
        )

    def nested(self) -> None:
        old, new, flat = EVOLUTIONS["evolve_nested_combined"]
        keys = [F.col("o_orderkey"), F.col("o_orderdate")]
        location = layout.eras(
            self.spark, SF_DIR, "bench-eras", [*keys, *old()], [*keys, *new()]
        )
        spec = SyncSpec(
            target="nested",
            location=scratch_dir(self.spark, "nested"),
            source=PrefixSource(
                location, full_refresh_paths=("era=old",), incremental_paths=("era=new",)
            ),
            incremental_predicate="\"o_orderdate\" >= '1998-01-01'",
        )
        sync(self.spark, spec)
        sync(self.spark, spec)
        managed = ManagedTable(self.engine, spec.location)
        columns = [F.expr(text).alias(name) for name, text in flat.items()]
        self.time("nested_evolution_read", lambda: drain(managed.read().select(columns)))

    def staging(self) -> None:
        def spec() -> SyncSpec:
            return SyncSpec(
                target="joined",
                location=scratch_dir(self.spark, "joined"),
                source=SqlSource(scans._join_sql(SF_DIR), scratch_dir(self.spark, "staging")),
            )

        self.time("sql_staging_cold", lambda given: sync(self.spark, given), spec)

        def staged() -> SyncSpec:
            first = spec()
            sync(self.spark, first)
            return replace(first, location=scratch_dir(self.spark, "joined"))

        self.time("sql_staging_reused", lambda given: sync(self.spark, given), staged)


def main() -> None:
    spark = (
        SparkSession.builder.master(f"local[{CPUS}]")
        .appName("tablesync-bench")
        .config("spark.sql.shuffle.partitions", CPUS)
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "8g"))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("OFF")
    bench = Bench(spark)
    for workload in (bench.loads, bench.planning, bench.tables, bench.nested, bench.staging):
        workload()
    print(
        json.dumps(
            {
                "metric": "total_seconds",
                "value": round(sum(bench.times.values()), 3),
                "unit": "sec",
                "queries": bench.times,
                "sf": os.path.basename(SF_DIR.rstrip("/")).removeprefix("sf"),
                "facts": bench.facts,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    sys.exit(main())
