"""Compare every catalogue query with its oracle SQL in DuckDB.

``python tests/compare.py [sf_dir [query ...]]`` prints one line per query.
"""

from __future__ import annotations

import sys
import time
from collections import Counter
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()

SPARK_TYPES = {
    "string": "VARCHAR", "int": "INTEGER", "timestamp_ntz": "TIMESTAMP", "bigint": "BIGINT",
}


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(
            f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')"
        )
    return connection


def difference(frame, connection: duckdb.DuckDBPyConnection, sql: str) -> str | None:
    """None when both hold the same bag of rows, else what differs."""
    result = connection.execute(sql)
    columns = [column[0] for column in result.description]
    if sorted(columns) != sorted(frame.columns):
        return f"columns {sorted(frame.columns)} vs {sorted(columns)}"
    kinds = dict(zip(columns, (str(column[1]) for column in result.description)))
    for name, kind in frame.dtypes:
        if SPARK_TYPES.get(kind, kind.upper()) != kinds[name]:
            return f"type of {name}: {kind} vs {kinds[name]}"
    order = sorted(columns)
    wanted = Counter(
        tuple(row[columns.index(name)] for name in order) for row in result.fetchall()
    )
    found = Counter(tuple(row[name] for name in order) for row in frame.collect())
    if found == wanted:
        return None
    extra, missing = found - wanted, wanted - found
    return (
        f"{sum(found.values())} vs {sum(wanted.values())} rows; extra "
        f"{str(next(iter(extra), None))[:300]}; missing {str(next(iter(missing), None))[:300]}"
    )


def main(sf_dir: str, names: list[str]) -> int:
    from pyspark.sql import SparkSession

    import __spark_entry__ as entry

    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("OFF")
    connection = connect(sf_dir)
    oracle = entry.oracle_sql()
    failures = 0
    for name, query in entry.queries().items():
        if names and name not in names:
            continue
        started = time.time()
        try:
            frame = query(spark, sf_dir)
            problem = difference(frame, connection, oracle[name]) if name in oracle else None
            if name not in oracle:
                frame.collect()
        except Exception as error:
            problem = f"{type(error).__name__}: {str(error)[:400]}"
        failures += problem is not None
        print(f"{'FAIL' if problem else 'ok':5}{name:32}{time.time() - started:7.2f}s {problem or ''}")
    return failures


if __name__ == "__main__":
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    sys.exit(1 if main(sf, sys.argv[2:]) else 0)
