from __future__ import annotations

import os
from concurrent.futures import ThreadPoolExecutor

import pytest
from frames import bag
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablesync import PrefixSource, RangePartition, SchemaError, SourceError, SqlSource, TableSource, TimePartition
from tablesync.plans.slices import partition_condition
from tablesync.session import engine_session
from tablesync.sources import sqltext, tables  # noqa: F401
from tablesync.sources.base import SourceContext, plan_source
from tablesync.sources.export import export_partitions, export_slices, read_export
from tablesync.sources.listing import covering, match_segments, normalise_suffix
from tablesync.sources import prefix as prefix_module
from tablesync.sources.prefix import ListingDigest, Prefix, listing_digest, named_paths, scan_digest
from tablesync.sources.tables import Dataset, partition_counts


@pytest.fixture(scope="module")
def engine(spark):
    return engine_session(spark)


@pytest.fixture
def context(spark, engine):
    def go(mode="full_refresh", declared=None, run_id="run1", target="t"):
        return SourceContext(spark, engine, mode, run_id, target, declared)

    return go


# --- prefix -------------------------------------------------------------------------


def test_sibling_directories(engine, write, tmp_path):
    for month in (1, 10, 12):
        write(tmp_path / f"lake/year=2025/month={month}", "m int", (month,))
    prefix = Prefix(engine, str(tmp_path / "lake"), ("year=2025/month=1",))
    assert bag(prefix.read()) == [(1,)]
    assert prefix.rollup().select("path_suffix", "file_count").collect() == [
        ("year=2025/month=1", 1)
    ]
    assert prefix.read().columns == ["m"]


def test_segments(engine, write, tmp_path):
    write(tmp_path / "lake/a/b", "x int", (1,))
    write(tmp_path / "lake/a/c", "x int", (2,))
    write(tmp_path / "lake/d", "x int", (3,))
    root = str(tmp_path / "lake")
    for suffixes, wanted in (
        (("",), [1, 2, 3]),
        (("a", "d"), [1, 2, 3]),
        (("a", "a/b"), [1, 1, 2]),
        (("", "a", "a/b", "missing"), [1, 1, 1, 2, 2, 3]),
        (("d", "d"), [3, 3]),
    ):
        prefix = Prefix(engine, root, suffixes)
        assert [row[0] for row in bag(prefix.read())] == wanted
        assert [row[0] for row in bag(prefix.read(T.StructType.fromDDL("x int")))] == wanted
        assert prefix.rollup().agg(F.sum("file_count")).first()[0] == len(wanted)


def test_suffix_is_a_directory(engine, write, tmp_path):
    path = write(tmp_path / "lake/a", "x int", (1,))
    (name,) = [n for n in os.listdir(path) if n.endswith(".parquet")]
    prefix = Prefix(engine, str(tmp_path / "lake"), (f"a/{name}",))
    assert prefix.rollup().first()["file_count"] == 0


@pytest.mark.parametrize(
    "suffixes, pattern, wanted",
    [
        (("",), r"keep/.*[.]parquet$", [1]),
        (("",), r"^keep", [1]),
        (("keep",), r"^keep", []),
        (("keep", ""), r"parquet", [1, 1, 2]),
        (("",), r"nothing", []),
    ],
)
def test_pattern(engine, write, tmp_path, suffixes, pattern, wanted):
    write(tmp_path / "lake/keep", "x int", (1,))
    write(tmp_path / "lake/drop", "x int", (2,))
    prefix = Prefix(engine, str(tmp_path / "lake"), suffixes, pattern)
    assert prefix.files().count() == len(wanted)
    if wanted:
        assert [row[0] for row in bag(prefix.read())] == wanted


def test_every_file_adds_its_columns(engine, context, write, tmp_path):
    root = tmp_path / "lake"
    write(root / "part=00", "k int, first_only string", (0, "x"))
    for number in range(1, 21):
        write(root / f"part={number:02d}", "k int", (number,))
    for number, name in enumerate(sorted(os.listdir(root))):  # the first is the oldest
        for file in os.listdir(root / name):
            os.utime(root / name / file, (1_000_000 + number, 1_000_000 + number))
    plan = plan_source(context(), PrefixSource(str(root)))
    assert plan.schema.names == ["k", "first_only"]
    assert plan.rows().where("first_only = 'x'").count() == 1 and plan.rows().count() == 21
    capped = plan_source(context(), PrefixSource(str(root), infer_max_files=2))
    assert capped.schema.names == ["k"]
    prefix = Prefix(engine, str(root), ("",), "part=2")
    assert [row["rel"].split("/")[0] for row in prefix.newest(1).collect()] == ["part=20"]


@pytest.mark.parametrize("pattern", [None, "parquet$"])
@pytest.mark.parametrize("paths", [("",), ("a", "a/b"), ("a", "a")])
def test_rows_are_those_of_the_plan(context, write, tmp_path, pattern, paths):
    write(tmp_path / "lake/a/b", "x int", (1,), (2,))
    source = PrefixSource(str(tmp_path / "lake"), pattern, paths)
    plan = plan_source(context(), source)
    planned = sum(segment["file_count"] for segment in plan.segments)
    write(tmp_path / "lake/a/late", "x int", (3,))
    write(tmp_path / "lake/a/b", "x int", (4,), mode="append")
    assert bag(plan.rows().drop("_slice")) == sorted([(1,), (2,)] * planned)


def test_files_that_keep_coming(context, write, tmp_path, monkeypatch):
    from tablesync.sources import prefix as module

    write(tmp_path / "lake", "x int", (1,))
    monkeypatch.setattr(module, "scan_digest", lambda frame: ListingDigest(7, (0, 0), -1))
    with pytest.raises(SourceError, match="keep changing"):
        plan_source(context(), PrefixSource(str(tmp_path / "lake")))


def test_disagreeing_files(engine, write, tmp_path):
    write(tmp_path / "lake/a", "x int", (1,))
    write(tmp_path / "lake/b", "x string", ("1",))
    with pytest.raises(SchemaError, match="do not agree"):
        Prefix(engine, str(tmp_path / "lake")).infer_schema()


def test_hidden_files_are_not_listed(engine, write, tmp_path):
    path = write(tmp_path / "lake", "x int", (1,))
    assert "_SUCCESS" in os.listdir(path)
    assert Prefix(engine, path).rollup().first()["file_count"] == 1


def test_listing_opens_no_content(engine, write, tmp_path):
    path = write(tmp_path / "lake", "x int", (1,))
    plan = Prefix(engine, path).files()._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<path:string,modificationTime:timestamp,length:bigint>" in plan
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_glob_characters_are_literal(engine, write, tmp_path):
    write(tmp_path / "lake/a[1]", "x int", (1,))
    write(tmp_path / "lake/a1", "x int", (2,))
    write(tmp_path / "lake/b*{c}", "x int", (3,))
    for suffixes, wanted in ((("a[1]",), [1]), (("b*{c}",), [3]), (("a[1]", "a1"), [1, 2])):
        for pattern in (None, "parquet"):
            prefix = Prefix(engine, str(tmp_path / "lake"), suffixes, pattern)
            assert [row[0] for row in bag(prefix.read())] == wanted
            assert prefix.rollup().agg(F.sum("file_count")).first()[0] == len(wanted)


def test_segments_against_brute_force(engine):
    """Matching by equality of parent directories, on random listings and suffixes."""
    import random
    import re

    random.seed(5)

    def directory():
        return "/".join(random.choice(("a", "b", "a1", "m=1", "m=10")) for _ in range(random.randint(0, 3)))

    for pattern in (None, "^a", "m=1/", "1"):
        rels = sorted({f"{d}/f{n}".lstrip("/") for n, d in enumerate(directory() for _ in range(40))})
        suffixes = [directory() for _ in range(12)]
        listing = engine.createDataFrame(
            [(f"file:/root/{rel}", 1, None) for rel in rels],
            "path string, length long, modificationTime timestamp",
        )
        wanted = []
        for number, suffix in enumerate(suffixes):
            start = f"{suffix}/" if suffix else ""
            for rel in rels:
                name = rel[len(start) :]
                if rel.startswith(start) and (not pattern or re.search(pattern, name)):
                    wanted.append((number, rel))
        found = match_segments(listing, "file:/root", suffixes, pattern).select("segment", "rel")
        assert bag(found) == sorted(wanted, key=str)


def test_covering():
    assert covering(["a/b", "a", "c"]) == ["a", "c"]
    assert covering(["", "a"]) == [""]
    assert covering(["month=1", "month=12"]) == ["month=1", "month=12"]


def test_normalise_suffix(rows):
    frame = rows("s string", (" /a/b/ ",), ("/",), ("a",))
    assert bag(frame.select(normalise_suffix(F.col("s")))) == [("",), ("a",), ("a/b",)]


# --- tables -------------------------------------------------------------------------


@pytest.fixture
def dataset(write, tmp_path):
    root = tmp_path / "dataset"
    write(root / "events_20260101", "id int, v string", (1, "a"))
    write(root / "events_20260102", "v string, id int, extra int", ("b", 2, 9))
    write(root / "events_20260103", "id int", (3,))
    write(root / "other", "id int", (4,))
    return str(root)


@pytest.mark.parametrize(
    "source, wanted",
    [
        ({}, [(1, "a"), (2, "b"), (3, None)]),
        ({"full_refresh_predicates": ("20260102",)}, [(2, "b")]),
        ({"full_refresh_predicates": ("20260101", "20260101")}, [(1, "a"), (1, "a")]),
        (
            {"full_refresh_predicates": ("20260101", "20259999"), "skip_missing": True},
            [(1, "a")],
        ),
    ],
)
def test_shards(context, dataset, source, wanted):
    plan = plan_source(context(), TableSource(dataset, "events_*", **source))
    frame = plan.rows().select("id", *(["v"] if "v" in plan.schema.names else []))
    wanted = [row[: len(frame.columns)] for row in wanted]
    assert bag(frame) == sorted(wanted, key=str)


def test_shards_are_one_scan(engine, dataset):
    plan = Dataset(engine, dataset).read_shards(["events_20260101", "events_20260102"])
    assert plan._jdf.queryExecution().executedPlan().toString().count("FileScan") == 1


def test_first_shard_sets_the_columns(context, dataset):
    plan = plan_source(context(), TableSource(dataset, "events_*"))
    assert plan.schema.names == ["id", "v"]
    assert [segment["table"] for segment in plan.segments] == [
        "events_20260101", "events_20260102", "events_20260103",
    ]


def test_missing_tables(context, dataset):
    suffixes = {"full_refresh_predicates": ("19990101",)}
    with pytest.raises(SourceError, match="not found"):
        plan_source(context(), TableSource(dataset, "events_*", **suffixes))
    plan = plan_source(context(), TableSource(dataset, "events_*", skip_missing=True, **suffixes))
    assert plan.skip_reason and plan.rows is None
    with pytest.raises(SourceError):
        plan_source(context(), TableSource(dataset, "nothing_*"))
    assert plan_source(context(), TableSource(dataset, "nothing", skip_missing=True)).skip_reason


def test_catalog_tables(spark, context, rows):
    spark.sql("CREATE DATABASE IF NOT EXISTS shop")
    for day, value in (("20260101", 1), ("20260102", 2)):
        rows("id int", (value,)).write.mode("overwrite").saveAsTable(f"shop.clicks_{day}")
    plan = plan_source(context(), TableSource("shop", "clicks_*"))
    assert bag(plan.rows().drop("_slice")) == [(1,), (2,)]
    spark.sql("DROP DATABASE shop CASCADE")


def test_time_partitions(context, tmp_path):
    root = tmp_path / "dataset"
    frame = context().engine.sql(
        "SELECT * FROM VALUES (1, DATE'2026-01-31', TIMESTAMP_NTZ'2026-01-31 23:59:59'), "
        "(2, DATE'2026-02-01', TIMESTAMP_NTZ'2026-02-01 00:00:00'), (3, NULL, NULL) AS v(id, d, t)"
    )
    frame.write.mode("overwrite").parquet(str(root / "orders"))
    for column in ("d", "t"):
        for ids, wanted in (
            (("202601",), [1]), (("20260201",), [2]), (("2026",), [1, 2]),
            (("__NULL__",), [3]), (("2026", "202602"), [1, 2, 2]),
        ):
            source = TableSource(
                str(root), "orders", partition=TimePartition(column), full_refresh_predicates=ids
            )
            plan = plan_source(context(), source)
            assert [row[0] for row in bag(plan.rows().drop("_slice"))] == wanted
    hours = TableSource(
        str(root), "orders", partition=TimePartition("t"), full_refresh_predicates=("2026013123",)
    )
    plan = plan_source(context(), hours)
    assert [row[0] for row in bag(plan.rows().drop("_slice"))] == [1]


def test_partition_range_reaches_the_scan(engine, write, tmp_path):
    write(tmp_path / "t", "k int, v int", (1, 1))
    frame = engine.read.parquet(str(tmp_path / "t")).where(
        partition_condition(RangePartition("k", 0, 100, 10), ["10"])
    )
    plan = frame._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(k,10)" in plan and "LessThan(k,20)" in plan


def test_range_partitions(context, write, tmp_path):
    write(tmp_path / "d/t", "k int", (0,), (9,), (10,), (95,), (100,), (-1,), (None,))
    for ids, wanted in (
        (("0",), [0, 9]), (("10", "90"), [10, 95]), (("__UNPARTITIONED__",), [-1, 100]),
        (("__NULL__",), [None]),
    ):
        source = TableSource(
            str(tmp_path / "d"), "t", partition=RangePartition("k", 0, 100, 10),
            full_refresh_predicates=ids,
        )
        plan = plan_source(context(), source)
        assert [row[0] for row in bag(plan.rows().drop("_slice"))] == wanted


def test_partition_counts(engine, rows):
    frame = engine.sql(
        "SELECT TIMESTAMP_NTZ'2026-01-01 10:00:00' + make_interval(0,0,0,0,CAST(id AS int),0,0) AS t "
        "FROM range(48) UNION ALL SELECT NULL"
    )
    ids = ["2026", "202602", "20260102", "2026010223", "__NULL__"]
    assert list(partition_counts(frame, TimePartition("t"), ids).values()) == [48, 0, 24, 1, 1]
    numbers = engine.sql("SELECT id - 5 AS k FROM range(30) UNION ALL SELECT NULL")
    ids = ["0", "10", "__UNPARTITIONED__", "__NULL__"]
    partition = RangePartition("k", 0, 20, 10)
    assert list(partition_counts(numbers, partition, ids).values()) == [10, 10, 10, 1]
    dates = engine.sql("SELECT DATE'2026-03-01' + CAST(id AS int) AS d FROM range(40)")
    assert list(partition_counts(dates, TimePartition("d"), ["202603", "20260409"]).values()) == [31, 1]


def test_a_table_directory_of_two_schemas(context, write, tmp_path):
    write(tmp_path / "d/t", "id int", (1,))
    write(tmp_path / "d/t", "id int, extra string", (2, "x"), mode="append")
    plan = plan_source(context(), TableSource(str(tmp_path / "d"), "t"))
    assert plan.schema.names == ["id", "extra"]
    assert bag(plan.rows().drop("_slice")) == [(1, None), (2, "x")]


@pytest.mark.parametrize(
    "second", ["TIMESTAMP'2026-01-01 00:00:00' AS at, 1 AS k",
               "TIMESTAMP_NTZ'2026-01-01 00:00:00' AS at, CAST(1 AS decimal(9,3)) AS k"],
)
@pytest.mark.parametrize("export", [False, True])
def test_later_shards_are_checked(context, engine, tmp_path, second, export):
    first = "TIMESTAMP_NTZ'2026-01-01 00:00:00' AS at, CAST(1 AS decimal(9,2)) AS k"
    for name, sql in (("e_1", first), ("e_2", second)):
        engine.sql(f"SELECT {sql}").write.parquet(str(tmp_path / "d" / name))
    to = {"export_location": str(tmp_path / "x")} if export else {}
    with pytest.raises(SchemaError):
        plan_source(context(), TableSource(str(tmp_path / "d"), "e_*", **to)).rows()


def test_shards_take_the_first_one_s_columns(context, write, tmp_path):
    write(tmp_path / "d/e_1", "id int, a string", (1, "x"))
    write(tmp_path / "d/e_2", "id int, b string", (2, "y"))
    plan = plan_source(context(), TableSource(str(tmp_path / "d"), "e_*"))
    assert bag(plan.rows().drop("_slice")) == [(1, "x"), (2, None)]


@pytest.mark.parametrize("ids", [("202601", "20260105", "2025"), ("20260105", "__NULL__")])
def test_partitions_are_exported_from_one_scan(engine, tmp_path, ids):
    table = engine.sql(
        "SELECT id, TIMESTAMP_NTZ'2025-12-20 00:00:00' + make_interval(0,0,0,CAST(id AS int)) AS ts "
        "FROM range(40) UNION ALL SELECT 99, NULL"
    )
    table.write.parquet(str(tmp_path / "t"))
    table = engine.read.parquet(str(tmp_path / "t"))
    partition = TimePartition("ts")
    paths = export_partitions(table, partition, ids, str(tmp_path / "x"), "run")
    for path, name in zip(paths, ids):
        wanted = table.where(partition_condition(partition, [name]))
        assert bag(engine.read.parquet(path)) == bag(wanted)
    text = read_partitions_plan(engine, table, partition, ids)
    assert text.count("FileScan parquet") == 1


def read_partitions_plan(engine, table, partition, ids):
    """The plan of the frame an export writes."""
    from tablesync.sources.export import labelled_partitions

    return labelled_partitions(table, partition, ids, "s")._jdf.queryExecution().executedPlan().toString()


def test_partitioning_is_found_in_the_directories(engine, context, tmp_path):
    rows = engine.sql("SELECT id, CAST(id % 3 AS int) AS k, DATE'2026-01-01' + CAST(id AS int) AS d FROM range(9)")
    rows.write.partitionBy("d").parquet(str(tmp_path / "days"))
    rows.write.partitionBy("k").parquet(str(tmp_path / "keys"))
    rows.write.parquet(str(tmp_path / "flat"))
    dataset = Dataset(engine, str(tmp_path))
    assert dataset.partition("days") == TimePartition("d")
    assert dataset.partition("keys") == RangePartition("k", 0, 3, 1)
    assert dataset.partition("flat") is None and dataset.partition("missing") is None
    source = TableSource(str(tmp_path), "days", full_refresh_predicates=("20260103",))
    assert [row["id"] for row in plan_source(context(), source).rows().collect()] == [2]


def test_partitioning_is_found_in_the_catalog(spark, context, tmp_path):
    spark.sql("CREATE DATABASE IF NOT EXISTS found_db")
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS found_db.t (id int, k int) USING parquet PARTITIONED BY (k) "
        f"LOCATION '{tmp_path}/t'"
    )
    spark.sql("INSERT INTO found_db.t VALUES (1, 5), (2, 7)")
    try:
        source = TableSource("found_db", "t", full_refresh_predicates=("7",))
        assert [row["id"] for row in plan_source(context(), source).rows().collect()] == [2]
    finally:
        spark.sql("DROP DATABASE found_db CASCADE")


def test_ranges_are_exported(engine, tmp_path):
    table = engine.sql("SELECT id - 5 AS k FROM range(30) UNION ALL SELECT NULL")
    partition = RangePartition("k", 0, 20, 10)
    ids = ("0", "10", "__UNPARTITIONED__", "__NULL__")
    paths = export_partitions(table, partition, ids, str(tmp_path), "run")
    assert [engine.read.parquet(path).count() for path in paths] == [10, 10, 10, 1]


def test_missing_partition(context, write, tmp_path):
    write(tmp_path / "d/t", "k int", (1,))
    values = {"partition": RangePartition("k", 0, 100, 10), "full_refresh_predicates": ("0", "50")}
    with pytest.raises(SourceError, match="1 of 2"):
        plan_source(context(), TableSource(str(tmp_path / "d"), "t", **values))
    plan = plan_source(
        context(), TableSource(str(tmp_path / "d"), "t", skip_missing=True, **values)
    )
    assert [segment["table"] for segment in plan.segments] == ["t$0"]


def test_mapped_fields_convert(context, engine, tmp_path):
    frame = engine.sql("SELECT TIMESTAMP'2026-01-01 12:00:00Z' AS at, 1.5D AS amount")
    frame.write.parquet(str(tmp_path / "d/t"))
    fields = ({"name": "at", "type": "TIMESTAMP"}, {"name": "amount", "type": "NUMERIC"})
    plan = plan_source(context(), TableSource(str(tmp_path / "d"), "t", schema_fields=fields))
    loaded = plan.rows().drop("_slice")
    assert [kind for _, kind in loaded.dtypes] == ["timestamp_ntz", "decimal(38,9)"]
    assert str(loaded.first()[0]) == "2026-01-01 12:00:00"


# --- SQL ----------------------------------------------------------------------------


def test_sql_sees_the_callers_views(spark, context, rows, tmp_path):
    rows("id int, at string", (1, "a"), (2, "b"), (3, None)).createOrReplaceTempView("mine")
    source = SqlSource(
        "SELECT * FROM mine;",
        str(tmp_path / "staging"),
        full_refresh_predicates=("at = 'a'", "id = 3"),
    )
    plan = plan_source(context(), source)
    assert bag(plan.rows().drop("_slice")) == [(1, "a"), (3, None)]


def test_predicates_quote_as_the_delete_does(context, rows, tmp_path):
    rows('st string, `a"b` int', ("F", 1), ("O", 2)).createOrReplaceTempView("quoting")

    def found(predicate):
        source = SqlSource("SELECT * FROM quoting", str(tmp_path), full_refresh_predicates=(predicate,))
        return bag(plan_source(context(), source).rows().drop("_slice"))

    assert found("\"st\" = 'F'") == [("F", 1)]
    assert found("\"a\"\"b\" = 2") == [("O", 2)]
    assert found("st = '\"F\"' OR `st` = 'O'") == [("O", 2)]
    assert found("'st' = 'F'") == []  # names no column, and stays a comparison of texts
    assert found("1 = 1") == [("F", 1), ("O", 2)]


def test_staging_reuse(spark, context, rows, tmp_path):
    def runs(**changes):
        values = {"sql": "SELECT * FROM changing", "staging_location": str(tmp_path / "s")}
        run_id = f"run{next(counter)}"
        plan = plan_source(context(run_id=run_id), SqlSource(**(values | changes)))
        return len(plan.job_references), bag(plan.rows().drop("_slice"))

    counter = iter(range(100))
    rows("id int", (1,)).createOrReplaceTempView("changing")
    assert runs() == (1, [(1,)])
    rows("id int", (2,)).createOrReplaceTempView("changing")
    assert runs() == (0, [(1,)])
    assert runs(force_rebuild=True) == (1, [(2,)])
    rows("id int", (3,)).createOrReplaceTempView("changing")
    assert runs() == (0, [(2,)])
    assert runs(reuse=False) == (1, [(3,)])
    assert runs(predicate_type="none") == (1, [(3,)])  # a staging of its own
    assert runs(identity="other") == (1, [(3,)])
    assert runs(reuse=False, staging_hours=-1) == (1, [(3,)])
    assert runs() == (1, [(3,)])  # the one before has expired
    exported = {"export_location": str(tmp_path / "e")}
    assert runs(**exported) == (1, [(3,)])  # the export still runs


# --- export -------------------------------------------------------------------------


@pytest.mark.parametrize(
    "codec, wanted", [("NONE", "UNCOMPRESSED"), ("SNAPPY", "SNAPPY"), ("GZIP", "GZIP"), ("ZSTD", "ZSTD")]
)
def test_export_codecs(rows, tmp_path, codec, wanted):
    import pyarrow.parquet as pq

    frame = rows("id int, segment_name string", (1, "x"), (2, "y"))
    slices = [frame.where("id = 1"), frame.where("id = 2")]
    paths = export_slices(slices, str(tmp_path), "run", codec)
    assert [path.rpartition("/")[2] for path in paths] == ["segment=00000", "segment=00001"]
    for path in paths:
        files = [name for name in os.listdir(path) if name.endswith(".parquet")]
        assert files
        meta = pq.ParquetFile(f"{path}/{files[0]}").metadata
        assert meta.row_group(0).column(0).compression == wanted
    assert bag(read_export(frame, str(tmp_path), "run")) == [(1, "x"), (2, "y")]


def test_export_keeps_a_column_called_segment(rows, tmp_path):
    frame = rows("id int, segment string", (1, "x"))
    (path,) = export_slices([frame], str(tmp_path), "run")
    assert path.endswith("/segment_=00000")
    assert bag(read_export(frame, str(tmp_path), "run")) == [(1, "x")]


def _builds(stage):
    return sorted(name for name in os.listdir(stage) if name[0] not in "._")


def test_expired_builds_are_dropped_unless_leased(spark, context, rows, tmp_path):
    rows("id int", (1,)).createOrReplaceTempView("built")
    source = SqlSource("SELECT * FROM built", str(tmp_path / "s"), reuse=False, staging_hours=0)
    first = plan_source(context(run_id="one"), source)
    second = plan_source(context(run_id="two"), source)
    stage = tmp_path / "s" / os.listdir(tmp_path / "s")[0]
    assert _builds(stage) == ["one", "two"]  # both are leased
    second.close()
    plan_source(context(run_id="three"), source).close()
    assert _builds(stage) == ["one", "three"]
    assert bag(first.rows()) == [(1,)]
    os.utime(stage / "_leases" / "one--one", (1, 1))  # a run that died long ago
    plan_source(context(run_id="four"), source).close()
    assert _builds(stage) == ["four"]
    first.close()


def test_builds_at_once_leave_a_record_each(context, rows, tmp_path):
    rows("id int", (1,)).createOrReplaceTempView("at_once")
    source = SqlSource("SELECT * FROM at_once", str(tmp_path / "s"), reuse=False)
    with ThreadPoolExecutor(max_workers=4) as pool:
        plans = list(pool.map(lambda n: plan_source(context(run_id=f"run{n}"), source), range(4)))
    stage = tmp_path / "s" / os.listdir(tmp_path / "s")[0]
    records = [name for name in os.listdir(stage / "_builds") if name.endswith(".json") and name[0] != "."]
    assert sorted(records) == [f"run{n}.json" for n in range(4)]
    assert all(bag(plan.rows()) == [(1,)] for plan in plans)
    again = plan_source(context(run_id="later"), SqlSource("SELECT * FROM at_once", str(tmp_path / "s")))
    assert again.job_references == []
    for plan in [*plans, again]:
        plan.close()


def test_partitions_exist_by_their_directories(engine, context, tmp_path, monkeypatch):
    """Whether partitions exist is known without a scan: data files may even be unreadable."""
    from tablesync.sources import tables as module

    days = "SELECT id AS k, date_add(DATE'2026-01-30', CAST(id % 30 AS int)) AS day FROM range(90)"
    null = "SELECT -1L, CAST(NULL AS date)"
    engine.sql(f"{days} UNION ALL {null}").write.partitionBy("day").parquet(str(tmp_path / "d/t"))
    plans = []

    def counted(table, partition, ids):
        plans.append(table._jdf.queryExecution().optimizedPlan().toString())
        return partition_counts(table, partition, ids)

    monkeypatch.setattr(module, "partition_counts", counted)
    source = TableSource(
        str(tmp_path / "d"), "t", partition=TimePartition("day"), skip_missing=True,
        full_refresh_predicates=("20260131", "202602", "202604", "__NULL__"),
    )
    plan = plan_source(context(), source)
    assert [s["table"] for s in plan.segments] == ["t$20260131", "t$202602", "t$__NULL__"]
    assert "parquet" not in plans[0].lower() and "LogicalRDD" in plans[0] or "LocalRelation" in plans[0]
    assert plan.rows().count() == 3 + 3 * 28 + 1


def test_a_swapped_file_is_noticed(context, write, rows, tmp_path, monkeypatch):
    """One file goes and one comes between the two listings: the counts agree, the plan is made
    again all the same, and rows and segments are those of the files that are there."""
    lake = tmp_path / "lake"
    write(lake / "a", "id int", (1,))
    write(lake / "b", "id int", (2,), (3,))
    read, swaps = Prefix.read, [1]

    def swapped(self, *args, **kwargs):
        if swaps:
            swaps.pop()
            write(lake / "c d+e", "id int", (7,), (8,), (9,))
            for name in os.listdir(lake / "a"):
                os.unlink(lake / "a" / name)
        return read(self, *args, **kwargs)

    monkeypatch.setattr(Prefix, "read", swapped)
    listed = []
    monkeypatch.setattr(
        prefix_module, "scan_digest", lambda frame: listed.append(1) or scan_digest(frame)
    )
    plan = plan_source(context(), PrefixSource(str(lake)))
    assert len(listed) == 2 and not swaps
    assert plan.segments[0]["file_count"] == 2
    assert sorted(row["id"] for row in plan.rows().collect()) == [2, 3, 7, 8, 9]


def test_a_pattern_hands_back_directories(engine, write, rows, tmp_path):
    """Directories that are selected whole stand for their files; others name the files."""
    for name in ("y=1/m=10", "y=1/m=11", "y=1/m=2", "y=2/m=10", "y=3"):
        write(tmp_path / "lake" / name, "x int", (1,))
        write(tmp_path / "lake" / name, "x int", (2,), mode="append")
    write(tmp_path / "lake/y=2/m=10/deeper", "x int", (3,))
    (tmp_path / "lake/y=3/notes.txt").write_text("not parquet")
    prefix = Prefix(engine, str(tmp_path / "lake"), ("",), r"(m=1[01]/|y=3/.*)[^/]*parquet$")
    found = sorted(path.split("/lake/")[1] for path, _ in named_paths(prefix.files(others=True)))
    assert [p for p in found if not p.endswith(".parquet")] == ["y=1/m=10", "y=1/m=11"]
    assert len(found) == 2 + 2 + 2  # and two files each of y=2/m=10 and y=3
    assert sorted(row["x"] for row in prefix.read().collect()) == [1, 1, 1, 1, 2, 2, 2, 2]
    twice = Prefix(engine, str(tmp_path / "lake"), ("y=1", "y=1/m=10"), "parquet$")
    assert sorted(row["x"] for row in twice.read().collect()) == [1, 1, 1, 1, 2, 2, 2, 2]
    whole = {path.split("/lake/")[1]: n for path, n in named_paths(twice.files(others=True))}
    assert whole["y=1/m=11"] == 1 and sorted(whole.values()) == [1, 1, 2, 2]


def test_digests_do_not_depend_on_order(rows):
    files = [("/x/a", 1), ("/x/b", 2), ("/x/c", 3)]
    one = listing_digest(rows("path string, length long", *files))
    assert one == listing_digest(rows("path string, length long", *files[::-1]))
    assert one != listing_digest(rows("path string, length long", *files[:2], ("/x/d", 3)))
    assert one != listing_digest(rows("path string, length long", *files[:2], ("/x/c", 4)))
    assert listing_digest(rows("path string, length long")).count == 0
