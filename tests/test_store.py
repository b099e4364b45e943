from __future__ import annotations

import os
import time
from datetime import UTC, datetime, timedelta
from types import SimpleNamespace

import pytest
from frames import bag
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablesync import ManagedTable, PublishConflict, SchemaError
from tablesync.operators.load import (
    convert,
    delete_and_copy,
    enforce_not_null,
    keep_filter,
    project_by_name,
)
from tablesync.operators.lease import held
from tablesync.operators.slicing import SLICE, check_names
from tablesync.operators.store import LAPSE, Part, era_schema
from tablesync.plans.evolution import plan_evolution
from tablesync.session import Files, engine_session, scratch_dir


@pytest.fixture(scope="module")
def engine(spark):
    return engine_session(spark)


@pytest.fixture
def table(engine, tmp_path):
    """Values 0..39 in four slices of ten, one directory."""
    managed = ManagedTable(engine, str(tmp_path / "t"))
    frame = engine.range(0, 40, 1, 4)
    managed.create(frame.schema, "first")
    tens = frame.withColumn(SLICE, F.concat(F.lit("t"), F.floor(F.col("id") / 10).cast("string")))
    managed.publish(managed.head(), frame.schema, (), "first", [managed.write(tens, "first")])
    return managed


def apply(table, predicate, name):
    deletion = table.delete(table.head(), predicate)
    added = [] if deletion.rewritten is None else [table.write(deletion.rewritten, name)]
    table.publish(table.head(), table.head().schema, deletion.kept, name, added)
    return deletion


def test_create_once(table):
    assert table.version_numbers() == [0, 1]
    assert not table.create(table.head().schema, "again")
    assert table.read(table.version(0)).count() == 0


def test_second_publisher_loses(table):
    head = table.head()
    table.publish(head, head.schema, head.parts, "one")
    with pytest.raises(PublishConflict):
        table.publish(head, head.schema, (), "two")
    assert table.head().run_id == "one"
    assert not [n for n in os.listdir(f"{table.location}/_versions") if ".json." in n and "crc" not in n]


def test_no_table(engine, tmp_path):
    managed = ManagedTable(engine, str(tmp_path / "none"))
    assert not managed.exists()
    with pytest.raises(SchemaError, match="no managed table"):
        managed.head()


def test_delete_touches_only_hit_slices(table):
    deletion = apply(table, "id >= 5 AND id < 20", "second")
    assert (deletion.slices_dropped, deletion.slices_rewritten, deletion.rows_deleted) == (1, 1, 15)
    assert sorted(row[0] for row in table.read().collect()) == [*range(5), *range(20, 40)]
    assert table.head().parts == (Part("first", ("t2", "t3"), 4), Part("second", ("t0",), 1))
    again = apply(table, "id < 5", "third")
    assert (again.slices_dropped, again.slices_rewritten) == (1, 0)
    assert [part.directory for part in table.head().parts] == ["first"]
    everything = apply(table, "id >= 0", "fourth")
    assert everything.slices_dropped == 2 and table.head().parts == ()
    assert table.read().count() == 0


def test_a_repeated_slice_leaves_one_directory(table, engine):
    """Loading a slice again and again: no file is named and the record does not grow."""
    sizes, names = set(), set()
    for run in range(12):
        head = table.head()
        deletion = table.delete(head, "id BETWEEN 10 AND 19")
        rows = engine.range(10, 20).withColumn(SLICE, F.lit("t1"))
        written = table.write(rows, f"run{run:02d}")
        assert deletion.rewritten is None and deletion.rows_deleted == 10
        table.publish(head, head.schema, deletion.kept, f"run{run:02d}", [written])
        text = table.head().to_json()
        sizes.add(len(text) - len(str(table.head().number)))
        names.update(text.split(".parquet")[1:])
    assert max(sizes) - min(sizes) <= 2 and not names
    assert table.head().parts[1:] == (Part("run11", ("t1",), 1),)
    assert sorted(row[0] for row in table.read().collect()) == list(range(40))


def test_plans_name_directories_only(table):
    apply(table, "id BETWEEN 10 AND 12", "second")
    plan = table.read()._jdf.queryExecution().toString()
    assert "IN (" not in plan and "part-" not in plan


def test_delete_without_hits_or_predicate(table):
    head = table.head()
    assert table.delete(head, "id > 100").kept == head.parts
    assert table.delete(head, "id IS NULL").rewritten is None
    assert table.delete(head, None).kept == ()


def test_delete_equals_the_whole_table_rewrite(table, engine):
    """Brute force: the slice-wise delete keeps exactly what the algebra keeps."""
    for number, predicate in enumerate(
        ("id % 7 = 0", "id BETWEEN 8 AND 12", "id IN (1, 39)", "nullif(id, 15) > 30")
    ):
        wanted = bag(table.read().where(keep_filter(predicate)))
        apply(table, predicate, f"run{number}")
        assert bag(table.read()) == wanted


def test_predicate_reaches_the_scan(table):
    frame = table.read().where("id >= 5")
    plan = frame._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(id), GreaterThanOrEqual(id,5)]" in plan


def test_expire(table):
    apply(table, "id < 5", "second")
    apply(table, "id < 10", "third")
    assert table.expire(retention_days=7)["versions"] == 0
    later = datetime.now(UTC) + timedelta(days=8)
    done = table.expire(retention_days=7, now=later)
    assert done == {"versions": 3, "slices": 2, "unpublished": 0}
    assert table.version_numbers() == [3]
    assert not os.path.exists(f"{table.location}/data/first/{SLICE}=t0")
    assert table.read().count() == 30
    assert table.expire(retention_days=0)["versions"] == 0


def test_expire_keeps_what_an_unexpired_version_needs(table):
    apply(table, "id < 10", "second")
    now = datetime.now(UTC)
    assert table.expire(retention_days=0, now=now - timedelta(minutes=5))["versions"] == 0
    assert table.read(table.version(1)).count() == 40


def test_leftovers_of_interrupted_runs(table, engine):
    """An unpublished directory is never read, and goes once it is old, unless its run lives."""
    table.write(engine.range(5), "crashed")
    table.write(engine.range(5), "running-kept-1")
    assert table.read().count() == 40
    assert table.expire(retention_days=0)["unpublished"] == 0
    later = datetime.now(UTC) + LAPSE + timedelta(minutes=1)
    with table.lease("running"):
        lease = f"{table.location}/_leases/running"
        os.utime(lease, (later.timestamp(), later.timestamp()))  # renewed a moment ago
        assert table.expire(retention_days=7, now=later)["unpublished"] == 1
        assert sorted(os.listdir(f"{table.location}/data")) == ["first", "running-kept-1"]
    assert not os.path.exists(lease)
    assert table.expire(retention_days=7, now=later)["unpublished"] == 1
    assert os.listdir(f"{table.location}/data") == ["first"] and table.read().count() == 40


def test_a_lease_is_renewed(engine, tmp_path):
    files, path = Files(engine, str(tmp_path)), str(tmp_path / "lease")
    with held(files, path, renewal=0.05):
        os.utime(path, (1, 1))
        for _ in range(100):
            if files.modified(path) > 1:
                break
            time.sleep(0.05)
        assert files.modified(path) > 1
    assert not files.exists(path)


def test_whole_directory_stays_one_entry(table):
    part = Part("first", ("t0", "t1", "t2", "t3"), 4)
    assert table.head().parts == (part,) and part.paths() == ["first"]


def test_files_of_an_era_are_cast(engine, tmp_path):
    """Integers kept as decimals are read with their own type, whatever the reader can do."""
    managed = ManagedTable(engine, str(tmp_path / "eras"))
    old = engine.sql(
        "SELECT id, named_struct('n', CAST(if(id = 0, 9999999999, id) AS DECIMAL(10,0)), 'gone', 1) "
        "AS p, array(named_struct('m', CAST(-id AS DECIMAL(4,0)))) AS a FROM range(3)"
    )
    managed.create(old.schema, "old")
    managed.publish(managed.head(), old.schema, (), "old", [managed.write(old, "old")])
    new = T.StructType.fromDDL(
        "id bigint, p struct<n:bigint,gone:int,more:string>, a array<struct<m:bigint>>"
    )
    plan = plan_evolution(managed.head().schema, new)
    assert {c.path: c.action for c in plan.changes}["p.n"] == "widen"
    head = managed.publish(managed.head(), plan.schema, managed.head().parts, "evolve")
    assert era_schema(head.eras[0], head.schema)["p"].dataType["n"].dataType == T.DecimalType(10, 0)
    rows = managed.read().orderBy("id").collect()
    assert [row["p"]["n"] for row in rows] == [9999999999, 1, 2]
    assert [row["a"][0]["m"] for row in rows] == [0, -1, -2]
    assert managed.read().schema["p"].dataType["n"].dataType == T.LongType()
    deletion = managed.delete(head, "p.n = 9999999999")
    assert deletion.rows_deleted == 1 and deletion.slices_rewritten == 1
    written = managed.write(deletion.rewritten, "kept")
    managed.publish(head, head.schema, deletion.kept, "kept", [written])
    assert managed.head().eras[0]["p"].dataType["n"].dataType == T.LongType()
    assert managed.read().count() == 2


@pytest.mark.parametrize(
    "old, new, fits",
    [("decimal(10,0)", "bigint", True), ("decimal(1,0)", "bigint", True),
     ("decimal(11,0)", "bigint", False), ("decimal(10,1)", "bigint", False),
     ("decimal(10,0)", "int", False), ("bigint", "decimal(19,0)", False)],
)
def test_decimals_to_bigint(old, new, fits):
    stored = T.StructType.fromDDL(f"p struct<n:{old}>")
    wanted = T.StructType.fromDDL(f"p struct<n:{new}>")
    if fits:
        assert plan_evolution(stored, wanted).schema == wanted
    else:
        with pytest.raises(SchemaError, match="incompatible type change"):
            plan_evolution(stored, wanted)
    with pytest.raises(SchemaError, match="incompatible type change"):  # never at the top level
        plan_evolution(T.StructType.fromDDL(f"n {old}"), T.StructType.fromDDL(f"n {new}"))


def test_a_decimal_beyond_bigint_is_an_error(engine):
    source = engine.sql("SELECT named_struct('n', CAST('9223372036854775808' AS DECIMAL(38,0))) AS p")
    with pytest.raises(Exception, match="OVERFLOW"):
        convert(source, T.StructType.fromDDL("p struct<n:bigint>")).collect()


def test_reserved_names(engine):
    with pytest.raises(SchemaError, match="not available"):
        check_names(T.StructType.fromDDL("a int, _Slice string"))


def test_put_if_absent(engine, tmp_path):
    files = Files(engine, str(tmp_path))
    files.put_if_absent(f"{tmp_path}/a.json", "one")
    with pytest.raises(PublishConflict):
        files.put_if_absent(f"{tmp_path}/a.json", "two")
    assert files.read_text(f"{tmp_path}/a.json") == "one"
    files.write_text(f"{tmp_path}/a.json", "ü")
    assert files.read_text(f"{tmp_path}/a.json") == "ü"
    assert files.names(f"{tmp_path}/missing") == []


# --- row operators --------------------------------------------------------------------


def test_null_predicate_keeps_rows(rows):
    current = rows("id int, v int", (1, 5), (2, None), (3, 1))
    incoming = rows("id int, v int", (9, 9))
    assert bag(delete_and_copy(current, "v > 3", incoming)) == [(2, None), (3, 1), (9, 9)]
    assert bag(delete_and_copy(current, None, incoming)) == [(9, 9)]


def test_project_by_name(engine):
    source = engine.sql("SELECT 1 AS b, 'x' AS extra, 2L AS A, named_struct('Y', 1, 'x', 2) AS p")
    schema = T.StructType.fromDDL("a bigint, b bigint, p struct<x:bigint,y:int,z:string>")
    frame = project_by_name(source, schema)
    assert frame.first().asDict(recursive=True) == {
        "a": None, "b": 1, "p": {"x": 2, "y": 1, "z": None},
    }
    with pytest.raises(Exception, match="CAST|INVALID"):
        project_by_name(source, T.StructType.fromDDL("extra int")).collect()


def test_convert(engine):
    source = engine.sql("SELECT '1.5' AS a, 'x y' AS `b c`")
    schema = T.StructType(
        [
            T.StructField("a", T.DoubleType()),
            T.StructField("b", T.StringType(), True, {"expression": 'upper($1:"b c")'}),
            T.StructField("c", T.DateType()),
        ]
    )
    assert convert(source, schema).collect() == [(1.5, "X Y", None)]


@pytest.mark.parametrize(
    "ddl, value, fails",
    [
        ("a int not null", "1", False),
        ("a int not null", "CAST(NULL AS int)", True),
        ("a struct<b:int not null>", "named_struct('b', 1)", False),
        ("a struct<b:int not null>", "named_struct('b', CAST(NULL AS int))", True),
        ("a struct<b:int not null>", "CAST(NULL AS struct<b:int>)", False),
        ("a struct<s:struct<b:int not null>>", "named_struct('s', named_struct('b', CAST(NULL AS int)))", True),
        ("a array<struct<b:int not null>>", "array(named_struct('b', 1))", False),
        ("a array<struct<b:int not null>>", "array(named_struct('b', CAST(NULL AS int)))", True),
        ("a array<struct<b:int not null>>", "array(CAST(NULL AS struct<b:int>))", False),
    ],
)
def test_not_null(engine, ddl, value, fails):
    schema = T.StructType.fromDDL(ddl)
    checked = enforce_not_null(engine.sql(f"SELECT {value} AS a"), schema)
    if fails:
        with pytest.raises(Exception, match="NULL in NOT NULL column a"):
            checked.collect()
    else:
        assert checked.count() == 1 and checked.collect()


@pytest.mark.parametrize(
    ("master", "given", "checkpoint", "base"),
    [
        ("spark://host:7077", "/mnt/shared", None, "/mnt/shared"),
        ("spark://host:7077", "file:///mnt/shared/", None, "file:///mnt/shared"),
        ("spark://host:7077", None, "hdfs:///checkpoints", "hdfs:///checkpoints"),
        ("spark://host:7077", None, None, "file:/warehouse"),
        ("local-cluster[3,2,1024]", None, None, "file:/warehouse"),
    ],
)
def test_scratch_is_in_a_shared_folder(master, given, checkpoint, base):
    settings = {"spark.sql.warehouse.dir": "file:/warehouse", "spark.checkpoint.dir": given}
    context = SimpleNamespace(master=master, getCheckpointDir=lambda: checkpoint)
    spark = SimpleNamespace(
        conf=SimpleNamespace(get=lambda key, default=None: settings[key] or default),
        sparkContext=context, _jvm=None,
    )
    assert scratch_dir(spark, "x").startswith(f"{base}/tablesync-x-")
