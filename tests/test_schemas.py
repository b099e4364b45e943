from __future__ import annotations

import pytest
from pyspark.sql import types as T

from tablesync import ColumnSpec, SchemaError
from tablesync.operators.load import check_file_types
from tablesync.plans.evolution import check_compatible, plan_evolution
from tablesync.plans.types import (
    declared_type,
    map_declared_columns,
    map_source_schema,
    normalise_inferred,
    view_aliases,
)


def ddl(text):
    return T.StructType.fromDDL(text)


# --- mapped -----------------------------------------------------------------------


def test_mapped_scalars():
    kinds = {
        "l_orderkey": ("INTEGER", "bigint"), "l_partkey": ("INT64", "bigint"),
        "l_quantity": ("FLOAT", "double"), "l_tax": ("DOUBLE", "double"),
        "l_discount": ("DECIMAL", "decimal(38,9)"), "l_returnflag": ("STRING", "string"),
        "l_shipdate": ("DATE", "date"), "l_commit": ("DATETIME", "timestamp_ntz"),
        "l_loaded": ("TIMESTAMP", "timestamp_ntz"), "l_open": ("BOOLEAN", "boolean"),
        "l_digest": ("BYTES", "binary"),
    }
    fields = [{"name": name, "type": kind} for name, (kind, _) in kinds.items()]
    fields[0]["mode"] = "REQUIRED"
    schema = map_source_schema(fields)
    found = {field.name: field.dataType.simpleString() for field in schema}
    assert found == {name: wanted for name, (_, wanted) in kinds.items()}
    assert [field.name for field in schema if not field.nullable] == ["l_orderkey"]


def test_mapped_nested():
    part = {
        "name": "part",
        "type": "STRUCT",
        "fields": [{"name": "brand", "type": "STRING"}, {"name": "size", "type": "INT64"}],
    }
    schema = map_source_schema(
        [
            part,
            part | {"name": "rivals", "mode": "REPEATED"},
            {"name": "ship_dates", "type": "DATE", "mode": "REPEATED"},
        ]
    )
    inner = "struct<brand:string,size:bigint>"
    assert schema.simpleString() == (
        f"struct<part:{inner},rivals:array<{inner}>,ship_dates:array<date>>"
    )
    assert all(field.nullable for field in schema)


@pytest.mark.parametrize(
    "field",
    [
        *({"name": "x", "type": kind} for kind in (
            "BIGNUMERIC", "BIGDECIMAL", "JSON", "GEOGRAPHY", "TIME", "INTERVAL", "", "RECORD")),
        {"name": "x", "type": "BYTES", "mode": "REPEATED"},
        {"type": "STRING"},
    ],
)
def test_mapped_rejected(field):
    with pytest.raises(SchemaError):
        map_source_schema([field])


def test_alias_collision():
    fields = [{"name": "ShipDate", "type": "DATE"}, {"name": "ship date", "type": "STRING"}]
    with pytest.raises(SchemaError, match="ship_date"):
        map_source_schema(fields)


# --- inferred -----------------------------------------------------------------------


def test_inferred_order_and_small_types(spark):
    schema = ddl("b smallint, a tinyint, f float, p struct<x:float,l:array<struct<s:smallint>>>")
    assert normalise_inferred(schema).simpleString() == (
        "struct<b:int,a:int,f:double,p:struct<x:double,l:array<struct<s:int>>>>"
    )


@pytest.mark.parametrize(
    "kind", [T.VariantType(), T.DayTimeIntervalType(), T.YearMonthIntervalType(), T.NullType()]
)
def test_inferred_rejected(kind):
    with pytest.raises(SchemaError, match="not supported"):
        normalise_inferred(T.StructType([T.StructField("x", T.ArrayType(kind))]))


# --- declared -----------------------------------------------------------------------


@pytest.mark.parametrize(
    "text, wanted",
    [
        ("VARCHAR", "string"), ("varchar(20)", "string"), ("TEXT", "string"),
        ("NUMBER(19, 0)", "bigint"), ("NUMBER", "decimal(38,0)"), ("NUMBER(12,2)", "decimal(12,2)"),
        ("FLOAT", "double"), ("TIMESTAMP_NTZ(6)", "timestamp_ntz"),
        ("TIMESTAMP_LTZ(6)", "timestamp"), ("BIGINT", "bigint"), ("boolean", "boolean"),
        ("struct<a:string,b:array<int>>", "struct<a:string,b:array<int>>"),
        ("map<string,int>", "map<string,int>"),
    ],
)
def test_declared_types(spark, text, wanted):
    assert declared_type(text).simpleString() == wanted


@pytest.mark.parametrize("text", ["GEOGRAPHY", "VECTOR(FLOAT, 3)", "nonsense", "variant"])
def test_declared_rejected(spark, text):
    with pytest.raises(SchemaError):
        declared_type(text)


def test_declared_columns(spark):
    size = "size(split(p_name, ' '))"
    schema = map_declared_columns(
        [
            ColumnSpec("p_name", "TEXT", alias="words", expression=size),
            ColumnSpec("PartKey", "NUMBER(19,0)", nullable=False),
            ColumnSpec("p_retailprice", "double"),
        ]
    )
    assert [f.nullable for f in schema] == [True, False, True]
    assert view_aliases(schema) == ["words", "part_key", "p_retailprice"]
    assert [(f.metadata or {}).get("expression") for f in schema] == [size, None, None]
    with pytest.raises(SchemaError):
        map_declared_columns([])


# --- evolution ----------------------------------------------------------------------


@pytest.mark.parametrize(
    "name, old, new, altered, wanted, actions",
    [
        ("same", "k bigint, note string", "k bigint, note string", False, None, []),
        ("append", "k bigint", "k bigint, v double, d date", True, "k bigint, v double, d date",
         ["add_column", "add_column"]),
        ("add in front", "line struct<tax:double>", "line struct<flag:string,tax:double>", True,
         "line struct<flag:string,tax:double>", ["add_field"]),
        ("reorder three", "line struct<x:int,y:int,z:int>", "line struct<z:int,x:int,y:int>", True,
         "line struct<z:int,x:int,y:int>", ["reorder"]),
        ("widen two", "line struct<x:int,y:decimal(8,3)>", "line struct<x:bigint,y:decimal(20,3)>",
         True, "line struct<x:bigint,y:decimal(20,3)>", ["widen", "widen"]),
        ("keep in the middle", "line struct<x:int,gone:date,y:int>", "line struct<x:int,y:int>",
         False, "line struct<x:int,y:int,gone:date>", ["keep"]),
        ("three levels", "a struct<b:struct<c:struct<x:int>>>",
         "a struct<b:struct<c:struct<x:int,y:array<int>>>>", True,
         "a struct<b:struct<c:struct<x:int,y:array<int>>>>", ["add_field"]),
        ("array in a struct", "o struct<lines:array<struct<n:int>>>",
         "o struct<lines:array<struct<n:bigint,flag:string>>>", True,
         "o struct<lines:array<struct<n:bigint,flag:string>>>", ["widen", "add_field"]),
        ("all at once", "e struct<user:int,kind:string,old:date>",
         "e struct<kind:string,user:bigint,value:double>", True,
         "e struct<kind:string,user:bigint,value:double,old:date>",
         ["widen", "add_field", "reorder", "keep"]),
        ("rename", "e struct<user:int>", "e struct<account:int>", True,
         "e struct<account:int,user:int>", ["add_field", "keep"]),
        ("spelling", "e struct<UserName:string>", "e struct<USERNAME:string>", False,
         "e struct<UserName:string>", []),
        ("map", "m map<int,date>", "m map<int,date>", False, None, []),
    ],
)
def test_evolution(spark, name, old, new, altered, wanted, actions):
    plan = plan_evolution(ddl(old), ddl(new))
    assert plan.altered == altered
    assert plan.schema.simpleString() == ddl(wanted or old).simpleString()
    assert [change.action for change in plan.changes] == actions
    assert len(plan.warnings) == actions.count("keep")


@pytest.mark.parametrize(
    "old, new, message",
    [
        ("a int, b int", "a int", "removed"),
        ("a int, b int", "b int, a int", "reordered"),
        ("a int", "b int", "renamed"),
        ("a int", "A int", "renamed"),
        ("a int", "a bigint", "incompatible type change"),
        ("a decimal(10,2)", "a decimal(12,2)", "incompatible type change"),
        ("a timestamp", "a timestamp_ntz", "incompatible type change"),
        ("a int", "a int, A string", "case"),
        ("p struct<a:string>", "p struct<a:boolean>", "incompatible type change"),
        ("p struct<a:bigint>", "p struct<a:int>", "incompatible type change"),
        ("p struct<a:decimal(10,2)>", "p struct<a:decimal(12,3)>", "incompatible type change"),
        ("p struct<a:string>", "p string", "incompatible type change"),
        ("p array<struct<a:int>>", "p struct<a:int>", "incompatible type change"),
        ("m map<string,int>", "m map<string,bigint>", "incompatible type change"),
        ("p struct<a:string>", "p struct<a:string,A:string>", "duplicate nested"),
    ],
)
def test_evolution_rejected(spark, old, new, message):
    with pytest.raises(SchemaError, match=message):
        check_compatible(ddl(old), ddl(new))


def test_nested_required_survives(spark):
    old = ddl("p struct<a:string not null>")
    plan = plan_evolution(old, ddl("p struct<a:string,b:string not null>"))
    inner = plan.schema["p"].dataType
    assert not inner["a"].nullable and inner["b"].nullable


def test_counts_and_report(spark):
    plan = plan_evolution(
        ddl("p struct<a:int>, q struct<x:int,y:int>"),
        ddl("p struct<a:bigint,b:int>, q struct<x:int>, r int, s int"),
    )
    assert plan.added_columns == ["r", "s"] and plan.altered_columns == ["p"]
    counts = dict(plan.to_dataframe(spark).groupBy("action").count().collect())
    assert counts == {"widen": 1, "add_field": 1, "keep": 1, "add_column": 2}


# --- strict load --------------------------------------------------------------------


@pytest.mark.parametrize(
    "files, table",
    [
        ("a int, extra string", "a int, b string"),
        ("a int", "a bigint"),
        ("a float, b smallint", "a double, b int"),
        ("p struct<a:int,z:int>", "p struct<a:bigint,b:string>"),
    ],
)
def test_files_fit(spark, files, table):
    check_file_types(ddl(files), ddl(table))


@pytest.mark.parametrize(
    "files, table",
    [
        ("a string", "a int"),
        ("a bigint", "a int"),
        ("a timestamp", "a timestamp_ntz"),
        ("a timestamp_ntz", "a timestamp"),
        ("p struct<a:string>", "p struct<a:int>"),
        ("p array<struct<a:timestamp>>", "p array<struct<a:timestamp_ntz>>"),
        ("m map<string,string>", "m map<string,int>"),
    ],
)
def test_files_do_not_fit(spark, files, table):
    with pytest.raises(SchemaError, match="full_ingest"):
        check_file_types(ddl(files), ddl(table))
