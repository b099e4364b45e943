"""Schemas: mapped from a source description, inferred from files, or declared.

All three end as a ``StructType``. A declared alias or expression travels in the
field's metadata, so a schema is all the view needs.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Mapping
from typing import Any

from pyspark.sql import types as T

from ..errors import SchemaError
from ..functions.naming import snake_name

# Source type names and the Spark types they load as. Date-times
# with and without a zone both become wall-clock (UTC) timestamps.
SOURCE_TYPES: dict[str, T.DataType] = {
    "STRING": T.StringType(),
    "INT64": T.LongType(),
    "INTEGER": T.LongType(),
    "FLOAT64": T.DoubleType(),
    "FLOAT": T.DoubleType(),
    "DOUBLE": T.DoubleType(),
    "BOOL": T.BooleanType(),
    "BOOLEAN": T.BooleanType(),
    "DATE": T.DateType(),
    "DATETIME": T.TimestampNTZType(),
    "TIMESTAMP": T.TimestampNTZType(),
    "NUMERIC": T.DecimalType(38, 9),
    "DECIMAL": T.DecimalType(38, 9),
    "BYTES": T.BinaryType(),
}

# Spellings a declared column may use besides Spark DDL.
DECLARED_SPELLINGS = (
    (r"(VARCHAR|TEXT|STRING)(\(\d+\))?", "string"),
    (r"NUMBER\(19,0\)", "bigint"),
    (r"NUMBER", "decimal(38,0)"),
    (r"NUMBER\((\d+),(\d+)\)", r"decimal(\1,\2)"),
    (r"FLOAT", "double"),
    (r"TIMESTAMP_NTZ(\(\d\))?", "timestamp_ntz"),
    (r"TIMESTAMP_LTZ(\(\d\))?", "timestamp_ltz"),
)

_STORABLE = (
    T.StringType, T.IntegerType, T.LongType, T.DoubleType, T.BooleanType, T.DateType,
    T.TimestampNTZType, T.TimestampType, T.DecimalType, T.BinaryType,
)


# --- mapped -------------------------------------------------------------------


def map_source_schema(fields: Iterable[Mapping[str, Any]]) -> T.StructType:
    """``StructType`` of a source schema given as name/type/mode/fields mappings."""
    schema = T.StructType([_source_field(field) for field in fields])
    view_aliases(schema)
    return schema


def _source_field(field: Mapping[str, Any]) -> T.StructField:
    name = str(field.get("name") or "")
    if not name:
        raise SchemaError("a source field has no name")
    kind = str(field.get("type") or "").upper()
    mode = str(field.get("mode") or "NULLABLE").upper()
    if kind in ("RECORD", "STRUCT"):
        children = [_source_field(child) for child in field.get("fields") or ()]
        if not children:
            raise SchemaError(f"record field {name} has no nested fields")
        data_type: T.DataType = T.StructType(children)
    elif kind in SOURCE_TYPES:
        data_type = SOURCE_TYPES[kind]
    else:
        raise SchemaError(f"source type {kind or '<missing>'} of {name} is not supported")
    if mode == "REPEATED":
        if kind == "BYTES":
            raise SchemaError(f"repeated BYTES field {name} is not supported")
        return T.StructField(name, T.ArrayType(data_type), True)
    return T.StructField(name, data_type, mode != "REQUIRED")


# --- inferred -----------------------------------------------------------------


def normalise_inferred(schema: T.StructType) -> T.StructType:
    """Table schema for an inferred one; raises on types a table cannot hold.

    Small integers load as ``int`` and ``float`` as ``double``, at any depth.
    """
    schema = _storable(schema, "")
    view_aliases(schema)
    return schema


def _storable(data_type: T.DataType, path: str) -> Any:
    if isinstance(data_type, T.StructType):
        return T.StructType(
            [
                T.StructField(
                    f.name, _storable(f.dataType, f"{path}.{f.name}"), f.nullable, f.metadata
                )
                for f in data_type.fields
            ]
        )
    if isinstance(data_type, T.ArrayType):
        return T.ArrayType(_storable(data_type.elementType, path), data_type.containsNull)
    if isinstance(data_type, T.MapType):
        return T.MapType(
            _storable(data_type.keyType, path),
            _storable(data_type.valueType, path),
            data_type.valueContainsNull,
        )
    if isinstance(data_type, (T.ByteType, T.ShortType)):
        return T.IntegerType()
    if isinstance(data_type, T.FloatType):
        return T.DoubleType()
    if isinstance(data_type, T.UserDefinedType) or not isinstance(data_type, _STORABLE):
        raise SchemaError(f"type {data_type.simpleString()} of {path.strip('.')} is not supported")
    return data_type


# --- declared -----------------------------------------------------------------


def declared_type(text: str) -> T.DataType:
    """Spark DDL, or one of the other scalar spellings."""
    compact = re.sub(r"\s+", "", text).upper()
    ddl = text
    for pattern, replacement in DECLARED_SPELLINGS:
        if re.fullmatch(pattern, compact):
            ddl = re.sub(pattern, replacement, compact)
            break
    try:
        parsed = T.StructType.fromDDL(f"c {ddl}")
    except Exception as error:
        raise SchemaError(f"column type {text!r} is not valid: {type(error).__name__}") from None
    return _storable(parsed["c"].dataType, text)


def map_declared_columns(columns: Iterable[Any]) -> T.StructType:
    """``StructType`` of declared columns (objects with name, type, nullable, alias,
    expression)."""
    fields = []
    for column in columns:
        metadata = {
            key: value
            for key, value in (("alias", column.alias), ("expression", column.expression))
            if value is not None
        }
        fields.append(
            T.StructField(column.name, declared_type(column.type), column.nullable, metadata)
        )
    if not fields:
        raise SchemaError("declared columns must not be empty")
    names = [field.name for field in fields]
    repeated = sorted({name for name in names if names.count(name) > 1})
    if repeated:
        raise SchemaError("duplicate column names: " + ", ".join(repeated))
    schema = T.StructType(fields)
    view_aliases(schema)
    return schema


# --- shared -------------------------------------------------------------------


def view_aliases(schema: T.StructType) -> list[str]:
    """View column names in order; raises when two fields would share one."""
    aliases = [(f.metadata or {}).get("alias") or snake_name(f.name) for f in schema.fields]
    keys = [alias.lower() for alias in aliases]
    collisions = sorted({alias for alias in keys if keys.count(alias) > 1})
    if collisions:
        raise SchemaError("view alias collisions: " + ", ".join(collisions))
    return aliases


def as_nullable(data_type: Any) -> Any:
    """The same type with NULL allowed everywhere, which is how files are read."""
    if isinstance(data_type, T.StructType):
        return T.StructType(
            [T.StructField(f.name, as_nullable(f.dataType), True, f.metadata) for f in data_type]
        )
    if isinstance(data_type, T.ArrayType):
        return T.ArrayType(as_nullable(data_type.elementType), True)
    if isinstance(data_type, T.MapType):
        return T.MapType(as_nullable(data_type.keyType), as_nullable(data_type.valueType), True)
    return data_type


def bare(data_type: Any) -> Any:
    """The same type with NULL allowed everywhere and without metadata."""
    if isinstance(data_type, T.StructType):
        return T.StructType([T.StructField(f.name, bare(f.dataType)) for f in data_type])
    if isinstance(data_type, T.ArrayType):
        return T.ArrayType(bare(data_type.elementType))
    if isinstance(data_type, T.MapType):
        return T.MapType(bare(data_type.keyType), bare(data_type.valueType))
    return data_type
