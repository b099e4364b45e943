"""From source rows to table rows: match by name, convert, check, replace."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..errors import SchemaError
from ..functions.expressions import file_field_refs
from ..functions.naming import quoted
from ..plans.evolution import can_widen
from ..plans.types import as_nullable
from .slicing import SLICE, with_slice

# The two ways to load Parquet files.
STRICT, CONVERT = "add_files_copy", "full_ingest"
LOAD_MODES = (STRICT, CONVERT)


# --- delete -------------------------------------------------------------------


def keep_filter(predicate: str) -> Column:
    """Rows a ``DELETE WHERE predicate`` leaves: where it is false **or NULL**."""
    return ~F.coalesce(F.expr(predicate), F.lit(False))


def delete_and_copy(current: DataFrame, predicate: str | None, incoming: DataFrame) -> DataFrame:
    """The table after one run, as plain algebra (the whole-table form)."""
    if not predicate:
        return incoming
    return current.where(keep_filter(predicate)).unionByName(incoming)


# --- strict load --------------------------------------------------------------


def check_file_types(files: T.StructType, table: T.StructType) -> None:
    """Raise unless the files' own types already fit the table.

    The Parquet reader is more tolerant than this (it would read a zoned timestamp
    as a wall-clock one, for example), hence the comparison of the footers.
    """
    stored = {field.name: field.dataType for field in files.fields}
    for field in table.fields:
        if field.name in stored:
            _check_type(stored[field.name], field.dataType, field.name)


def _check_type(found: T.DataType, wanted: T.DataType, path: str) -> None:
    if isinstance(found, T.StructType) and isinstance(wanted, T.StructType):
        children = {child.name.lower(): child.dataType for child in found.fields}
        for child in wanted.fields:
            if child.name.lower() in children:
                _check_type(children[child.name.lower()], child.dataType, f"{path}.{child.name}")
        return
    if isinstance(found, T.ArrayType) and isinstance(wanted, T.ArrayType):
        _check_type(found.elementType, wanted.elementType, f"{path}[]")
        return
    if isinstance(found, T.MapType) and isinstance(wanted, T.MapType):
        _check_type(found.keyType, wanted.keyType, f"{path}.key")
        _check_type(found.valueType, wanted.valueType, f"{path}.value")
        return
    if found == wanted or can_widen(found, wanted) or _same_stored_form(found, wanted):
        return
    raise SchemaError(
        f"files hold {path} as {found.simpleString()}, the table as {wanted.simpleString()}; "
        f"load mode {CONVERT} converts"
    )


def _same_stored_form(found: T.DataType, wanted: T.DataType) -> bool:
    small = isinstance(found, (T.ByteType, T.ShortType)) and isinstance(
        wanted, (T.IntegerType, T.LongType)
    )
    return small or (isinstance(found, T.FloatType) and isinstance(wanted, T.DoubleType))


# --- convert ------------------------------------------------------------------


def has_load_expressions(schema: T.StructType) -> bool:
    return any((field.metadata or {}).get("expression") for field in schema.fields)


def convert(source: DataFrame, schema: T.StructType) -> DataFrame:
    """Project and cast source rows to the table's columns.

    A declared expression is applied here, to the file's own columns; other columns
    are taken by exact name. A column the files lack reads as NULL. Structs and arrays
    convert field by field, matched by name regardless of case. The slice of a row stays.
    """
    missing = [field for field in schema.fields if field.name not in source.columns]
    source = source.withColumns({f.name: F.lit(None).cast(f.dataType) for f in missing})
    columns = []
    for field in schema.fields:
        expression = (field.metadata or {}).get("expression")
        column = F.expr(file_field_refs(expression)) if expression else F.col(quoted(field.name))
        if _is_nested(field.dataType):
            found = source.select(column.alias(field.name)).schema[0].dataType
            column = fitted(column, found, field.dataType)
        else:
            column = column.cast(field.dataType)
        columns.append(column.alias(field.name))
    if SLICE in source.columns:
        columns.append(F.col(SLICE))
    return source.select(columns)


def fitted(column: Column, found: T.DataType, wanted: T.DataType) -> Column:
    """A value of type ``found`` as one of type ``wanted``; absent fields become NULL and
    extra ones go, at every depth."""
    if isinstance(found, T.StructType) and isinstance(wanted, T.StructType):
        known = {child.name.lower(): child for child in found.fields}
        fields = []
        for child in wanted.fields:
            match = known.get(child.name.lower())
            if match is None:
                value = F.lit(None).cast(child.dataType)
            else:
                value = fitted(column.getField(match.name), match.dataType, child.dataType)
            fields.append(value.alias(child.name))
        return F.when(column.isNotNull(), F.struct(*fields))
    if isinstance(found, T.ArrayType) and isinstance(wanted, T.ArrayType):
        return F.transform(
            column, lambda element: fitted(element, found.elementType, wanted.elementType)
        )
    return column if found == wanted else column.cast(wanted)


def _is_nested(data_type: T.DataType) -> bool:
    return isinstance(data_type, (T.StructType, T.ArrayType, T.MapType))


# --- by name ------------------------------------------------------------------


def project_by_name(source: DataFrame, schema: T.StructType) -> DataFrame:
    """Reorder, fill absent fields with NULL and drop extra ones, at every depth.

    Top-level names match exactly. Nested names match regardless of case and take
    the table's spelling, because a differently spelled one would silently be NULL.
    """
    stored = {field.name: field.dataType for field in schema.fields}
    respelled = {}
    for field in source.schema.fields:
        if field.name in stored and _is_nested(field.dataType):
            data_type = _respell(field.dataType, stored[field.name])
            if data_type != field.dataType:  # struct to struct casts go by position
                respelled[field.name] = F.col(quoted(field.name)).cast(data_type)
    if respelled:
        source = source.withColumns(respelled)
    return source.to(as_nullable(with_slice(schema, source)))


def _respell(found: T.DataType, stored: T.DataType) -> T.DataType:
    if isinstance(found, T.StructType) and isinstance(stored, T.StructType):
        known = {child.name.lower(): child for child in stored.fields}
        fields = []
        for child in found.fields:
            match = known.get(child.name.lower())
            fields.append(
                T.StructField(
                    match.name if match else child.name,
                    _respell(child.dataType, match.dataType) if match else child.dataType,
                    child.nullable,
                )
            )
        return T.StructType(fields)
    if isinstance(found, T.ArrayType) and isinstance(stored, T.ArrayType):
        return T.ArrayType(_respell(found.elementType, stored.elementType), found.containsNull)
    return found


# --- not null -----------------------------------------------------------------


def enforce_not_null(source: DataFrame, schema: T.StructType) -> DataFrame:
    """Fail the load when a NOT NULL column or nested field holds NULL.

    Parquet reads do not carry nullability, so the rule is part of the projection
    and is evaluated in the same pass that writes the rows.
    """
    checked = {}
    for field in schema.fields:
        if field.nullable and not _requires(field.dataType):
            continue
        column = F.col(quoted(field.name))
        message = F.lit(f"NULL in NOT NULL column {field.name}")
        violated = _violation(column, field.dataType, field.nullable)
        checked[field.name] = F.when(violated, F.raise_error(message)).otherwise(column)
    return source.withColumns(checked) if checked else source


def _violation(column: Column, data_type: T.DataType, nullable: bool) -> Column | None:
    """Whether a required value is missing at or below ``column``; None if nothing
    is required there."""
    found = [] if nullable else [column.isNull()]
    if isinstance(data_type, T.StructType):
        for child in data_type.fields:
            inner = _violation(column.getField(child.name), child.dataType, child.nullable)
            if inner is not None:
                found.append(column.isNotNull() & inner)
    elif isinstance(data_type, T.ArrayType) and _requires(data_type.elementType):
        found.append(
            F.exists(column, lambda element: _violation(element, data_type.elementType, True))
        )
    return reduce(lambda one, other: one | other, found) if found else None


def _requires(data_type: T.DataType) -> bool:
    if isinstance(data_type, T.StructType):
        return any(not child.nullable or _requires(child.dataType) for child in data_type.fields)
    return isinstance(data_type, T.ArrayType) and _requires(data_type.elementType)
