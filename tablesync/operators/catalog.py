"""The view in a catalog: persistent, over the slices of a path-based table."""

from __future__ import annotations

import hashlib
from collections.abc import Iterable

from pyspark.sql import types as T

from ..functions.naming import quoted
from ..plans.types import bare
from .store import ManagedTable, Version, era_schema
from .views import ViewColumn

#: The partition column of the internal tables, and partitions added by a statement.
PART, STATEMENT = "_part", 500


class CatalogView:
    """A view and the internal tables below it, in one schema of the session catalog.

    An internal table ``__<name>_<schema hash>`` is external and partitioned: a partition is
    a slice of the managed table, with that slice's own directory as its location. A load
    first adds the partitions it needs, which nothing refers to yet, and then replaces the
    view, whose text lists the live slices. That is one change of the catalog, so a reader of
    any session meets the table as before or as after the load. Files of an era whose types
    differ have an internal table of their own; the view casts and unites them.
    """

    def __init__(self, table: ManagedTable, schema: str, target: str):
        self.table, self.spark = table, table.spark
        self.schema = schema
        self.name = target.rpartition(".")[2]
        self.view = f"{quoted(schema)}.{quoted(self.name)}"

    def create_or_replace(self, columns: list[ViewColumn]) -> str:
        """Bring the view in step with the head; returns its name."""
        head = self.table.head()
        self.spark.sql(f"CREATE SCHEMA IF NOT EXISTS {quoted(self.schema)}")
        selects = [self._select(head, *era) for era in self._eras(head)]
        if not selects:
            selects = [self._select(head, bare(head.schema), {})]
        projection = ", ".join(
            f"{c.expression or quoted(c.source)} AS {quoted(c.alias)}" for c in columns
        )
        rows = " UNION ALL ".join(selects)
        self.spark.sql(f"CREATE OR REPLACE VIEW {self.view} AS SELECT {projection} FROM ({rows})")
        return f"{self.schema}.{self.name}"

    def _eras(self, head: Version) -> Iterable[tuple[T.StructType, dict[str, str]]]:
        """What is scanned alike: a schema, and the slices with their directories."""
        found: dict[str, tuple[T.StructType, dict[str, str]]] = {}
        for part in head.parts:
            stored = bare(era_schema(head.eras[part.era], head.schema))
            slices = found.setdefault(stored.json(), (stored, {}))[1]
            for label in part.slices:
                slices[f"{part.directory}-{label}"] = self.table.directory(part, label)
        return found.values()

    def _select(self, head: Version, stored: T.StructType, slices: dict[str, str]) -> str:
        internal = self._internal(stored)
        self._add(internal, slices)
        columns = ", ".join(
            f"CAST({quoted(old.name)} AS {_ddl(new.dataType)}) AS {quoted(old.name)}"
            if old.dataType != new.dataType
            else quoted(old.name)
            for old, new in zip(stored.fields, bare(head.schema).fields)
        )
        live = ", ".join(_text(name) for name in slices) or "NULL"
        return f"SELECT {columns} FROM {internal} WHERE {PART} IN ({live})"

    def _internal(self, stored: T.StructType) -> str:
        """The internal table of a schema, created when it is not there."""
        mark = hashlib.sha256(stored.json().encode()).hexdigest()[:12]
        name = f"{quoted(self.schema)}.{quoted(f'__{self.name}_{mark}')}"
        columns = ", ".join(f"{quoted(f.name)} {_ddl(f.dataType)}" for f in stored.fields)
        self.spark.sql(
            f"CREATE TABLE IF NOT EXISTS {name} ({columns}, {PART} string) USING parquet "
            f"PARTITIONED BY ({PART}) LOCATION {_text(f'{self.table.location}/_catalog/{mark}')}"
        )
        return name

    def _add(self, internal: str, slices: dict[str, str]) -> None:
        """Add the partitions that are missing."""
        shown = self.spark.sql(f"SHOW PARTITIONS {internal}").collect()  # a row per slice
        known = {row[0].partition("=")[2] for row in shown}
        missing = [name for name in slices if name not in known]
        for at in range(0, len(missing), STATEMENT):
            parts = " ".join(
                f"PARTITION ({PART}={_text(name)}) LOCATION {_text(slices[name])}"
                for name in missing[at : at + STATEMENT]
            )
            self.spark.sql(f"ALTER TABLE {internal} ADD IF NOT EXISTS {parts}")

    def forget(self) -> int:
        """Drop the partitions of slices that are in no record any more; returns how many."""
        named = {
            f"{part.directory}-{label}"
            for number in self.table.version_numbers()
            for part in self.table.version(number).parts
            for label in part.slices
        }
        dropped = 0
        prefix = f"__{self.name}_"
        for found in self.spark.catalog.listTables(self.schema):
            if not found.name.startswith(prefix):
                continue
            internal = f"{quoted(self.schema)}.{quoted(found.name)}"
            shown = self.spark.sql(f"SHOW PARTITIONS {internal}").collect()
            gone = [n for n in (row[0].partition("=")[2] for row in shown) if n not in named]
            for at in range(0, len(gone), STATEMENT):
                parts = ", ".join(f"PARTITION ({PART}={_text(n)})" for n in gone[at : at + STATEMENT])
                self.spark.sql(f"ALTER TABLE {internal} DROP IF EXISTS {parts}")
            dropped += len(gone)
        return dropped


def _ddl(data_type: T.DataType) -> str:
    """A type as SQL, names quoted."""
    if isinstance(data_type, T.StructType):
        inner = ", ".join(f"{quoted(f.name)}: {_ddl(f.dataType)}" for f in data_type.fields)
        return f"struct<{inner}>"
    if isinstance(data_type, T.ArrayType):
        return f"array<{_ddl(data_type.elementType)}>"
    if isinstance(data_type, T.MapType):
        return f"map<{_ddl(data_type.keyType)}, {_ddl(data_type.valueType)}>"
    return data_type.simpleString()


def _text(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"
