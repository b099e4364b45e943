"""The exposed view: renamed and, where declared, computed columns of the head."""

from __future__ import annotations

import json
from collections.abc import Mapping
from dataclasses import asdict, dataclass
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..errors import PublishConflict, SchemaError
from ..functions.naming import quoted
from ..plans.types import view_aliases
from ..session import Files, engine_session
from .store import ManagedTable


@dataclass(frozen=True)
class ViewColumn:
    source: str
    alias: str
    expression: str | None = None


def view_columns(schema: T.StructType, expressions_at_load: bool = False) -> list[ViewColumn]:
    """The view's columns; expressions already applied while loading are left out."""
    return [
        ViewColumn(
            field.name,
            alias,
            None if expressions_at_load else (field.metadata or {}).get("expression"),
        )
        for field, alias in zip(schema.fields, view_aliases(schema))
    ]


def project_view(table: DataFrame, columns: list[ViewColumn]) -> DataFrame:
    return table.select(
        [
            (F.expr(c.expression) if c.expression else F.col(quoted(c.source))).alias(c.alias)
            for c in columns
        ]
    )


class View:
    """The view definition kept beside a managed table.

    ``_views/<n>.json`` appears with its full content or not at all, and the highest number
    counts, so a reader meets the definition before or the one after, never part of one.
    """

    def __init__(self, table: ManagedTable):
        self.table = table
        self._folder = f"{table.location}/_views"
        self._files = Files(table.spark, table.location)

    def _numbers(self) -> list[int]:
        names = self._files.names(self._folder)
        return [int(name[:-5]) for name in names if name.endswith(".json")]

    def exists(self) -> bool:
        return bool(self._numbers())

    def columns(self) -> list[ViewColumn]:
        numbers = self._numbers()
        if not numbers:
            raise SchemaError(f"no view is published at {self.table.location}")
        text = self._files.read_text(self._path(numbers[-1]))
        return [ViewColumn(**column) for column in json.loads(text)]

    def _path(self, number: int) -> str:
        return f"{self._folder}/{number:010d}.json"

    def create_or_replace(self, columns: list[ViewColumn], schema: T.StructType) -> None:
        """Store the definition if it changed; a bad expression fails here, without opening a
        file. Of two runs that replace it at once the later one counts."""
        project_view(self.table.spark.createDataFrame([], schema), columns)
        text = json.dumps([asdict(column) for column in columns])
        while True:
            numbers = self._numbers()
            if numbers and self._files.read_text(self._path(numbers[-1])) == text:
                return
            try:
                self._files.put_if_absent(self._path(numbers[-1] + 1 if numbers else 0), text)
                return
            except PublishConflict:
                continue

    def read(self) -> DataFrame:
        return project_view(self.table.read(), self.columns())

    def drop(self) -> None:
        self._files.delete(self._folder)


def read_view(
    spark: SparkSession, location: str, functions: Mapping[str, Any] | None = None
) -> DataFrame:
    """The view over the head of the table at ``location``.

    ``functions`` are the session functions its expressions call, as for a sync.
    """
    return View(ManagedTable(engine_session(spark, functions), location)).read()


def read_table(spark: SparkSession, location: str, version: int | None = None) -> DataFrame:
    """The internal table (source names) at its head or an earlier version."""
    table = ManagedTable(engine_session(spark), location)
    return table.read(None if version is None else table.version(version))


def register_view(
    spark: SparkSession, location: str, name: str, functions: Mapping[str, Any] | None = None
) -> None:
    """Make the view readable from SQL, in any session, as ``global_temp.<name>``."""
    read_view(spark, location, functions).createOrReplaceGlobalTempView(name)
