"""What may change between a stored schema and the one a source now has.

Top level: columns may only be appended. Inside structs and arrays of structs,
fields may be added, reordered and widened; a field the source no longer has is
kept. Names match regardless of case and keep their stored spelling.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from ..errors import SchemaError
from .types import as_nullable

PLAN_COLUMNS = "path string, action string, from_type string, to_type string"


@dataclass(frozen=True)
class Change:
    path: str
    action: str  # add_column | add_field | reorder | widen | keep
    from_type: str | None = None
    to_type: str | None = None


@dataclass
class EvolutionPlan:
    """The evolved schema and every difference that led to it."""

    schema: T.StructType
    changes: list[Change] = field(default_factory=list)

    @property
    def altered(self) -> bool:
        return any(change.action != "keep" for change in self.changes)

    @property
    def added_columns(self) -> list[str]:
        return [change.path for change in self.changes if change.action == "add_column"]

    @property
    def altered_columns(self) -> list[str]:
        nested = {
            change.path.split(".", 1)[0]
            for change in self.changes
            if change.action not in ("keep", "add_column")
        }
        return [name for name in self.schema.names if name in nested]

    @property
    def warnings(self) -> list[str]:
        return [
            f"nested field {change.path} is absent from the source schema; keeping it"
            for change in self.changes
            if change.action == "keep"
        ]

    def to_dataframe(self, spark: SparkSession) -> DataFrame:
        """One row per change, for audit."""
        rows = [(c.path, c.action, c.from_type, c.to_type) for c in self.changes]
        return spark.createDataFrame(rows, PLAN_COLUMNS)


def plan_evolution(stored: T.StructType, wanted: T.StructType) -> EvolutionPlan:
    """Plan the step from ``stored`` to ``wanted``, or raise if it is not allowed."""
    if len(wanted) < len(stored):
        raise SchemaError("the source schema removed existing columns")
    plan = EvolutionPlan(T.StructType())
    fields = []
    for old, new in zip(stored.fields, wanted.fields):
        if old.name != new.name:
            raise SchemaError(
                f"the source schema reordered or renamed columns: expected {old.name!r}, "
                f"found {new.name!r}"
            )
        data_type = _merge(old.dataType, new.dataType, old.name, plan.changes, nested=False)
        fields.append(T.StructField(old.name, data_type, old.nullable, new.metadata))
    for new in wanted.fields[len(stored) :]:
        plan.changes.append(Change(new.name, "add_column", None, new.dataType.simpleString()))
        fields.append(new)
    keys = [f.name.lower() for f in fields]
    if len(set(keys)) < len(keys):
        raise SchemaError("column names must differ by more than case")
    plan.schema = T.StructType(fields)
    return plan


def check_compatible(stored: T.StructType, wanted: T.StructType) -> None:
    """Raise when ``wanted`` could not follow ``stored``; change nothing."""
    plan_evolution(stored, wanted)


def _merge(
    old: T.DataType, new: T.DataType, path: str, changes: list[Change], nested: bool
) -> T.DataType:
    if isinstance(old, T.StructType) and isinstance(new, T.StructType):
        return _merge_struct(old, new, path, changes)
    if _is_struct_array(old) and _is_struct_array(new):
        element = _merge_struct(old.elementType, new.elementType, path, changes)
        return T.ArrayType(element, old.containsNull)
    if _same(old, new):
        return old
    if nested and evolves_to(old, new):
        changes.append(Change(path, "widen", old.simpleString(), new.simpleString()))
        return new
    raise SchemaError(
        f"incompatible type change for {path}: {old.simpleString()} -> {new.simpleString()}"
    )


def _merge_struct(
    old: T.StructType, new: T.StructType, path: str, changes: list[Change]
) -> T.StructType:
    stored = _by_key(old, path)
    wanted = _by_key(new, path)
    fields = []
    for key, child in wanted.items():
        if key in stored:
            kept = stored[key]
            data_type = _merge(
                kept.dataType, child.dataType, f"{path}.{kept.name}", changes, nested=True
            )
            fields.append(T.StructField(kept.name, data_type, kept.nullable, kept.metadata))
        else:
            # Rows stored before this field existed read it as NULL.
            changes.append(
                Change(f"{path}.{child.name}", "add_field", None, child.dataType.simpleString())
            )
            fields.append(
                T.StructField(child.name, as_nullable(child.dataType), True, child.metadata)
            )
    shared_stored = [key for key in stored if key in wanted]
    shared_wanted = [key for key in wanted if key in stored]
    if shared_stored != shared_wanted:
        changes.append(
            Change(
                path,
                "reorder",
                ",".join(stored[key].name for key in shared_stored),
                ",".join(stored[key].name for key in shared_wanted),
            )
        )
    for key, kept in stored.items():
        if key not in wanted:
            changes.append(Change(f"{path}.{kept.name}", "keep", kept.dataType.simpleString()))
            fields.append(kept)
    return T.StructType(fields)


# Fixed value: a decimal of up to so many digits, none after the point, counts as an ``int``.
INT_DIGITS = 10


def can_widen(old: T.DataType, new: T.DataType) -> bool:
    """``int`` to ``bigint``, or more decimal digits at the same scale.

    The Parquet reader does these itself; :func:`evolves_to` allows one more.
    """
    if isinstance(old, T.DecimalType) and isinstance(new, T.DecimalType):
        return old.scale == new.scale and new.precision >= old.precision
    return isinstance(old, T.IntegerType) and isinstance(new, T.LongType)


def evolves_to(old: T.DataType, new: T.DataType) -> bool:
    """Whether a nested field may become ``new``: widening, or integers kept as decimals of up
    to ten digits becoming ``bigint``, for which stored rows are cast when they are read."""
    if isinstance(old, T.DecimalType) and isinstance(new, T.LongType):
        return old.scale == 0 and old.precision <= INT_DIGITS
    return can_widen(old, new)


def _is_struct_array(data_type: T.DataType) -> bool:
    return isinstance(data_type, T.ArrayType) and isinstance(data_type.elementType, T.StructType)


def _same(old: T.DataType, new: T.DataType) -> bool:
    """Equal up to nullability and the case of nested names."""
    return as_nullable(old).simpleString().lower() == as_nullable(new).simpleString().lower()


def _by_key(struct: T.StructType, path: str) -> dict[str, T.StructField]:
    keyed = {child.name.lower(): child for child in struct.fields}
    if len(keyed) < len(struct.fields):
        raise SchemaError(f"duplicate nested field names under {path}")
    return keyed
