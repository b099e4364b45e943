"""Which slices of a source one run reads."""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Iterable, Sequence
from dataclasses import dataclass
from datetime import datetime, timedelta
from functools import reduce
from typing import TypeVar

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..errors import SpecError
from ..functions.naming import quoted

# The predicate types and the two partition ids that are not values.
AUTO, NONE, WHERE = "auto", "none", "where"
TABLE_SUFFIX, PARTITION_DECORATOR = "table_suffix", "partition_decorator"
TABLE_PREDICATE_TYPES = (AUTO, NONE, TABLE_SUFFIX, PARTITION_DECORATOR)
SQL_PREDICATE_TYPES = (AUTO, NONE, WHERE)
NULL_PARTITION = "__NULL__"
OUTSIDE_PARTITION = "__UNPARTITIONED__"

Item = TypeVar("Item")


# --- predicate type -----------------------------------------------------------


def check_table_predicates(kind: str, table: str, predicates: Sequence[str]) -> None:
    """Raise unless ``kind`` may be used for this table with these predicates."""
    if kind not in TABLE_PREDICATE_TYPES:
        raise SpecError(f"predicate type {kind!r} is not valid for a table source")
    if kind == NONE and predicates:
        raise SpecError("predicate type none takes no predicates")
    if kind in (TABLE_SUFFIX, PARTITION_DECORATOR) and not predicates:
        raise SpecError(f"predicate type {kind} needs at least one predicate")
    if kind == TABLE_SUFFIX and not (is_wildcard(table) and table.count("*") == 1):
        raise SpecError("predicate type table_suffix needs a table name ending in _*")
    if kind == PARTITION_DECORATOR and "*" in table:
        raise SpecError("predicate type partition_decorator needs one concrete table")


def resolve_table_predicates(
    kind: str, table: str, predicates: Sequence[str], partitioned: Callable[[], bool]
) -> str:
    """The concrete predicate type behind ``kind`` (``auto`` looks at the table)."""
    check_table_predicates(kind, table, predicates)
    if kind == AUTO:
        if not predicates:
            return NONE
        if is_wildcard(table):
            kind = TABLE_SUFFIX
        elif partitioned():
            return PARTITION_DECORATOR
        else:
            raise SpecError("auto predicates need a wildcard table or a partitioned table")
        check_table_predicates(kind, table, predicates)
    elif kind == PARTITION_DECORATOR and not partitioned():
        raise SpecError("predicate type partition_decorator needs a partitioned table")
    return kind


def resolve_sql_predicates(kind: str, predicates: Sequence[str]) -> str:
    """The concrete predicate type of a SQL source."""
    if kind not in SQL_PREDICATE_TYPES:
        raise SpecError(f"predicate type {kind!r} is not valid for a SQL source")
    if kind == AUTO:
        return WHERE if predicates else NONE
    if kind == NONE and predicates:
        raise SpecError("predicate type none takes no predicates")
    if kind == WHERE and not predicates:
        raise SpecError("predicate type where needs at least one predicate")
    return kind


def is_wildcard(table: str) -> bool:
    return table.endswith("_*")


# --- partition ids ------------------------------------------------------------


@dataclass(frozen=True)
class TimePartition:
    """Partitioned by a date or timestamp column; ids are ``YYYY[MM[DD[HH]]]``."""

    column: str

    def span(self, partition_id: str) -> tuple[str, str]:
        """First value of the partition and first value after it, as text: a text
        literal takes the column's own type, so a date or timestamp column is compared
        uncast and the range reaches the scan."""
        if not partition_id.isdigit() or len(partition_id) not in _TIME_FORMS:
            raise SpecError(f"partition id {partition_id!r} is not YYYY[MM[DD[HH]]]")
        try:
            low = datetime.strptime(partition_id, _TIME_FORMS[len(partition_id)][0])
        except ValueError:
            raise SpecError(f"partition id {partition_id!r} is not a date") from None
        if len(partition_id) == 4:
            high = low.replace(year=low.year + 1)
        elif len(partition_id) == 6:
            high = (low + timedelta(days=32)).replace(day=1)
        else:
            high = low + (timedelta(days=1) if len(partition_id) == 8 else timedelta(hours=1))
        return low.isoformat(" "), high.isoformat(" ")

    def outside(self) -> Column:
        raise SpecError(f"a time partition has no {OUTSIDE_PARTITION} rows")

    def containers(self, partition_id: str) -> list[str]:
        """The coarser partitions that hold this one."""
        width = len(partition_id) if partition_id.isdigit() else 0
        return [partition_id[:length] for length in _TIME_FORMS if length < width]

    def labels(self, ids: Sequence[str]) -> list[Column]:
        """Of a row: its partition id in each of the units that the ids use."""
        column = F.col(quoted(self.column))
        forms = [_TIME_FORMS[width] for width in sorted({len(i) for i in ids if i.isdigit()})]
        found = [F.date_format(F.date_trunc(unit, column), form) for _, unit, form in forms]
        null = F.when(column.isNull(), F.lit(NULL_PARTITION))
        return [F.coalesce(label, null) for label in found] or [null]

    def group(self, ids: Sequence[str]) -> tuple[Column, Column]:
        """A grouping key fine enough for all ids, and the id text of a group."""
        width = max((len(name) for name in ids if name.isdigit()), default=4)
        _, unit, pattern = _TIME_FORMS[width]
        return F.date_trunc(unit, quoted(self.column)), F.date_format("key", pattern)


@dataclass(frozen=True)
class RangePartition:
    """Partitioned by an integer column into ``[start, end)`` in steps of ``interval``;
    an id is the first value of its range."""

    column: str
    start: int
    end: int
    interval: int

    def span(self, partition_id: str) -> tuple[int, int]:
        try:
            low = int(partition_id)
        except ValueError:
            raise SpecError(f"partition id {partition_id!r} is not an integer") from None
        if not self.start <= low < self.end or (low - self.start) % self.interval:
            raise SpecError(f"partition id {partition_id} does not start a range")
        return low, min(low + self.interval, self.end)

    def outside(self) -> Column:
        column = F.col(quoted(self.column))
        return (column < self.start) | (column >= self.end)

    def containers(self, partition_id: str) -> list[str]:
        return []

    def labels(self, ids: Sequence[str]) -> list[Column]:
        """Of a row: the id of its range."""
        column = F.col(quoted(self.column)).cast("bigint")
        first = column - F.pmod(column - self.start, F.lit(self.interval))
        inside = F.when(self.outside(), F.lit(OUTSIDE_PARTITION)).otherwise(first.cast("string"))
        return [F.coalesce(inside, F.lit(NULL_PARTITION))]

    def group(self, ids: Sequence[str]) -> tuple[Column, Column]:
        """The grouping key of a row (its range, or -1 outside all), and its id text."""
        offset = F.col(quoted(self.column)).cast("bigint") - self.start
        inside = offset - F.pmod(offset, F.lit(self.interval))
        key = F.when(self.outside(), F.lit(-1)).otherwise(inside)
        first = (F.col("key") + self.start).cast("string")
        return key, F.when(F.col("key") == -1, F.lit(OUTSIDE_PARTITION)).otherwise(first)


# Per length of a time id, how it parses, its unit and how it prints.
_TIME_FORMS = {
    4: ("%Y", "year", "yyyy"),
    6: ("%Y%m", "month", "yyyyMM"),
    8: ("%Y%m%d", "day", "yyyyMMdd"),
    10: ("%Y%m%d%H", "hour", "yyyyMMddHH"),
}


def partition_condition(
    partition: TimePartition | RangePartition, ids: Sequence[str]
) -> Column:
    """Rows of any of the partitions. Adjacent ranges are merged, so a run of days is
    one range however long it is."""
    column = F.col(quoted(partition.column))
    conditions = []
    if NULL_PARTITION in ids:
        conditions.append(column.isNull())
    if OUTSIDE_PARTITION in ids:
        conditions.append(partition.outside())
    spans: list[tuple] = []
    special = (NULL_PARTITION, OUTSIDE_PARTITION)
    for low, high in sorted(partition.span(name) for name in ids if name not in special):
        if spans and low <= spans[-1][1]:
            spans[-1] = (spans[-1][0], max(high, spans[-1][1]))
        else:
            spans.append((low, high))
    conditions += [(column >= F.lit(low)) & (column < F.lit(high)) for low, high in spans]
    return reduce(lambda one, other: one | other, conditions)


# --- multiplicity -------------------------------------------------------------


def disjoint_layers(
    items: Sequence[Item], containers: Callable[[Item], Iterable[Item]] = lambda item: ()
) -> list[list[Item]]:
    """Split slices into layers without overlap inside a layer.

    One layer is one scan; a row that lies in two slices is then read once per
    slice, so a slice list keeps bag semantics. Nearly always there is one layer.
    ``containers`` names the slices that would hold an item: two slices overlap when
    they are equal or one is such a container, so an item's layer is the number of
    slices that hold it, and no two items are ever compared.
    """
    total, seen = Counter(items), Counter()
    layers: dict[int, list[Item]] = {}
    for item in items:
        number = sum(total[container] for container in containers(item)) + seen[item]
        seen[item] += 1
        layers.setdefault(number, []).append(item)
    return [layers[number] for number in sorted(layers)]


def suffix_containers(suffix: str) -> list[str]:
    """The directories above a path suffix (``''`` is the root)."""
    pieces = suffix.split("/")
    return ["/".join(pieces[:depth]) for depth in range(len(pieces))] if suffix else []
