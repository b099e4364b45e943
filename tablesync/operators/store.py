"""The managed table: data directories by slice and one published record of the live ones.

``<location>/data/<run>/_slice=<label>/`` holds the files one run wrote for one slice and never
changes. ``<location>/_versions/<n>.json`` names the schema and the live slices of each run; the
highest number is the head. A run writes its files first and publishes last, in one
put-if-absent, so readers see all of a run or nothing and of two concurrent runs one gets
:class:`PublishConflict`.

A slice is what a table is replaced by: rows are dealt to slices as they are written, by the
table's slice expression or else by the source directory they come from. A delete drops the
slices that lose all rows by leaving them out of the next record, and rewrites those that lose
some. No file is ever named: records, plans and the driver hold directories, of which a run
makes a bounded number, and loading a slice again and again leaves one directory for it.
"""

from __future__ import annotations

import json
from collections.abc import Iterable
from dataclasses import dataclass, replace
from datetime import UTC, datetime, timedelta
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..errors import PublishConflict, SchemaError
from ..functions.naming import quoted
from ..plans.types import bare
from ..session import Files, literal_path
from .lease import LAPSE, held
from .load import fitted, keep_filter
from .slicing import AT, SLICE

_PART = T.StructType(
    [
        T.StructField("directory", T.StringType()),
        T.StructField("slices", T.ArrayType(T.StringType())),
    ]
)
_RECORD = T.StructType(
    [
        T.StructField("number", T.LongType()),
        T.StructField("published_at", T.StringType()),
        T.StructField("parts", T.ArrayType(_PART)),
    ]
)


@dataclass(frozen=True)
class Part:
    """What is live of a run's data directory: ``slices`` out of ``written`` ones.

    ``era`` is the place in the version's ``eras`` of the schema the files were written under.
    """

    directory: str
    slices: tuple[str, ...]
    written: int
    era: int = 0

    def paths(self) -> list[str]:
        """The directories to scan: the whole one while all of it is live."""
        if len(self.slices) == self.written:
            return [self.directory]
        return [f"{self.directory}/{SLICE}={label}" for label in self.slices]


@dataclass(frozen=True)
class Version:
    number: int
    run_id: str
    published_at: str
    schema: T.StructType
    parts: tuple[Part, ...] = ()
    eras: tuple[T.StructType, ...] = ()

    def to_json(self) -> str:
        return json.dumps(
            {
                "number": self.number,
                "run_id": self.run_id,
                "published_at": self.published_at,
                "schema": self.schema.jsonValue(),
                "eras": [era.jsonValue() for era in self.eras],
                "parts": [
                    {
                        "directory": part.directory,
                        "slices": list(part.slices),
                        "written": part.written,
                        "era": part.era,
                    }
                    for part in self.parts
                ],
            }
        )

    @classmethod
    def from_json(cls, text: str) -> Version:
        record = json.loads(text)
        return cls(
            record["number"],
            record["run_id"],
            record["published_at"],
            T.StructType.fromJson(record["schema"]),
            tuple(
                Part(part["directory"], tuple(part["slices"]), part["written"], part["era"])
                for part in record["parts"]
            ),
            tuple(T.StructType.fromJson(era) for era in record["eras"]),
        )


@dataclass(frozen=True)
class Written:
    """A data directory a run wrote, with the schema it was written under."""

    part: Part
    schema: T.StructType


@dataclass(frozen=True)
class Deletion:
    """What a delete predicate does to a version."""

    kept: tuple[Part, ...]
    rewritten: DataFrame | None
    slices_dropped: int = 0
    slices_rewritten: int = 0
    rows_deleted: int = 0


class ManagedTable:
    def __init__(self, spark: SparkSession, location: str):
        self.spark = spark
        self.location = location.rstrip("/")
        self._files = Files(spark, self.location)
        self._versions = f"{self.location}/_versions"

    # --- versions -------------------------------------------------------------

    def exists(self) -> bool:
        return bool(self.version_numbers())

    def version_numbers(self) -> list[int]:
        names = self._files.names(self._versions)
        return [int(name[:-5]) for name in names if name.endswith(".json")]

    def head(self) -> Version:
        numbers = self.version_numbers()
        if not numbers:
            raise SchemaError(f"no managed table at {self.location}")
        return self.version(numbers[-1])

    def version(self, number: int) -> Version:
        return Version.from_json(self._files.read_text(self._record(number)))

    def create(self, schema: T.StructType, run_id: str) -> bool:
        """Publish an empty version 0; False if the table exists already."""
        if self.exists():
            return False
        try:
            self._put(Version(0, run_id, _now(), schema))
        except PublishConflict:
            return False
        return True

    def publish(
        self,
        parent: Version,
        schema: T.StructType,
        kept: Iterable[Part],
        run_id: str,
        added: Iterable[Written] = (),
    ) -> Version:
        """Make the next version visible, or raise PublishConflict if it was taken.

        ``kept`` are parts of the parent, ``added`` what the run wrote.
        """
        eras = list(parent.eras)
        parts = list(kept)
        for written in added:
            if written.schema not in eras:
                eras.append(written.schema)
            parts.append(replace(written.part, era=eras.index(written.schema)))
        parts = [part for part in parts if part.slices]
        used = sorted({part.era for part in parts})
        parts = [replace(part, era=used.index(part.era)) for part in parts]
        version = Version(
            parent.number + 1, run_id, _now(), schema, tuple(parts), tuple(eras[i] for i in used)
        )
        self._put(version)
        return version

    def drop(self) -> None:
        self._files.delete(self.location)

    def _put(self, version: Version) -> None:
        self._files.put_if_absent(self._record(version.number), version.to_json())

    def _record(self, number: int) -> str:
        return f"{self._versions}/{number:010d}.json"

    # --- rows -----------------------------------------------------------------

    def read(self, version: Version | None = None) -> DataFrame:
        """The rows of a version (the head by default).

        Files written under an earlier schema are read with this version's: fields
        bind by name at every depth, new ones are NULL, narrower ones widen. Files whose
        types the reader does not widen are scanned with the types of their own era,
        cast, and united with the others.
        """
        version = version or self.head()
        return self._rows(version.parts, version).drop(AT)

    def _rows(self, parts: Iterable[Part], version: Version) -> DataFrame:
        """Rows with the directory of their slice, ``<run>/_slice=<label>``."""
        own: dict[str, tuple[T.StructType, list[str]]] = {}
        for part in parts:
            schema = era_schema(version.eras[part.era], version.schema)
            own.setdefault(schema.json(), (schema, []))[1].extend(part.paths())
        scans = [self._scan(paths, schema, version.schema) for schema, paths in own.values()]
        if not scans:
            empty = self.spark.createDataFrame([], version.schema)
            return empty.withColumn(AT, F.lit(""))
        return reduce(DataFrame.unionAll, scans)

    def _scan(self, paths: list[str], stored: T.StructType, wanted: T.StructType) -> DataFrame:
        reader = self.spark.read.schema(stored).option("recursiveFileLookup", True)
        frame = reader.parquet(*(literal_path(self._path(path)) for path in paths))
        at = F.regexp_extract(F.col("_metadata.file_path"), f"([^/]+/{SLICE}=[^/]+)/[^/]+$", 1)
        columns = [F.col(quoted(field.name)) for field in wanted.fields]
        if stored != wanted:
            columns = [
                fitted(column, old.dataType, new.dataType).alias(new.name)
                for column, old, new in zip(columns, stored.fields, wanted.fields)
            ]
        return frame.select(*columns, at.alias(AT))

    def _path(self, directory: str) -> str:
        return f"{self.location}/data/{directory}"

    def directory(self, part: Part, label: str) -> str:
        """Where the files of a slice are."""
        return self._path(f"{part.directory}/{SLICE}={label}")

    def write(self, frame: DataFrame, directory: str) -> Written:
        """Write rows to a new, still unpublished, data directory, dealt by ``SLICE``.

        Without that column there is one slice. Tasks move their files into place
        themselves (commit algorithm 2), so a job with very many files does not end in
        one long series of renames on the driver. What that gives up, an atomic
        directory, is not needed: nothing reads the directory before a version names
        it, and a failed write is discarded whole.
        """
        if SLICE not in frame.columns:
            frame = frame.withColumn(SLICE, F.lit("all"))
        path = self._path(directory)
        frame.write.options(**_WRITE_OPTIONS).partitionBy(SLICE).parquet(path)
        labels = tuple(
            name.partition("=")[2] for name in self._files.names(path) if name.startswith(f"{SLICE}=")
        )
        return Written(Part(directory, labels, len(labels)), bare(frame.drop(SLICE).schema))

    def lease(self, run_id: str):
        """While open, directories named ``run_id...`` are not taken for leftovers."""
        return held(self._files, f"{self.location}/_leases/{run_id}")

    def discard(self, directory: str) -> None:
        """Remove a directory that was never published."""
        self._files.delete(self._path(directory))

    # --- delete ---------------------------------------------------------------

    def delete(self, version: Version, predicate: str | None) -> Deletion:
        """Apply a delete predicate to a version, touching only the slices it hits.

        One job reads just the predicate's columns, with the predicate pushed to the
        scan, and counts hits per slice; a second counts those slices' rows from their
        footers. Slices that lose every row are dropped unread, slices that lose some
        are rewritten, and the rest stay in place.
        """
        if not predicate:
            return Deletion((), None)
        hits = _rows_per_slice(self._rows(version.parts, version).where(F.expr(predicate)))
        if not hits:
            return Deletion(version.parts, None)
        touched = _only(version.parts, hits)
        rows = _rows_per_slice(self._rows(touched, version))
        partly = {at for at, count in rows.items() if count > hits[at]}
        rewritten = None
        if partly:
            left = self._rows(_only(version.parts, partly), version).where(keep_filter(predicate))
            label = F.substring_index(F.col(AT), f"{SLICE}=", -1)
            rewritten = left.withColumn(SLICE, label).drop(AT)
        return Deletion(
            _without(version.parts, hits),
            rewritten,
            len(hits) - len(partly),
            len(partly),
            sum(hits.values()),
        )

    # --- retention ------------------------------------------------------------

    def expire(self, retention_days: float = 7, now: datetime | None = None) -> dict[str, int]:
        """Forget records replaced more than ``retention_days`` ago, delete the slices only
        they name, and what interrupted runs left behind.

        The head always stays. A record's age counts from when it was replaced, so a
        reader that began before has that long. A directory no record names is a
        leftover unless its run holds a lease.
        """
        now = now or datetime.now(UTC)
        limit = now - timedelta(days=retention_days)
        done = {"versions": 0, "slices": 0, "unpublished": 0}
        if not self.exists():
            return done
        records = self.spark.read.schema(_RECORD).option("multiLine", True).json(
            literal_path(self._versions)
        )
        done["unpublished"] = self._discard_unpublished(records, now)
        published = sorted(records.select("number", "published_at").collect())
        expired = []
        for record, successor in zip(published, published[1:]):
            if datetime.fromisoformat(successor["published_at"]) >= limit:
                break
            expired.append(record["number"])
        if not expired:
            return done
        # Data goes first and the records last: a run that is cut short is simply
        # repeated by the next one.
        live = F.col("number") > max(expired)
        named = records.select(live.alias("live"), F.inline("parts"))
        named = named.select("live", "directory", F.explode("slices").alias("label"))
        dead = named.groupBy("directory", "label").agg(F.max("live").alias("live"))
        for row in dead.where("NOT live").toLocalIterator():
            self._files.delete(self._path(f"{row['directory']}/{SLICE}={row['label']}"))
            done["slices"] += 1
        for number in expired:
            self._files.delete(self._record(number))
        return done | {"versions": len(expired)}

    def expiry_is_due(self, retention_days: float) -> bool:
        """Whether the oldest version was replaced before the retention window."""
        numbers = self.version_numbers()
        if len(numbers) < 2:
            return False
        replaced = datetime.fromisoformat(self.version(numbers[1]).published_at)
        return replaced < datetime.now(UTC) - timedelta(days=retention_days)

    def _discard_unpublished(self, records: DataFrame, now: datetime) -> int:
        named = records.select(F.explode("parts.directory").alias("directory")).distinct()
        known = {row["directory"] for row in named.collect()}
        leases = f"{self.location}/_leases"
        for lease in self._files.names(leases):
            if self._files.modified(f"{leases}/{lease}") < (now - LAPSE).timestamp():
                self._files.delete(f"{leases}/{lease}")
        running = tuple(self._files.names(leases))
        old = [
            name
            for name in self._files.names(f"{self.location}/data")
            if name not in known
            and not name.startswith(running)
            and self._files.modified(self._path(name)) < (now - LAPSE).timestamp()
        ]
        for name in old:
            self.discard(name)
        return len(old)


_WRITE_OPTIONS = {
    "mapreduce.fileoutputcommitter.algorithm.version": "2",
    "mapreduce.fileoutputcommitter.marksuccessfuljobs": "false",
}


def era_schema(era: T.StructType, wanted: T.StructType) -> T.StructType:
    """``wanted`` with the types that files of an era must be read with.

    Only integers stored as decimals differ: the reader does not widen them to ``bigint``.
    """
    stored = {field.name: field.dataType for field in era.fields}
    return T.StructType(
        [
            T.StructField(
                field.name, _era_type(stored.get(field.name), field.dataType), field.nullable,
                field.metadata,
            )
            for field in wanted.fields
        ]
    )


def _era_type(old: T.DataType | None, new: T.DataType) -> T.DataType:
    if isinstance(old, T.DecimalType) and isinstance(new, T.LongType):
        return old
    if isinstance(old, T.StructType) and isinstance(new, T.StructType):
        known = {child.name: child.dataType for child in old.fields}
        return T.StructType(
            [
                T.StructField(c.name, _era_type(known.get(c.name), c.dataType), c.nullable, c.metadata)
                for c in new.fields
            ]
        )
    if isinstance(old, T.ArrayType) and isinstance(new, T.ArrayType):
        return T.ArrayType(_era_type(old.elementType, new.elementType), new.containsNull)
    return new


def _rows_per_slice(rows: DataFrame) -> dict[str, int]:
    counted = rows.groupBy(AT).agg(F.count("*").alias("n")).collect()  # a row per slice
    return {row[AT]: row["n"] for row in counted}


def _at(part: Part, label: str) -> str:
    return f"{part.directory}/{SLICE}={label}"


def _only(parts: Iterable[Part], found: Iterable[str]) -> tuple[Part, ...]:
    """The parts with only the slices named."""
    found = set(found)
    picked = [
        replace(part, slices=tuple(label for label in part.slices if _at(part, label) in found))
        for part in parts
    ]
    return tuple(part for part in picked if part.slices)


def _without(parts: Iterable[Part], gone: Iterable[str]) -> tuple[Part, ...]:
    """The parts with some slices gone; a directory without live slices is dropped."""
    gone = set(gone)
    kept = [
        replace(part, slices=tuple(label for label in part.slices if _at(part, label) not in gone))
        for part in parts
    ]
    return tuple(part for part in kept if part.slices)


def _now() -> str:
    return datetime.now(UTC).isoformat()
