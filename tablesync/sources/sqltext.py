"""The result of a SQL query, staged once and reused until it expires."""

from __future__ import annotations

import json
import re
import time
from contextlib import ExitStack

from pyspark.sql import DataFrame

from ..functions.expressions import stable_digest
from ..operators.lease import LAPSE, held
from ..operators.load import check_file_types
from ..plans.modes import slices_for
from ..plans.slices import resolve_sql_predicates
from ..plans.types import normalise_inferred
from ..session import Files, literal_path
from ..spec import SqlSource
from .base import SourceContext, SourcePlan, register_source
from .export import export_slices, read_export


# A text literal, a back-quoted name, or a name in double quotes.
_QUOTED = re.compile(r"""'(?:[^'\\]|\\.|'')*'|`[^`]*`|"(?P<name>(?:[^"]|"")*)(?:")""")


def select_rows(context: SourceContext, sql: str, predicates: tuple[str, ...]) -> DataFrame:
    """The query's rows matching any predicate. Catalyst pushes the filter down.

    Runs in the caller's session, so temporary views and functions are visible. In
    predicates double quotes quote identifiers, as in the delete predicate, whatever the
    caller's settings make of them.
    """
    frame = context.user.sql(sql.strip().rstrip(";"))
    if predicates:
        respelled = map(identifiers_quoted, predicates)
        frame = frame.where(" OR ".join(f"({predicate})" for predicate in respelled))
    return frame


def identifiers_quoted(predicate: str) -> str:
    """The predicate with ``"name"`` written as a back-quoted name; text stays as it is."""

    def respell(match: re.Match) -> str:
        if match["name"] is None:
            return match[0]
        name = match["name"].replace('""', '"').replace("`", "``")
        return f"`{name}`"

    return _QUOTED.sub(respell, predicate)


def staging_hash(source: SqlSource, target: str, predicates: tuple[str, ...]) -> str:
    """Identity of a staged result. It uses the requested predicate type, so ``auto``
    and ``where`` stage separately."""
    return stable_digest(
        {
            "sql": source.sql,
            "predicates": list(predicates),
            "source": source.identity,
            "target": target,
            "predicate_type": source.predicate_type,
        },
        32,
    )


class Staging:
    """Staged results under one location, each build with a record of its own.

    A build is written to its own directory and then recorded by put-if-absent, so builds that
    run at once leave a record each, and a rebuild never disturbs a run that still reads the
    one before. A run that reads a build holds a lease on it.
    """

    def __init__(self, context: SourceContext, location: str, digest: str):
        self._context = context
        self._files = Files(context.engine, location)
        self._digest = digest
        self.path = f"{location.rstrip('/')}/stage_{digest[:24]}"
        self._records = f"{self.path}/_builds"
        self._leases = f"{self.path}/_leases"

    def current(self) -> str | None:
        """The newest build, if it has the right hash and has not expired."""
        newest = max(self.builds(), key=lambda build: build["built_at"], default=None)
        if newest is None or newest["hash"] != self._digest:
            return None
        fresh = newest["expires_at"] > time.time() and self._files.exists(newest["path"])
        return newest["path"] if fresh else None

    def build(self, frame: DataFrame, hours: float) -> str:
        """Run the query into a new build, record it and drop expired builds nobody reads."""
        path = f"{self.path}/{self._context.run_id}"
        frame.write.parquet(path)
        now = time.time()
        record = {
            "hash": self._digest, "path": path, "built_at": now, "expires_at": now + hours * 3600
        }
        self._files.put_if_absent(f"{self._records}/{self._context.run_id}.json", json.dumps(record))
        for build in self.builds():
            name = build["path"].rpartition("/")[2]
            if name == self._context.run_id or build["expires_at"] >= now:
                continue
            if not self._leased(name, now):
                self._files.delete(f"{self._records}/{name}.json")
                self._files.delete(build["path"])
        return path

    def builds(self) -> list[dict]:
        names = [name for name in self._files.names(self._records) if name.endswith(".json")]
        return [json.loads(self._files.read_text(f"{self._records}/{name}")) for name in names]

    def lease(self, build: str):
        """While open, the build is not deleted."""
        name = build.rpartition("/")[2]
        return held(self._files, f"{self._leases}/{name}--{self._context.run_id}")

    def _leased(self, name: str, now: float) -> bool:
        """Whether some run has renewed a lease on the build lately; lost leases go."""
        leased = False
        for lease in self._files.names(self._leases):
            if lease.startswith(f"{name}--"):
                if self._files.modified(f"{self._leases}/{lease}") >= now - LAPSE.total_seconds():
                    leased = True
                else:
                    self._files.delete(f"{self._leases}/{lease}")
        return leased


def plan_sql(context: SourceContext, source: SqlSource) -> SourcePlan:
    predicates = slices_for(source, context.mode)
    resolve_sql_predicates(source.predicate_type, predicates)
    digest = staging_hash(source, context.target, predicates)
    staging = Staging(context, source.staging_location, digest)
    jobs = []
    build = staging.current() if source.reuse and not source.force_rebuild else None
    if build is None:
        build = staging.build(select_rows(context, source.sql, predicates), source.staging_hours)
        jobs.append({"operation": "query", "path": build})
    lease = ExitStack()
    lease.enter_context(staging.lease(build))
    staged = context.engine.read.parquet(literal_path(build))
    schema = context.declared if context.declared is not None else normalise_inferred(staged.schema)
    segment = {"table": staging.path.rpartition("/")[2]}
    if source.export_location:
        (path,) = export_slices(
            [staged], source.export_location, context.run_id, source.compression
        )
        segment["path"] = path
        jobs.append({"operation": "export", "path": path})

    def rows() -> DataFrame:
        frame = staged
        if source.export_location:
            frame = read_export(staged, source.export_location, context.run_id)
        check_file_types(frame.schema, schema)
        return frame

    return SourcePlan(
        schema=schema,
        rows=rows,
        segments=[segment],
        job_references=jobs,
        staging_reference=staging.path,
        close=lease.close,
    )


register_source(SqlSource, plan_sql)
