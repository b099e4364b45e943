"""Sessions, scratch space and the few file-system calls the driver makes.

Everything here touches metadata only (a version record, a directory name, a
sidecar). Rows always move through DataFrame reads and writes.
"""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator, Mapping
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from typing import Any

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession

from .errors import PublishConflict

# Name matching on load is case-sensitive, predicates may quote identifiers with
# double quotes (which needs ANSI mode, as do casts that fail rather than lose a
# value), timestamps are UTC wall-clock values, stored so that they have statistics
# to prune by, and a file that is missing or corrupt is an error, not an omission.
ENGINE_CONF = {
    "spark.sql.ansi.enabled": "true",
    "spark.sql.ansi.doubleQuotedIdentifiers": "true",
    "spark.sql.caseSensitive": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.parquet.outputTimestampType": "TIMESTAMP_MICROS",
    "spark.sql.files.ignoreCorruptFiles": "false",
    "spark.sql.files.ignoreMissingFiles": "false",
    "spark.sql.maxConcurrentOutputFileWriters": "16",
}

_SPLIT_BYTES = "spark.sql.files.maxPartitionBytes"


def engine_session(
    spark: SparkSession, functions: Mapping[str, Any] | None = None
) -> SparkSession:
    """A child session with the engine's settings on top of the caller's.

    It shares context, catalog and cache with ``spark`` but has its own settings, so
    lazily returned frames keep the right semantics, concurrent syncs cannot disturb
    each other, and the caller's session stays untouched. Catalog functions are
    visible in it; session functions are not, so those that predicates or column
    expressions call are given by name.
    """
    child = spark.newSession()
    for key, value in {**spark.conf.getAll, **ENGINE_CONF}.items():
        if child.conf.isModifiable(key):
            child.conf.set(key, value)
    for name, function in (functions or {}).items():
        child.udf.register(name, function)
    return child


@contextmanager
def one_partition_per_core(engine: SparkSession) -> Iterator[None]:
    """Size scans by core count alone: a metadata scan has no bytes to split, and
    would otherwise get a partition for every (large) file."""
    before = engine.conf.get(_SPLIT_BYTES)
    engine.conf.set(_SPLIT_BYTES, str(1 << 50))
    try:
        yield
    finally:
        engine.conf.set(_SPLIT_BYTES, before)


def literal_path(path: str) -> str:
    """The path with glob characters escaped, for readers that expand them."""
    return re.sub(r"([\\{}\[\]*?])", r"\\\1", path)


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A new path in a folder every executor shares: ``spark.checkpoint.dir``, the context's
    checkpoint folder, or on a cluster the warehouse."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        # Only in local mode do executors share the driver's temporary folder.
        if re.match(r"local(\[|$)", spark.sparkContext.master):
            base = tempfile.mkdtemp(prefix="tablesync-")
        else:
            base = spark.conf.get("spark.sql.warehouse.dir")
    return f"{base.rstrip('/')}/tablesync-{label}-{uuid.uuid4().hex[:12]}"


class Files:
    """Hadoop file-system metadata calls, valid for any scheme Spark can read."""

    def __init__(self, spark: SparkSession, root: str):
        self._jvm = spark._jvm
        self._gateway = spark.sparkContext._gateway
        self._conf = spark._jsc.hadoopConfiguration()
        self._path = self._java_class("org.apache.hadoop.fs.Path")
        self._fs = self._path(root).getFileSystem(self._conf)

    def _java_class(self, name: str):
        return getattr(self._jvm, name)

    def qualified(self, path: str) -> str:
        return self._fs.makeQualified(self._path(path)).toString()

    def exists(self, path: str) -> bool:
        return self._fs.exists(self._path(path))

    def is_dir(self, path: str) -> bool:
        try:
            return self._fs.getFileStatus(self._path(path)).isDirectory()
        except Py4JJavaError as error:
            if "FileNotFoundException" in error.java_exception.getClass().getName():
                return False
            raise

    def directories(self, paths: list[str]) -> list[bool]:
        """:meth:`is_dir` of many paths; the round trips overlap."""
        with ThreadPoolExecutor(max_workers=16) as pool:
            return list(pool.map(self.is_dir, paths))

    def names(self, path: str) -> list[str]:
        """Names directly under ``path``, sorted; empty when it does not exist."""
        target = self._path(path)
        if not self._fs.exists(target):
            return []
        return sorted(status.getPath().getName() for status in self._fs.listStatus(target))

    def count(self, path: str) -> int:
        """Number of files below ``path``."""
        return self._fs.getContentSummary(self._path(path)).getFileCount()

    def modified(self, path: str) -> float:
        """Modification time in epoch seconds."""
        return self._fs.getFileStatus(self._path(path)).getModificationTime() / 1000

    def read_text(self, path: str) -> str:
        stream = self._fs.open(self._path(path))
        try:
            return self._java_class("org.apache.commons.io.IOUtils").toString(stream, "UTF-8")
        finally:
            stream.close()

    def write_text(self, path: str, text: str) -> None:
        stream = self._fs.create(self._path(path), True)
        try:
            stream.write(bytearray(text.encode("utf-8")))
        finally:
            stream.close()

    def put_if_absent(self, path: str, text: str) -> None:
        """Make ``path`` appear with its full content, or fail if it exists.

        The content goes to a hidden temporary name first and is renamed without
        overwrite, which is atomic on HDFS-like file systems.
        """
        parent, _, name = path.rpartition("/")
        temporary = f"{parent}/.{name}.{uuid.uuid4().hex}"
        self.write_text(temporary, text)
        context = self._java_class("org.apache.hadoop.fs.FileContext").getFileContext(
            self._path(path).toUri(), self._conf
        )
        rename = self._java_class("org.apache.hadoop.fs.Options$Rename")
        no_options = self._gateway.new_array(rename, 0)
        try:
            context.rename(self._path(temporary), self._path(path), no_options)
        except Py4JJavaError as error:
            self.delete(temporary)
            if "FileAlreadyExistsException" in error.java_exception.getClass().getName():
                raise PublishConflict(f"version record {name} already exists") from None
            raise

    def rename(self, path: str, new_path: str) -> None:
        if not self._fs.rename(self._path(path), self._path(new_path)):
            raise OSError(f"cannot rename {path}")

    def delete(self, path: str) -> None:
        self._fs.delete(self._path(path), True)
