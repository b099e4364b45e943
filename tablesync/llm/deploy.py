"""Make this package importable in the Python workers of a session's executors."""

from __future__ import annotations

import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

_PACKAGE = Path(__file__).resolve().parents[1]
_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Hand the package's source to every executor, once per application.

    A cluster where the package is installed, or given with ``--py-files``, does not need
    it, but it does no harm there either.
    """
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    archive = Path(tempfile.mkdtemp(prefix="tablesync-")) / "tablesync_source.zip"
    with zipfile.ZipFile(archive, "w") as out:
        for path in sorted(_PACKAGE.rglob("*.py")):
            out.write(path, f"{_PACKAGE.name}/{path.relative_to(_PACKAGE)}")
    context.addPyFile(str(archive))
    _shipped.add(context.applicationId)
