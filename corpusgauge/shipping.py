"""Bringing the package to the Python workers of a cluster."""

from __future__ import annotations

import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

PACKAGE = Path(__file__).resolve().parent
_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send this package to the session's workers, once for each application.

    The driver packs its own copy and Spark's file server hands it to every executor, also to
    one that joins later, so functions that refer to the package run from any folder.
    """
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    archive = Path(tempfile.mkdtemp(prefix="corpusgauge-")) / "corpusgauge-package.zip"
    with zipfile.ZipFile(archive, "w") as packed:
        for file in sorted(PACKAGE.rglob("*.py")):
            packed.write(file, file.relative_to(PACKAGE.parent))
    context.addPyFile(str(archive))
    _shipped.add(context.applicationId)
