"""Gives executors this package where the session was started without ``--py-files``."""

from __future__ import annotations

import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

PACKAGE = Path(__file__).resolve().parent.parent
_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Adds the package's modules to the session's Python files, once per application."""
    application = spark.sparkContext.applicationId
    if application in _shipped or not PACKAGE.is_dir():
        return
    target = Path(tempfile.mkdtemp(prefix="ship-")) / f"{PACKAGE.name}.zip"
    with zipfile.ZipFile(target, "w") as archive:
        for module in sorted(PACKAGE.rglob("*.py")):
            archive.write(module, module.relative_to(PACKAGE.parent))
    spark.sparkContext.addPyFile(str(target))
    _shipped.add(application)
