"""Getting the library's own code to the executors."""

from __future__ import annotations

import shutil
import tempfile
from pathlib import Path

from pyspark.sql import SparkSession

_shipped: set[str] = set()


def ship(spark: SparkSession) -> SparkSession:
    """Make this package importable in Python workers, once per application.

    Workers import functions by module name; a zip added with ``addPyFile``
    reaches every executor, including ones that join after a loss.
    """
    app = spark.sparkContext.applicationId
    if app not in _shipped:
        package = Path(__file__).resolve().parents[1]
        if package.is_dir():
            root = tempfile.mkdtemp(prefix="threadmill-")
            archive = shutil.make_archive(f"{root}/{package.name}", "zip", package.parent, package.name)
            spark.sparkContext.addPyFile(archive)
        _shipped.add(app)
    return spark
