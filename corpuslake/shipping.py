"""The package for the executors, for sessions whose Python workers do not find it installed."""

from __future__ import annotations

import os
import uuid
import zipfile
from pathlib import Path

from pyspark import SparkFiles
from pyspark.sql import SparkSession

_sent: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Adds the package to the files that Spark sends to executors, once per application."""
    context = spark.sparkContext
    if context.applicationId in _sent:
        return
    package = Path(__file__).parent
    path = os.path.join(SparkFiles.getRootDirectory(), f"source-{uuid.uuid4().hex}", f"{package.name}.zip")
    os.makedirs(os.path.dirname(path))
    with zipfile.ZipFile(path, "w") as out:
        for file in sorted(package.rglob("*.py")):
            out.write(file, file.relative_to(package.parent))
    context.addPyFile(path)
    _sent.add(context.applicationId)
