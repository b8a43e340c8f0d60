"""The package on the executors' import path, wherever the driver found it."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

import inkmill


def ship(spark: SparkSession) -> None:
    """Send the package to the executors, once for each Spark context. Python workers import operators by name."""
    context = spark.sparkContext
    if getattr(context, "_inkmill_shipped", False):
        return
    root = Path(inkmill.__file__).resolve().parent
    folder = tempfile.mkdtemp(prefix="inkmill-ship-")  # the driver serves the archive from here as long as it runs
    atexit.register(shutil.rmtree, folder, True)
    path = os.path.join(folder, "inkmill.zip")
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as out:
        for file in sorted(root.rglob("*.py")):
            out.write(file, file.relative_to(root.parent))
    context.addPyFile(path)
    context._inkmill_shipped = True
