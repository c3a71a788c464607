"""This package at hand on every executor."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

import tillroll

_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send this package to the session's Python workers, once per application.

    Tasks import the functions they run; an executor that has no copy of the package on its
    own path gets it from the driver through Spark's file server.
    """
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    home = Path(tillroll.__file__).parent
    folder = tempfile.mkdtemp(prefix="tillroll-ship-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    path = f"{folder}/tillroll_package.zip"
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as out:
        for f in sorted(home.rglob("*.py")):
            out.write(f, str(f.relative_to(home.parent)))
    context.addPyFile(path)
    _shipped.add(context.applicationId)
