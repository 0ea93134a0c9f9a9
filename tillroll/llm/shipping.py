"""Make this package importable in the Python workers of a session."""

from __future__ import annotations

import os
import shutil
import tempfile

from pyspark.sql import SparkSession

import tillroll

_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Send the package to all executors, once per application, as `--py-files` would."""
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    root = os.path.dirname(os.path.abspath(tillroll.__file__))
    target = os.path.join(tempfile.mkdtemp(prefix="tillroll-"), "tillroll")
    archive = shutil.make_archive(target, "zip", os.path.dirname(root), os.path.basename(root))
    context.addPyFile(archive)
    _shipped.add(context.applicationId)
