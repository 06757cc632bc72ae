"""This package on the Python workers of a cluster."""

from __future__ import annotations

import shutil
import tempfile
from pathlib import Path

from pyspark.sql import SparkSession

PACKAGE = Path(__file__).resolve().parent.parent
_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Have Spark send the package to its Python workers, once per application.

    Workers import it from there wherever they run and whatever their working folder is.
    """
    context = spark.sparkContext
    if context.applicationId not in _shipped:
        archive = f"{tempfile.mkdtemp(prefix='newsflow-')}/{PACKAGE.name}"
        context.addPyFile(shutil.make_archive(archive, "zip", PACKAGE.parent, PACKAGE.name))
        _shipped.add(context.applicationId)
