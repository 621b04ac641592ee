"""Make the package importable in Python workers that do not have it installed."""

from __future__ import annotations

import os
import tempfile
import zipfile

from pyspark.sql import SparkSession

import tarmac

_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Send the package's source to the executors with the job, once per application."""
    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    top = os.path.dirname(os.path.abspath(tarmac.__file__))
    archive = os.path.join(tempfile.mkdtemp(prefix="tarmac-code-"), "tarmac.zip")
    with zipfile.ZipFile(archive, "w") as out:
        for folder, _, names in os.walk(top):
            for name in sorted(names):
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    out.write(path, os.path.join("tarmac", os.path.relpath(path, top)))
    sc.addPyFile(archive)
    _SHIPPED.add(sc.applicationId)
