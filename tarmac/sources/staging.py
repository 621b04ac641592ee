"""Intermediate tables on shared storage, with an owner that removes them.

A :class:`Staging` is one folder under ``spark.checkpoint.dir``; closing it
removes the folder.  Frames that operators return lazily may still read staged
tables, so those belong to the process's own staging, which goes when the
process ends; a caller with a shorter life (a dashboard tab, a layer job) passes
its own.
"""

from __future__ import annotations

import atexit
import uuid

from pyspark.sql import DataFrame, SparkSession

from tarmac.session import shared_root
from tarmac.sources.tables import remove


class Staging:
    def __init__(self, spark: SparkSession) -> None:
        self.spark = spark
        self.folder = shared_root(spark, f"_staging/{uuid.uuid4().hex}")

    def write(self, df: DataFrame, name: str) -> DataFrame:
        """Write ``df`` and return the frame that reads it back (its lineage is cut)."""
        path = f"{self.folder}/{name}-{uuid.uuid4().hex[:8]}"
        df.write.mode("error").parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def close(self) -> None:
        remove(self.spark, self.folder)

    def __enter__(self) -> "Staging":
        return self

    def __exit__(self, *_) -> None:
        self.close()


_OF_PROCESS: dict[str, Staging] = {}


def process_staging(spark: SparkSession) -> Staging:
    """The staging of this application, removed when the Python process ends."""
    app = spark.sparkContext.applicationId
    if app not in _OF_PROCESS:
        staging = _OF_PROCESS[app] = Staging(spark)
        atexit.register(_close_quietly, staging)
    return _OF_PROCESS[app]


def _close_quietly(staging: Staging) -> None:
    """At the end of the process the session may be gone; its folder then stays for the cluster's own cleaning."""
    try:
        staging.close()
    except Exception:  # noqa: BLE001
        pass
