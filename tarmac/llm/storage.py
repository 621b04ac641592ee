"""Tables that operators write on the way, all on the cluster's shared folder."""

from __future__ import annotations

import gc
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tarmac.session import checkpoint_dir


def run_folder(spark: SparkSession, name: str) -> str:
    """A new folder under ``spark.checkpoint.dir``; no two calls share one."""
    return f"{checkpoint_dir(spark).rstrip('/')}/tarmac-llm/{name}-{uuid.uuid4().hex}"


def write_table(df: DataFrame, path: str) -> DataFrame:
    """Write ``df`` as Parquet and return the frame that reads it back (its lineage is cut)."""
    df.write.mode("error").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def materialize(df: DataFrame, name: str) -> DataFrame:
    return write_table(df, run_folder(df.sparkSession, name))


def remove(spark: SparkSession, path: str) -> None:
    """Delete an intermediate table that no later frame reads."""
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def release(spark: SparkSession) -> None:
    """Let Spark delete the shuffle files of finished jobs now: it does so once the driver has collected its garbage."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def dealt_anew(grouped: DataFrame, key: str) -> DataFrame:
    """A grouped frame with ``key``, one of its grouping columns, as a computed column of the same values.

    Joined on it, both sides are dealt by shuffles of the join's own, and Spark
    can split a key that very many rows share; a side that is grouped in the
    join's own stage it cannot split."""
    c = F.col(key)
    kind = dict(grouped.dtypes)[key]
    return grouped.withColumn(key, F.concat(c, F.lit(b"")) if kind == "binary" else c.bitwiseXOR(F.lit(0)))


class Scratch:
    """Intermediate tables of one call, in a folder of its own on the shared folder, each removable by name."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark, self.folder = spark, run_folder(spark, name)

    def write(self, df: DataFrame, name: str) -> DataFrame:
        return write_table(df, f"{self.folder}/{name}")

    def drop(self, *names: str) -> None:
        """Remove tables that no later frame reads ('' for all), and the shuffles that finished jobs have left."""
        for name in names:
            remove(self.spark, f"{self.folder}/{name}".rstrip("/"))
        release(self.spark)
