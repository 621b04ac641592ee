"""Session helpers: shared storage root and the settings the jobs are tuned for."""

from __future__ import annotations

import re
import tempfile

from pyspark.sql import SparkSession

CHECKPOINT_KEY = "spark.checkpoint.dir"

# Settings the layer jobs are written for.  AQE re-plans joins and coalesces
# shuffle partitions at run time; skew-join splitting backs up the explicit
# salting in tarmac.operators.join.
RECOMMENDED_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def _context(spark: SparkSession):
    """The SparkContext of a classic session; None under Spark Connect."""
    try:
        return spark.sparkContext
    except Exception:  # noqa: BLE001 - Connect sessions have no SparkContext
        return None


def _conf_checkpoint_dir(spark: SparkSession) -> str | None:
    value = spark.conf.get(CHECKPOINT_KEY, None)
    if value:
        return value
    sc = _context(spark)
    value = sc.getConf().get(CHECKPOINT_KEY, None) if sc is not None else None
    return value or None


def checkpoint_dir(spark: SparkSession) -> str:
    """The cluster's shared folder (``spark.checkpoint.dir``).

    The cluster names it.  Only a local-mode session (tests) without it gets
    a scratch folder, registered so that ``checkpoint()`` works too; anywhere
    else a missing setting is an error, never a machine-local folder.
    """
    value = _conf_checkpoint_dir(spark)
    if value is None:
        if not re.match(r"local(\[|$)", str(spark.conf.get("spark.master", ""))):
            raise RuntimeError(f"{CHECKPOINT_KEY} is not set: name a folder on shared storage")
        value = tempfile.mkdtemp(prefix="tarmac-ckpt-")
        spark.conf.set(CHECKPOINT_KEY, value)
    sc = _context(spark)
    if sc is not None and sc.getCheckpointDir() is None:
        sc.setCheckpointDir(value)
    return value


def shared_root(spark: SparkSession, name: str) -> str:
    """A folder under the shared checkpoint dir for tables and staging data."""
    return f"{checkpoint_dir(spark).rstrip('/')}/tarmac/{name}"


def build_session(app: str = "tarmac", master: str | None = None, **conf: str) -> SparkSession:
    """Session for the command-line jobs and tests; cluster settings win."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**RECOMMENDED_CONF, **conf}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    sc = _context(spark)
    if sc is not None:
        sc.setLogLevel("ERROR")
    checkpoint_dir(spark)
    return spark
