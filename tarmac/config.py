"""Pipeline configuration: table names, storage root and scale knobs."""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import SparkSession

BAD_DATE_MODES = ("fail", "null")


@dataclass(frozen=True)
class PipelineConfig:
    """Everything a layer job needs to know about where and how to write.

    ``root`` must be storage every executor can reach (HDFS, S3, a shared mount);
    :func:`tarmac.session.shared_root` derives one from ``spark.checkpoint.dir``.
    """

    root: str
    catalog: str | None = None
    bronze: str = "bronze"
    silver: str = "silver"
    gold: str = "gold"
    # Parquet by default; "delta" works where the Delta jars are on the classpath.
    format: str = "parquet"
    # Versions of a table that stay after a write: the new one and, for readers
    # that have begun on it, the one before.
    keep_versions: int = 2
    on_bad_date: str = "fail"
    # ORDER BY before a write only orders files; a range-partitioned sort at scale.
    sort_output: bool = True
    # Independent jobs of one layer (bronze sources; gold grains airport,
    # passenger, calendar) are submitted from this many driver threads.
    parallel_jobs: int = 3
    # A dimension is broadcast only when an aggregate over it proves at most
    # this many rows and bytes of values; otherwise it is joined by a
    # skew-aware shuffle join.
    broadcast_max_rows: int = 1_000_000
    broadcast_max_bytes: int = 64 * 1024 * 1024
    # Skew handling for shuffle joins: keys (null included) with at least
    # ``hot_key_rows`` fact rows (so at most rows / hot_key_rows keys) are spread
    # over ceil(rows / ``salt_rows``) sub-keys each, so a key holding a third
    # of 100 TB is cut into task-sized pieces; other keys join as usual.
    # Detection is one exact aggregation of the key column (a shuffle of
    # (key, count) pairs); with ``skew_salting=False`` large dimensions are
    # joined by a plain shuffle join and only AQE's skew splitting applies.
    skew_salting: bool = True
    salt_rows: int = 2_000_000
    hot_key_rows: int = 2_000_000

    def __post_init__(self) -> None:
        if self.on_bad_date not in BAD_DATE_MODES:
            raise ValueError(f"on_bad_date must be one of {BAD_DATE_MODES}, got {self.on_bad_date!r}")
        if self.salt_rows < 1 or self.hot_key_rows < 1:
            raise ValueError("salt_rows and hot_key_rows must be >= 1")

    def layer(self, layer: str) -> str:
        """Schema (database) name of a layer: ``bronze``/``silver``/``gold``."""
        return {"bronze": self.bronze, "silver": self.silver, "gold": self.gold}[layer]

    def qualify(self, layer: str, table: str) -> str:
        db = self.layer(layer)
        return f"{self.catalog}.{db}.{table}" if self.catalog else f"{db}.{table}"

    def qualify_db(self, layer: str) -> str:
        db = self.layer(layer)
        return f"{self.catalog}.{db}" if self.catalog else db

    def location(self, layer: str, table: str | None = None) -> str:
        base = f"{self.root.rstrip('/')}/{self.layer(layer)}.db"
        return base if table is None else f"{base}/{table}"

    def staging(self, name: str) -> str:
        """Path for intermediate results that cut lineage between stages."""
        return f"{self.root.rstrip('/')}/_staging/{name}"

    def with_(self, **kw) -> "PipelineConfig":
        return replace(self, **kw)


def default_config(spark: SparkSession, name: str = "warehouse", **kw) -> PipelineConfig:
    from tarmac.session import shared_root

    return PipelineConfig(root=shared_root(spark, name), **kw)
