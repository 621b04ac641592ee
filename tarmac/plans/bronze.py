"""Bronze: one typed table per CSV source, then a row count of every table in
the layer beside the rows that were written (check and listing in one job)."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from tarmac.config import PipelineConfig
from tarmac.schemas import SCHEMAS, SourceSpec
from tarmac.sources.csv import read_source
from tarmac.sources.tables import Written, ensure_layer, layer_counts, verify, write_table


def as_spec(name: str, source: str | SourceSpec) -> SourceSpec:
    """A path stands for the known schema of its name; an unknown name's types are inferred."""
    return source if isinstance(source, SourceSpec) else SourceSpec(name, source, SCHEMAS.get(name))


def ingest(spark: SparkSession, cfg: PipelineConfig, spec: SourceSpec) -> Written:
    return write_table(read_source(spark, spec), cfg, "bronze", spec.name)


def build_bronze(spark: SparkSession, cfg: PipelineConfig, sources: dict[str, str | SourceSpec]) -> DataFrame:
    """``sources`` maps table name → CSV path (any Hadoop-readable path) or its :class:`SourceSpec`.

    Sources are independent jobs, submitted from ``cfg.parallel_jobs`` threads."""
    ensure_layer(spark, cfg, "bronze")
    specs = [as_spec(name, source) for name, source in sources.items()]
    with ThreadPoolExecutor(max_workers=max(1, cfg.parallel_jobs)) as pool:
        written = dict(zip(sources, pool.map(lambda spec: ingest(spark, cfg, spec), specs)))
    return verify(layer_counts(spark, cfg, "bronze"), written)
