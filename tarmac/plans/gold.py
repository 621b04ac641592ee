"""Gold: the eight marts, written with comments, plus the build summary.

Each of the three grains (airport, passenger, calendar) is aggregated once and
its states are written to a staging folder of this run in shared storage; the
marts are then projected (or rolled up) from that small table, and the folder
is removed.  This cuts the lineage, and the rows of the wide table are shuffled
twice (by airport and by passenger) instead of once per mart and counted column.
"""

from __future__ import annotations

import logging
import uuid
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tarmac.config import PipelineConfig
from tarmac.operators import marts
from tarmac.operators.topk import PREVIEWS, preview
from tarmac.plans.silver import OBT_TABLE
from tarmac.sources.tables import Written, ensure_layer, load_table, remove, row_counts, table_comment, verify, write_table

log = logging.getLogger("tarmac.gold")


def stage(df: DataFrame, path: str) -> DataFrame:
    """Write an intermediate result to shared storage and read it back."""
    df.write.mode("error").parquet(path)
    return df.sparkSession.read.parquet(path)


def build_grain(obt: DataFrame, grain: str, cfg: PipelineConfig) -> dict[str, Written]:
    """Aggregate one grain, stage its states, write its marts."""
    specs = [m for m in marts.MARTS if m.grain == grain]
    path = cfg.staging(f"{grain}_states-{uuid.uuid4().hex}")
    written = {}
    try:
        states = stage(marts.grain_states(obt, grain, cfg, specs, stored=True), path)
        for spec in specs:
            df = marts.finalize(states, spec)
            if cfg.sort_output:
                df = marts.sort_for_write(df, spec)
            try:
                written[spec.name] = write_table(df, cfg, "gold", spec.name, spec.comment, spec.lookup)
            except Exception:
                log.exception("writing %s did not finish", cfg.qualify("gold", spec.name))
                raise
            log.info("wrote %s: %d rows", *written[spec.name])
    finally:
        remove(obt.sparkSession, path)
    return written


def build_marts(obt: DataFrame, cfg: PipelineConfig) -> dict[str, Written]:
    """Write every mart; return ``{mart: written table}`` in mart order.

    The grains share nothing, so their jobs are submitted from
    ``cfg.parallel_jobs`` driver threads; Spark runs them side by side on
    the executors (one grain's small stages fill the gaps of another's)."""
    ensure_layer(obt.sparkSession, cfg, "gold")
    written: dict[str, Written] = {}
    with ThreadPoolExecutor(max_workers=max(1, cfg.parallel_jobs)) as pool:
        for part in pool.map(lambda g: build_grain(obt, g, cfg), list(marts.GRAINS)):
            written.update(part)
    return {m.name: written[m.name] for m in marts.MARTS}


def build_summary(spark: SparkSession, written: dict[str, Written]) -> DataFrame:
    """``(table_name, rows_written, row_count, comment)`` of the written marts;
    the comment is read back from the catalog."""
    comments = {short: table_comment(spark, w.name) for short, w in written.items()}
    counts = verify(row_counts(spark, {short: w.name for short, w in written.items()}), written)
    mapping = F.create_map(*[x for k, v in comments.items() for x in (F.lit(k), F.lit(v))])
    return counts.select("table_name", "rows_written", "row_count", mapping[F.col("table_name")].alias("comment"))


def build_gold(spark: SparkSession, cfg: PipelineConfig) -> DataFrame:
    written = build_marts(load_table(spark, cfg, "silver", OBT_TABLE), cfg)
    return build_summary(spark, written)


def previews(spark: SparkSession, cfg: PipelineConfig) -> dict[str, DataFrame]:
    """The four top-5 samples, read from the written gold tables."""
    return {p.name: preview(load_table(spark, cfg, "gold", p.mart), p) for p in PREVIEWS}
