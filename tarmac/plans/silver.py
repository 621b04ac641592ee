"""Silver: the wide table, bookings ⟕ passengers ⟕ airports.

The left joins keep bookings without a passenger or an airport; how many there
are is counted on the rows that are written, while they are written.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession

from tarmac.config import PipelineConfig
from tarmac.operators.join import build_obt
from tarmac.sources.tables import Written, load_table, row_counts, verify, write_table

OBT_TABLE = "bookings_obt"
DIMENSIONS = {"passengers": "passenger_id", "airports": "airport_id"}


def write_obt(
    bookings: DataFrame, passengers: DataFrame, airports: DataFrame, cfg: PipelineConfig
) -> tuple[Written, DataFrame]:
    """Write the wide table; return what was written and ``(dimension, null_key_rows, dangling_key_rows)``: its rows
    without a key of the dimension, and those whose key the dimension does not have."""
    seen = Observation("silver.unmatched")
    wide = build_obt(bookings, passengers, airports, cfg, tuple(DIMENSIONS.values()), seen)
    written = write_table(wide, cfg, "silver", OBT_TABLE)
    rows = [(name, seen.get[f"null:{key}"], seen.get[f"dangling:{key}"]) for name, key in DIMENSIONS.items()]
    schema = "dimension string, null_key_rows bigint, dangling_key_rows bigint"
    return written, bookings.sparkSession.createDataFrame(rows, schema)


def build_silver_audited(spark: SparkSession, cfg: PipelineConfig) -> tuple[DataFrame, DataFrame]:
    """(rows written and read back, unmatched rows by dimension)."""
    frames = (load_table(spark, cfg, "bronze", n) for n in ("bookings", *DIMENSIONS))
    written, unmatched = write_obt(*frames, cfg)
    return verify(row_counts(spark, {OBT_TABLE: written.name}), {OBT_TABLE: written}), unmatched


def build_silver(spark: SparkSession, cfg: PipelineConfig) -> DataFrame:
    return build_silver_audited(spark, cfg)[0]
