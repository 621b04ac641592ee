"""Catalog tables: layer schemas, overwrite writes with comments, listing, counts.

A table is a folder under ``cfg.root`` (shared storage) with a sub-folder for
each version.  A write fills a new version, counts its rows again, and only
then marks it verified, which creates one empty file: the highest verified
version is the table.  A write that fails or does not verify leaves the table
as it was and takes its own files away.  After the mark, the catalog's entry is
pointed at the new version, and versions older than ``cfg.keep_versions`` go.
A process that ends between these steps loses nothing: readers go by the mark.
(Delta tables are overwritten by Delta's own transaction.)
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from functools import reduce
from typing import NamedTuple

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tarmac.config import PipelineConfig

LAYERS = ("bronze", "silver", "gold")


class Written(NamedTuple):
    """A written table: its qualified name and the rows that went into it."""

    name: str
    rows: int


def sql_string(text: str) -> str:
    """Quote ``text`` as a Spark SQL string literal."""
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def ensure_layer(spark: SparkSession, cfg: PipelineConfig, layer: str) -> str:
    db = cfg.qualify_db(layer)
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS {db} LOCATION {sql_string(cfg.location(layer))}")
    return db


def set_comment(spark: SparkSession, table: str, comment: str) -> None:
    spark.sql(f"COMMENT ON TABLE {table} IS {sql_string(comment)}")


def table_comment(spark: SparkSession, table: str) -> str | None:
    return spark.catalog.getTable(table).description


VERIFIED = "_VERIFIED"


def _folder(spark: SparkSession, path: str):
    """Hadoop path and file system of a folder."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return target, target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def _child(spark: SparkSession, path: str, name: str):
    return _folder(spark, f"{path.rstrip('/')}/{name}")[0]


def versions(spark: SparkSession, base: str) -> list[str]:
    """Names of a table's version folders, oldest first, verified or not."""
    target, fs = _folder(spark, base)
    if not fs.exists(target):
        return []
    names = [s.getPath().getName() for s in fs.listStatus(target) if s.isDirectory()]
    return sorted(n for n in names if n.startswith("v-"))


def current_path(spark: SparkSession, base: str) -> str:
    """Folder of the table's files: its highest verified version, or itself if it has no versions."""
    _, fs = _folder(spark, base)
    for name in reversed(versions(spark, base)):
        if fs.exists(_child(spark, f"{base}/{name}", VERIFIED)):
            return f"{base}/{name}"
    return base


def write_table(
    df: DataFrame,
    cfg: PipelineConfig,
    layer: str,
    name: str,
    comment: str | None = None,
    lookup: Sequence[str] = (),
) -> Written:
    """Full overwrite of ``layer.name``; the schema may change between runs.

    Files carry Bloom filters of the ``lookup`` columns (Parquet), so that a read
    for a few of their values skips row groups without them, in whatever order
    the rows lie.

    The rows are counted on their way out and again in the written files; a
    difference raises and leaves the table as it was.  ``df`` may read the
    table that it replaces.  Returns the qualified table name and that count."""
    spark = df.sparkSession
    ensure_layer(spark, cfg, layer)
    full = cfg.qualify(layer, name)
    seen = Observation(f"{layer}.{name}")
    df = df.observe(seen, F.count(F.lit(1)).alias("rows"))
    if cfg.format == "delta":
        writer = df.write.format("delta").mode("overwrite").option("overwriteSchema", "true")
        writer.option("path", cfg.location(layer, name)).saveAsTable(full)
    else:
        base = cfg.location(layer, name)
        last = max((int(v.split("-")[1]) for v in versions(spark, base)), default=0)
        path = f"{base}/v-{last + 1:010d}-{uuid.uuid4().hex[:8]}"
        try:
            blooms = {f"parquet.bloom.filter.enabled#{c}": "true" for c in lookup}
            df.write.format(cfg.format).mode("error").options(**blooms).save(path)
            found = spark.read.format(cfg.format).schema(df.schema).load(path).count()
            if found != seen.get["rows"]:
                raise RuntimeError(f"{full}: {seen.get['rows']} rows written, {found} read back")
        except BaseException:
            remove(spark, path)
            raise
        _, fs = _folder(spark, path)
        fs.create(_child(spark, path, VERIFIED), False).close()
        _point(spark, full, base, path, cfg.format, df)
        for old in versions(spark, base)[: -max(1, cfg.keep_versions)]:
            remove(spark, f"{base}/{old}")
    spark.sql(f"COMMENT ON TABLE {full} IS {'NULL' if comment is None else sql_string(comment)}")
    return Written(full, seen.get["rows"])


def _point(spark: SparkSession, full: str, base: str, path: str, source: str, df: DataFrame) -> None:
    """Make the catalog's entry show the files at ``path``: its location changes if the columns stay, else the entry is
    made anew.  An entry that owns files elsewhere is not touched."""
    if spark.catalog.tableExists(full):
        location = table_location(spark, full)
        kind = spark.catalog.getTable(full).tableType
        if kind == "MANAGED":
            raise ValueError(f"{full} is a managed table at {location}; it is not replaced")
        columns = [(f.name, f.dataType) for f in spark.table(full).schema.fields]
        if _within(location, base) and columns == [(f.name, f.dataType) for f in df.schema.fields]:
            spark.sql(f"ALTER TABLE {full} SET LOCATION {sql_string(path)}")
            spark.catalog.refreshTable(full)
            return
        spark.sql(f"DROP TABLE {full}")
    spark.catalog.createTable(full, path=path, source=source, schema=df.schema)


def verify(counts: DataFrame, written: dict[str, "Written"]) -> DataFrame:
    """``(table_name, rows_written, row_count)``; a table whose count differs from what was written raises.

    ``counts`` has one row per table, so this check collects a listing, not data."""
    found = {r.table_name: r.row_count for r in counts.collect()}
    wrong = {t: (w.rows, found.get(t)) for t, w in written.items() if found.get(t) != w.rows}
    if wrong:
        raise RuntimeError(f"rows written and rows read back differ: {wrong}")
    rows = F.create_map(*[x for t, w in written.items() for x in (F.lit(t), F.lit(w.rows).cast("bigint"))])
    return counts.select("table_name", rows[F.col("table_name")].alias("rows_written"), "row_count")


def _plain(path: str) -> str:
    return path.removeprefix("file:").rstrip("/").replace("///", "/")


def _same_path(a: str, b: str) -> bool:
    return _plain(a) == _plain(b)


def _within(path: str | None, base: str) -> bool:
    return path is not None and f"{_plain(path)}/".startswith(f"{_plain(base)}/")


def table_location(spark: SparkSession, table: str) -> str | None:
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {table}").where("col_name = 'Location'").collect()
    return rows[0].data_type if rows else None


def load_table(spark: SparkSession, cfg: PipelineConfig, layer: str, name: str) -> DataFrame:
    """Read a layer table.

    The files under ``cfg.root`` are the source of truth.  A table written by
    another process (its catalog entry gone with that session, or left at an
    older version) is registered from its path; if the name is taken by a table
    elsewhere, that one is left alone and the files under the root are read by
    path."""
    full = cfg.qualify(layer, name)
    base = cfg.location(layer, name)
    path = base if cfg.format == "delta" else current_path(spark, base)
    if spark.catalog.tableExists(full):
        location = table_location(spark, full)
        if location is not None and _same_path(location, path):
            return spark.table(full)
        frame = spark.read.format(cfg.format).load(path)
        if not _same_path(path, base) and _within(location, base):
            _point(spark, full, base, path, cfg.format, frame)
            return spark.table(full)
        return frame
    ensure_layer(spark, cfg, layer)
    spark.catalog.createTable(full, path=path, source=cfg.format)
    return spark.table(full)


def list_layer(spark: SparkSession, cfg: PipelineConfig, layer: str) -> list[str]:
    """Table names of a layer (catalog metadata, one entry per table)."""
    return sorted(t.name for t in spark.catalog.listTables(cfg.qualify_db(layer)) if not t.isTemporary)


def row_counts(spark: SparkSession, tables: dict[str, str]) -> DataFrame:
    """``(table_name, row_count)`` for ``{short name: qualified name}``.

    One global count per table, unioned into a single job; each task counts its
    own split and only one number per task reaches the final aggregate."""
    parts = [
        spark.table(full).agg(F.count(F.lit(1)).alias("row_count")).select(
            F.lit(short).alias("table_name"), "row_count"
        )
        for short, full in tables.items()
    ]
    return reduce(DataFrame.unionByName, parts)


def layer_counts(spark: SparkSession, cfg: PipelineConfig, layer: str) -> DataFrame:
    """Row count of every table listed in a layer (write check / verification)."""
    return row_counts(spark, {t: cfg.qualify(layer, t) for t in list_layer(spark, cfg, layer)})


def remove(spark: SparkSession, path: str) -> None:
    """Delete files that no frame reads any more."""
    target, fs = _folder(spark, path)
    fs.delete(target, True)
