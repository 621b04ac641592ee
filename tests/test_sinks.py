"""Tables: comments, schema changes on overwrite, reruns in a new process."""

from __future__ import annotations

import os
import subprocess
import sys
import textwrap

import pytest

from conftest import ROOT, SF_SMALL
from tarmac import registry
from tarmac.operators import marts
from tarmac.plans import build_bronze, build_gold, build_silver
from tarmac.sources import tables
from tarmac.sources.tables import Written, list_layer, load_table, row_counts, table_comment, verify, write_table


def test_comment_with_quote_stored_verbatim(spark, cfg):
    df = spark.range(3)
    full, rows = write_table(df, cfg, "gold", "t_comment", "it's a \\ test")
    assert table_comment(spark, full) == "it's a \\ test" and rows == 3


def test_schema_change_on_overwrite(spark, cfg):
    write_table(spark.range(2), cfg, "gold", "t_schema")
    write_table(spark.range(2).selectExpr("id", "'x' AS s"), cfg, "gold", "t_schema")
    assert load_table(spark, cfg, "gold", "t_schema").columns == ["id", "s"]


def test_full_build_matches_lazy_marts(spark, cfg):
    sources = registry.export_sources(spark, SF_SMALL, cfg)
    counts = {r.table_name: r.row_count for r in build_bronze(spark, cfg, sources).collect()}
    assert counts["bookings"] == 6000 and list_layer(spark, cfg, "bronze") == ["airports", "bookings", "passengers"]
    assert build_silver(spark, cfg).collect()[0].row_count == 6000
    summary = {r.table_name: r for r in build_gold(spark, cfg).collect()}
    obt = registry.obt(spark, SF_SMALL, cfg)
    for spec in marts.MARTS:
        written = load_table(spark, cfg, "gold", spec.name)
        lazy = marts.build_mart(obt, spec.name, cfg)
        assert written.columns == lazy.columns
        assert sorted(map(repr, written.collect())) == sorted(map(repr, lazy.collect())), spec.name
        assert summary[spec.name].comment == spec.comment
        assert summary[spec.name].row_count == lazy.count()


def test_rerun_in_a_new_process(spark, cfg):
    """A second process reuses the same root: bronze/silver/gold overwrite cleanly
    and a layer written by another process is found again by path."""
    script = textwrap.dedent(
        f"""
        import sys
        sys.path.insert(0, {ROOT!r})
        from tarmac.session import build_session
        from tarmac.config import PipelineConfig
        from tarmac import registry
        from tarmac.plans import build_bronze, build_silver, build_gold
        spark = build_session("rerun", master="local[2]", **{{"spark.sql.shuffle.partitions": "4"}})
        cfg = PipelineConfig(root={cfg.root!r})
        build_bronze(spark, cfg, registry.export_sources(spark, {SF_SMALL!r}, cfg)).collect()
        build_silver(spark, cfg).collect()
        print("ROWS", sum(r.row_count for r in build_gold(spark, cfg).collect()))
        spark.stop()
        """
    )
    outs = []
    for _ in range(2):
        res = subprocess.run([sys.executable, "-c", script], capture_output=True, text=True, timeout=600)
        assert res.returncode == 0, res.stderr[-2000:]
        outs.append([line for line in res.stdout.splitlines() if line.startswith("ROWS")])
    assert outs[0] == outs[1] and outs[0]
    # a third reader in this process sees the silver table by its path
    assert load_table(spark, cfg, "silver", "bookings_obt").count() == 6000


def test_three_part_names_with_a_catalog(spark, cfg):
    named = cfg.with_(catalog="spark_catalog")
    full, _ = write_table(spark.range(4), named, "bronze", "t_catalog", "three-part")
    assert full == "spark_catalog.bronze.t_catalog"
    assert "t_catalog" in list_layer(spark, named, "bronze")
    assert load_table(spark, named, "bronze", "t_catalog").count() == 4
    assert table_comment(spark, full) == "three-part"


def test_reading_never_drops_a_table(spark, cfg):
    """A managed table of the same name stays, with its files; the layer's own files are read by path."""
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS {cfg.gold}")
    name = f"{cfg.gold}.t_managed"
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    spark.range(7).write.saveAsTable(name)
    try:
        with pytest.raises(Exception):
            load_table(spark, cfg, "gold", "t_managed")  # nothing under this root
        assert spark.table(name).count() == 7
        spark.range(2).write.parquet(cfg.location("gold", "t_managed"))
        assert load_table(spark, cfg, "gold", "t_managed").count() == 2
        assert spark.table(name).count() == 7
    finally:
        spark.sql(f"DROP TABLE {name}")


def test_a_count_that_differs_raises(spark, cfg):
    full, rows = write_table(spark.range(5), cfg, "bronze", "t_verified")
    counts = row_counts(spark, {"t_verified": full})
    assert [tuple(r) for r in verify(counts, {"t_verified": Written(full, rows)}).collect()] == [("t_verified", 5, 5)]
    with pytest.raises(RuntimeError, match="differ"):
        verify(counts, {"t_verified": Written(full, 6)})


def test_staged_states_are_removed(spark, cfg):
    sources = registry.export_sources(spark, SF_SMALL, cfg)
    build_bronze(spark, cfg, sources)
    build_silver(spark, cfg)
    build_gold(spark, cfg)
    staging = cfg.staging("").removeprefix("file://")
    assert not os.path.isdir(staging) or os.listdir(staging) == []


def failing(spark, n):
    """A frame that raises when its last row is computed, with the others written by then or not."""
    from pyspark.sql import functions as F

    bad = F.when(F.col("id") == n - 1, F.raise_error(F.lit("half way"))).otherwise(F.col("id"))
    return spark.range(0, n, 1, 4).select(bad.cast("bigint").alias("id"))


def test_a_write_that_fails_half_way_leaves_the_table(spark, cfg):
    write_table(spark.range(10), cfg, "gold", "t_swap", "first")
    before = tables.versions(spark, cfg.location("gold", "t_swap"))
    with pytest.raises(Exception, match="half way"):
        write_table(failing(spark, 1000), cfg, "gold", "t_swap", "second")
    assert load_table(spark, cfg, "gold", "t_swap").count() == 10 and spark.table(f"{cfg.gold}.t_swap").count() == 10
    assert table_comment(spark, f"{cfg.gold}.t_swap") == "first"
    assert tables.versions(spark, cfg.location("gold", "t_swap")) == before


def test_a_first_write_that_fails_leaves_nothing(spark, cfg):
    with pytest.raises(Exception, match="half way"):
        write_table(failing(spark, 1000), cfg, "gold", "t_never")
    assert tables.versions(spark, cfg.location("gold", "t_never")) == []
    assert "t_never" not in list_layer(spark, cfg, "gold")


def test_a_count_mismatch_leaves_the_table(spark, cfg, monkeypatch):
    write_table(spark.range(10), cfg, "gold", "t_lost")
    lost = spark.range(20).filter("id < 19")

    class Reader:
        """Reads back fewer rows than were written, as lost files would."""

        def format(self, _):
            return self

        schema = format

        def load(self, _):
            return lost

    with monkeypatch.context() as m:
        m.setattr(type(spark), "read", property(lambda self: Reader()))
        with pytest.raises(RuntimeError, match="20 rows written, 19 read back"):
            write_table(spark.range(20), cfg, "gold", "t_lost")
    assert load_table(spark, cfg, "gold", "t_lost").count() == 10


def test_a_table_may_be_computed_from_itself(spark, cfg):
    write_table(spark.range(3), cfg, "gold", "t_self")
    for n in (6, 12, 24):
        old = load_table(spark, cfg, "gold", "t_self")
        write_table(old.unionByName(old), cfg, "gold", "t_self")
        assert spark.table(f"{cfg.gold}.t_self").count() == n
    assert len(tables.versions(spark, cfg.location("gold", "t_self"))) == cfg.keep_versions


def test_a_reader_goes_by_the_mark_not_by_the_catalog(spark, cfg):
    """As after a process that ended between the mark and the catalog's change, or before the mark."""
    write_table(spark.range(3), cfg, "gold", "t_mark")
    base = cfg.location("gold", "t_mark")
    spark.range(5).write.parquet(f"{base}/v-0000000007-x")
    assert load_table(spark, cfg, "gold", "t_mark").count() == 3
    open(f"{base.removeprefix('file://')}/v-0000000007-x/{tables.VERIFIED}", "w").close()
    assert load_table(spark, cfg, "gold", "t_mark").count() == 5 == spark.table(f"{cfg.gold}.t_mark").count()
    write_table(spark.range(6), cfg, "gold", "t_mark")
    assert tables.versions(spark, base)[-1].startswith("v-0000000008-")


def test_a_managed_table_elsewhere_is_not_replaced(spark, cfg):
    name = f"{cfg.gold}.t_owned"
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS {cfg.gold}")
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    spark.range(7).write.saveAsTable(name)
    try:
        with pytest.raises(ValueError, match="managed table"):
            write_table(spark.range(2), cfg, "gold", "t_owned")
        assert spark.table(name).count() == 7
    finally:
        spark.sql(f"DROP TABLE {name}")


def test_staging_goes_when_a_mart_fails(spark, cfg, monkeypatch):
    from tarmac.plans import gold

    monkeypatch.setattr(gold, "write_table", lambda *a, **k: (_ for _ in ()).throw(RuntimeError("no space")))
    with pytest.raises(RuntimeError, match="no space"):
        gold.build_grain(registry.obt(spark, SF_SMALL, cfg), "airport", cfg)
    staging = cfg.staging("").removeprefix("file://")
    assert os.listdir(staging) == []


def scanned_rows(df):
    """Rows that the Parquet scan handed on, from the metrics of the executed plan."""
    df.collect()
    plan = df._jdf.queryExecution().executedPlan()
    leaves = plan.collectLeaves()
    total = 0
    for i in range(leaves.size()):
        leaf = leaves.apply(i)
        if "AdaptiveSparkPlan" in leaf.nodeName():
            inner = leaf.executedPlan().collectLeaves()
            total += sum(inner.apply(k).metrics().apply("numOutputRows").value() for k in range(inner.size()))
        else:
            total += leaf.metrics().apply("numOutputRows").value()
    return total


def test_a_selection_by_name_skips_row_groups(spark, cfg):
    """Names lie in no order (the mart is sorted by revenue), so only the Bloom filters can tell."""
    from pyspark.sql import functions as F

    from tarmac.operators import views

    names = F.format_string("Airport %07d", F.xxhash64("id") % 5_000_000)
    rows = spark.range(0, 60_000, 1, 1).select(
        names.alias("airport_name"), F.lit("c").alias("city"), F.lit("k").alias("country"),
        F.col("id").alias("total_bookings"), F.rand(1).alias("total_revenue"), F.rand(2).alias("avg_revenue_per_booking"),
    )
    key = "parquet.block.size"
    hadoop = spark.sparkContext._jsc.hadoopConfiguration()
    hadoop.set(key, str(64 << 10))
    hadoop.set("parquet.page.row.count.limit", "500")
    try:
        write_table(rows, cfg, "gold", "t_lookup", lookup=["airport_name"])
        write_table(rows, cfg, "gold", "t_plain")
    finally:
        hadoop.unset(key)
        hadoop.unset("parquet.page.row.count.limit")
    chosen = [r.airport_name for r in rows.limit(2).collect()]
    found = {}
    for table in ("t_lookup", "t_plain"):
        view = views.revenue_view(load_table(spark, cfg, "gold", table), ordered=False)
        found[table] = scanned_rows(views.filter_airports(view, chosen))
        assert sorted(r.airport_name for r in views.filter_airports(view, chosen).collect()) == sorted(chosen)
    assert found["t_lookup"] < found["t_plain"] / 3
