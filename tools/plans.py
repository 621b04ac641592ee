"""Write the physical plans of the main operators to docs/PLANS.md.

Runs against a build made by bench.py (or builds one at sf0.01 first)."""

from __future__ import annotations

import contextlib
import io
import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF = os.environ.get("PLANS_SF_DIR", "/root/testdata/sf0.01")


def formatted(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    text = buf.getvalue()
    tree, _, details = text.partition("\n\n\n")
    keep = [
        block
        for block in details.split("\n\n")
        if re.match(r"\(\d+\) Scan", block.strip())
    ]
    slim = []
    for block in keep:
        lines = [ln for ln in block.splitlines() if ln.startswith(("(", "ReadSchema", "PushedFilters"))]
        slim.append("\n".join(lines))
    return tree.strip() + "\n\n" + "\n\n".join(slim)


def main() -> None:
    from tarmac.session import build_session

    spark = build_session("plans", master="local[4]", **{"spark.sql.shuffle.partitions": "8"})
    from pyspark.sql import functions as F

    from tarmac.functions.ordinal import with_position
    from tarmac.operators import marts, series, topk, views
    from tarmac.operators.join import build_obt
    from tarmac.plans import build_bronze, build_gold, build_silver
    from tarmac.plans.silver import OBT_TABLE
    from tarmac.registry import build_config, export_sources
    from tarmac.schemas import SCHEMAS, SourceSpec
    from tarmac.sources.csv import read_source
    from tarmac.sources.tables import load_table

    cfg = build_config(spark, SF + "/plans")
    sources = export_sources(spark, SF, cfg)
    build_bronze(spark, cfg, sources).collect()
    build_silver(spark, cfg).collect()
    build_gold(spark, cfg).collect()
    bronze = {n: load_table(spark, cfg, "bronze", n) for n in ("bookings", "passengers", "airports")}
    silver = load_table(spark, cfg, "silver", OBT_TABLE)
    rev = views.revenue_view(load_table(spark, cfg, "gold", "gold_airport_revenue_summary"))
    sections = [
        ("Bronze: typed CSV read (bookings)", read_source(spark, SourceSpec("bookings", sources["bookings"], SCHEMAS["bookings"]))),
        ("Silver: wide table, dimensions proven small → broadcast", build_obt(bronze["bookings"], bronze["passengers"], bronze["airports"], cfg)),
        (
            "Silver: wide table, dimensions too large → salted shuffle joins (forced with broadcast_max_bytes=0)",
            build_obt(bronze["bookings"], bronze["passengers"], bronze["airports"], cfg.with_(broadcast_max_bytes=0)),
        ),
        ("Gold: airport grain states (3 marts)", marts.grain_states(silver, "airport", cfg)),
        ("Gold: passenger grain states (3 marts)", marts.grain_states(silver, "passenger", cfg)),
        ("Gold: gender mart as one lazy plan (rollup of passenger states)", marts.build_mart(silver, "gold_gender_booking_summary", cfg)),
        ("Gold: calendar grain, GROUPING SETS for month and day", marts.grain_states(silver, "calendar", cfg)),
        ("Gold: sorted write of gold_passenger_booking_summary", marts.sort_for_write(marts.build_mart(silver, "gold_passenger_booking_summary", cfg), marts.MART_BY_NAME["gold_passenger_booking_summary"])),
        ("Preview: top 5 airports by bookings", topk.preview(load_table(spark, cfg, "gold", "gold_top_airports"), topk.PREVIEW_BY_NAME["preview_top_airports"])),
        ("Dashboard: revenue KPIs for the default selection", views.revenue_kpis(rev, views.default_selection(rev))),
        ("Dashboard: an explicit airport list (isin pushed into the gold scan)", views.filter_airports(rev, ["A", "B"])),
        ("Dashboard: bar series (scalar axis max)", series.bar_series(views.filter_airports(rev, None), "total_revenue", series.category_slots(rev))),
        (
            "Positions: range partitions (checkpointed) + per-partition offsets",
            with_position(views.filter_airports(rev, None), [F.col("total_revenue").desc(), F.col("airport_name")]),
        ),
    ]
    out = ["# Physical plans", "", f"Generated by `tools/plans.py` on {SF} (local[4], 8 shuffle partitions, AQE on).",
           "Only the tree and the scan details (read schema, pushed filters) are kept.", ""]
    for title, df in sections:
        salted = "salted" in title
        if salted:
            # as at scale: the dimension is also above Spark's own broadcast limit
            spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        out += [f"## {title}", "", "```", formatted(df), "```", ""]
        if salted:
            spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    path = os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "docs", "PLANS.md")
    with open(path, "w") as fh:
        fh.write("\n".join(out))
    print(path)
    spark.stop()


if __name__ == "__main__":
    main()
