"""Registered queries: name → callable(spark, sf_dir) → DataFrame.

Every query starts from the driver's parquet tables through the fixture
mapping (tarmac.sources.fixtures) and runs over them whole.  Queries of the
layer jobs (bronze/silver/gold builds) write their tables under a root in the
shared checkpoint folder and return what the job reports.
"""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from tarmac.config import PipelineConfig, default_config
from tarmac.operators import marts, series, topk, views
from tarmac.operators.join import build_obt
from tarmac.plans import build_bronze, build_gold, build_silver
from tarmac.plans.bronze import ingest
from tarmac.plans.dashboard import DEFAULT, Dashboard
from tarmac.plans.silver import write_obt
from tarmac.schemas import SCHEMAS, SourceSpec
from tarmac.sources import csv as csv_source
from tarmac.sources import fixtures
from tarmac.sources.staging import process_staging
from tarmac.sources.tables import load_table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def config(spark: SparkSession, **kw) -> PipelineConfig:
    return default_config(spark, "queries", **kw)


def build_config(spark: SparkSession, sf_dir: str, query: str | None = None, **kw) -> PipelineConfig:
    """A warehouse root per data directory under the shared checkpoint folder.

    A registered query that writes gets its own root and its own layer schema
    names, so queries never share tables even when run side by side."""
    tag = re.sub(r"[^A-Za-z0-9]+", "_", sf_dir.strip("/")) or "data"
    if query is None:
        return default_config(spark, f"build/{tag}", **kw)
    layers = {layer: f"{layer}_{query}" for layer in ("bronze", "silver", "gold")}
    return default_config(spark, f"build/{tag}/{query}", **layers, **kw)


def export_sources(spark: SparkSession, sf_dir: str, cfg: PipelineConfig, names=None) -> dict[str, str]:
    return fixtures.export_csv(spark, sf_dir, f"{cfg.root}/csv", names)


def obt(spark: SparkSession, sf_dir: str, cfg: PipelineConfig | None = None) -> DataFrame:
    cfg = cfg or config(spark)
    src = fixtures.sources(spark, sf_dir)
    return build_obt(src["bookings"], src["passengers"], src["airports"], cfg)


# ── gold marts and previews ────────────────────────────────────────────────


def _mart(name: str) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        cfg = config(spark)
        return marts.build_mart(obt(spark, sf_dir, cfg), name, cfg)

    return run


def _preview(spec: topk.Preview) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return topk.preview(_mart(spec.mart)(spark, sf_dir), spec)

    return run


def spoil_dates(bookings: DataFrame) -> DataFrame:
    """Some booking dates made unparsable: a trailing time, a month 13."""
    d = F.col("booking_date")
    spoiled = (
        F.when(F.col("booking_id") % 13 == 0, F.concat(d, F.lit(" 10:00:00")))
        .when(F.col("booking_id") % 17 == 0, F.concat(F.substring(d, 1, 5), F.lit("13"), F.substring(d, 8, 3)))
        .otherwise(d)
    )
    return bookings.withColumn("booking_date", spoiled)


def bad_dates_as_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    cfg = config(spark, on_bad_date="null")
    src = fixtures.sources(spark, sf_dir)
    wide = build_obt(spoil_dates(src["bookings"]), src["passengers"], src["airports"], cfg)
    return marts.build_mart(wide, "gold_peak_travel_days", cfg)


QUERIES.update({m.name: _mart(m.name) for m in marts.MARTS})
QUERIES.update({p.name: _preview(p) for p in topk.PREVIEWS})
QUERIES["bad_dates_as_null"] = bad_dates_as_null


# ── dashboard views ────────────────────────────────────────────────────────


def airport_views(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Revenue and performance views finalized from one airport-grain state.

    The states (one row per airport) are staged on the shared root, so whatever
    a query derives from the views (selection, slots, maxima, positions) reads
    the bookings once."""
    cfg = config(spark)
    states = process_staging(spark).write(marts.grain_states(obt(spark, sf_dir, cfg), "airport", cfg), "airport-states")
    rev = marts.finalize(states, marts.MART_BY_NAME["gold_airport_revenue_summary"])
    perf = marts.finalize(states, marts.MART_BY_NAME["gold_airport_performance"])
    return views.revenue_view(rev), views.performance_view(perf)


def _on_views(f: Callable[[DataFrame, DataFrame], DataFrame]) -> Query:
    """A query over the revenue and the performance view."""
    return lambda spark, sf_dir: f(*airport_views(spark, sf_dir))


def _default(view: DataFrame) -> DataFrame:
    """The view filtered by its default selection (first five names)."""
    return views.filter_airports(view, views.default_selection(view))


def _everything(view: DataFrame) -> DataFrame:
    """The view after "select all" (every non-null name)."""
    return views.filter_airports(view, None)


def _bar(of: str, column: str) -> Query:
    def series_of(rev: DataFrame, perf: DataFrame) -> DataFrame:
        selected = _everything(rev if of == "revenue" else perf)
        return series.bar_series(selected, column, series.category_slots(rev, perf))

    return _on_views(series_of)


QUERIES.update(
    {
        "view_airport_revenue": _on_views(lambda rev, perf: rev),
        "view_airport_performance": _on_views(lambda rev, perf: perf),
        "airport_options": _on_views(lambda rev, perf: views.airport_options(rev)),
        "default_airports": _on_views(lambda rev, perf: views.default_selection(rev)),
        "selected_airport_revenue": _on_views(lambda rev, perf: _default(rev)),
        "selected_airport_performance": _on_views(lambda rev, perf: _default(perf)),
        "kpis_empty_selection": _on_views(lambda rev, perf: views.revenue_kpis(rev, [])),
        "airport_slots": _on_views(series.category_slots),
        "revenue_kpis": _on_views(lambda rev, perf: views.revenue_kpis(rev, views.default_selection(rev))),
        "performance_kpis": _on_views(lambda rev, perf: views.performance_kpis(perf, views.default_selection(perf))),
        "revenue_table": _on_views(lambda rev, perf: series.revenue_table(_everything(rev))),
        "performance_table": _on_views(lambda rev, perf: series.performance_table(_everything(perf))),
        "chart_bookings": _bar("revenue", "total_bookings"),
        "chart_revenue": _bar("revenue", "total_revenue"),
        "chart_avg_revenue": _bar("revenue", "avg_revenue_per_booking"),
        "chart_revenue_per_pax": _bar("performance", "revenue_per_pax"),
        "chart_pax_per_flight": _bar("performance", "pax_per_flight"),
        "chart_booking_range": _on_views(lambda rev, perf: series.booking_range(_everything(perf))),
        "chart_revenue_scatter": _on_views(
            lambda rev, perf: series.revenue_scatter(_default(rev), series.category_slots(rev, perf))
        ),
        "chart_performance_scatter": _on_views(
            lambda rev, perf: series.performance_scatter(_everything(perf), series.category_slots(rev, perf))
        ),
    }
)


# ── layer jobs: bronze / silver / gold builds ──────────────────────────────


def _bronze_source(name: str) -> Query:
    """One source through the CSV round trip: export, then typed ingestion."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        cfg = build_config(spark, sf_dir, f"bronze_{name}")
        path = export_sources(spark, sf_dir, cfg, [name])[name]
        return csv_source.read_source(spark, SourceSpec(name, path, SCHEMAS[name]))

    return run


def bronze_normalized_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    airports = fixtures.airports(spark, sf_dir)
    untidy = airports.toDF(*[fixtures.CSV_HEADERS["airports"][c] for c in airports.columns])
    return csv_source.normalize_columns(untidy)


def bronze_null_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = csv_source.normalize_columns(fixtures.untidy(fixtures.bookings(spark, sf_dir), "bookings"))
    return csv_source.cast_by_name(csv_source.null_tokens(text), SCHEMAS["bookings"], "bookings")


def bronze_row_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    cfg = build_config(spark, sf_dir, "bronze_row_counts")
    return build_bronze(spark, cfg, export_sources(spark, sf_dir, cfg))


def silver_row_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    cfg = build_config(spark, sf_dir, "silver_row_counts")
    build_bronze(spark, cfg, export_sources(spark, sf_dir, cfg))
    return build_silver(spark, cfg)


def unmatched_bookings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of the written wide table without a key of a dimension, and with a key that it does not have."""
    cfg = build_config(spark, sf_dir, "unmatched")
    src = fixtures.sources(spark, sf_dir)
    return write_obt(src["bookings"], src["passengers"], src["airports"], cfg)[1]


def gold_build_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    cfg = build_config(spark, sf_dir, "gold_build_summary")
    build_bronze(spark, cfg, export_sources(spark, sf_dir, cfg))
    build_silver(spark, cfg)
    return build_gold(spark, cfg)


def bronze_line_breaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names with a line break, commas and quotes through the CSV round trip."""
    cfg = build_config(spark, sf_dir, "bronze_line_breaks")
    people = fixtures.passengers(spark, sf_dir)
    name = F.concat("name", F.lit('\nof "'), "nationality", F.lit('", '), "gender")
    path = f"{cfg.root}/csv/people.csv"
    csv_source.write_csv(fixtures.untidy(people.withColumn("name", name), "passengers"), path)
    return csv_source.read_source(spark, SourceSpec("passengers", path, SCHEMAS["passengers"])).select(people.columns)


def bronze_inferred_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bookings without a schema: ids become bigint, amounts double, dates text."""
    cfg = build_config(spark, sf_dir, "bronze_inferred_types")
    path = export_sources(spark, sf_dir, cfg, ["bookings"])["bookings"]
    return csv_source.read_source(spark, SourceSpec("bookings", path, None))


def seat_codes(bookings: DataFrame) -> DataFrame:
    """Columns that look like numbers to a careless reader, and some that are."""
    seat = F.concat((F.col("flight_id") % 40 + 1).cast("string"), F.element_at(F.array(*map(F.lit, "DFdf")), (F.col("flight_id") % 4 + 1).cast("int")))
    return bookings.select(
        "booking_id",
        seat.alias("seat"),
        F.concat(F.lit("0x1p"), F.col("flight_id") % 9).alias("tag"),
        F.lpad(F.col("flight_id").cast("string"), 9, "0").alias("ticket"),
        F.col("amount").cast("decimal(12,2)").cast("string").alias("price"),
        F.col("booking_date").alias("day"),
        (F.col("flight_id") % 2 == 0).cast("string").alias("paid"),
    )


def bronze_exact_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Codes such as 10D, 0x1p3 and 007 stay text; ids, prices, days and truth values get their types."""
    cfg = build_config(spark, sf_dir, "bronze_exact_types")
    path = f"{cfg.root}/csv/codes.csv"
    csv_source.write_csv(seat_codes(fixtures.bookings(spark, sf_dir)), path)
    frame = csv_source.read_source(spark, SourceSpec("codes", path, None, infer="exact"))
    kinds = [F.lit(kind).alias(f"{c}_type") for c, kind in frame.dtypes]
    return frame.select("*", *kinds).withColumn("price", F.col("price").cast("double"))


def bronze_line_breaks_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same names, each file divided into some eight byte ranges that may begin inside a name."""
    cfg = build_config(spark, sf_dir, "bronze_ranges")
    people = fixtures.passengers(spark, sf_dir)
    name = F.concat("name", F.lit('\nof "'), "nationality", F.lit('", '), "gender")
    path = f"{cfg.root}/csv/people.csv"
    csv_source.write_csv(fixtures.untidy(people.withColumn("name", name), "passengers"), path)
    conf, key = spark.conf, "spark.sql.files.maxPartitionBytes"
    before = conf.get(key)
    conf.set(key, str(max(64, csv_source.largest_file(spark, path) // 8)))
    try:
        ingest(spark, cfg, SourceSpec("passengers", path, SCHEMAS["passengers"]))
    finally:
        conf.set(key, before)
    return load_table(spark, cfg, "bronze", "passengers").select(people.columns)


def gold_airport_revenue_string_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Text ids, by a schema of the caller, through the CSV, the wide table and a mart."""
    cfg = build_config(spark, sf_dir, "string_ids")
    prefix = {"booking_id": "B", "passenger_id": "P", "airport_id": "A"}
    wide = {}
    for name, df in fixtures.sources(spark, sf_dir).items():
        text = df.select(*[F.concat(F.lit(prefix[c]), c).alias(c) if c in prefix else F.col(c) for c in df.columns])
        path = f"{cfg.root}/csv/{name}.csv"
        csv_source.write_csv(fixtures.untidy(text, name), path)
        schema = StructType([StructField(f.name, StringType()) if f.name in prefix else f for f in SCHEMAS[name]])
        wide[name] = csv_source.read_source(spark, SourceSpec(name, path, schema))
    return marts.build_mart(build_obt(*wide.values(), cfg), "gold_airport_revenue_summary", cfg)


def gold_subcent_revenue(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Amounts of four decimals, through the CSV: rounded once, in the mart."""
    cfg = build_config(spark, sf_dir, "subcent")
    path = f"{cfg.root}/csv/bookings.csv"
    csv_source.write_csv(fixtures.untidy(fixtures.bookings(spark, sf_dir, fixtures.discounted), "bookings"), path)
    bookings = csv_source.read_source(spark, SourceSpec("bookings", path, SCHEMAS["bookings"]))
    wide = build_obt(bookings, fixtures.passengers(spark, sf_dir), fixtures.airports(spark, sf_dir), cfg)
    return marts.build_mart(wide, "gold_airport_revenue_summary", cfg)


def _dashboard(tab: str, frame: str) -> Query:
    """A frame of the dashboard, read from gold tables that the three layer jobs have written."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        cfg = build_config(spark, sf_dir, f"dashboard_{tab}_{frame}")
        build_bronze(spark, cfg, export_sources(spark, sf_dir, cfg))
        build_silver(spark, cfg)
        build_gold(spark, cfg)
        board = Dashboard(spark, cfg)
        show = board.revenue_tab if tab == "revenue" else board.performance_tab
        return show(DEFAULT if frame == "kpis" else None)[frame]

    return run


QUERIES.update(
    {
        "bronze_bookings": _bronze_source("bookings"),
        "bronze_passengers": _bronze_source("passengers"),
        "bronze_airports": _bronze_source("airports"),
        "bronze_normalized_names": bronze_normalized_names,
        "bronze_null_tokens": bronze_null_tokens,
        "bronze_row_counts": bronze_row_counts,
        "silver_bookings_obt": obt,
        "silver_row_counts": silver_row_counts,
        "unmatched_bookings": unmatched_bookings,
        "gold_build_summary": gold_build_summary,
        "bronze_line_breaks": bronze_line_breaks,
        "bronze_inferred_types": bronze_inferred_types,
        "bronze_exact_types": bronze_exact_types,
        "bronze_line_breaks_ranges": bronze_line_breaks_ranges,
        "gold_airport_revenue_string_ids": gold_airport_revenue_string_ids,
        "gold_subcent_revenue": gold_subcent_revenue,
        **{f"dashboard_{tab}_{frame}": _dashboard(tab, frame) for tab in ("revenue", "performance") for frame in ("kpis", "table")},
    }
)
