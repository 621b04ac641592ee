"""Dashboard views over the gold tables: reads, derived ratios, options,
selection, KPIs.

The dashboard worked on pandas copies in one process; here every step is a
DataFrame over the gold tables.  Global figures (KPIs, maxima, airport totals)
are one-row aggregates used as scalar subqueries, so no frame is collected to
the driver and no cross join is needed.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tarmac.functions.ratios import safe_ratio

REVENUE_COLUMNS = ("airport_name", "city", "country", "total_bookings", "total_revenue", "avg_revenue_per_booking")
PERFORMANCE_COLUMNS = (
    "airport_name",
    "city",
    "country",
    "total_flights",
    "unique_passengers",
    "total_bookings",
    "total_revenue",
    "avg_booking_value",
    "max_booking_value",
    "min_booking_value",
)
DEFAULT_SELECTION = 5
# Money columns of the views are doubles rounded to cents; sums over them go
# through this decimal so they are exact and independent of row order.
CENTS = "decimal(38,2)"

Selection = None | Sequence[str] | DataFrame


def _by_name(df: DataFrame, ordered: bool) -> DataFrame:
    return df.orderBy(F.col("airport_name").asc_nulls_last()) if ordered else df


def revenue_view(revenue_summary: DataFrame, ordered: bool = True) -> DataFrame:
    """Revenue tab data: six columns of ``gold_airport_revenue_summary``,
    ordered by name unless ``ordered=False`` (callers that sort themselves)."""
    return _by_name(revenue_summary.select(*REVENUE_COLUMNS), ordered)


def performance_view(performance: DataFrame, ordered: bool = True) -> DataFrame:
    """Performance tab data plus the two ratios (null when the divisor is 0)."""
    view = (
        performance.select(*PERFORMANCE_COLUMNS)
        .withColumn("pax_per_flight", safe_ratio(F.col("unique_passengers"), F.col("total_flights")))
        .withColumn("revenue_per_pax", safe_ratio(F.col("total_revenue"), F.col("unique_passengers")))
    )
    return _by_name(view, ordered)


def airport_options(view: DataFrame) -> DataFrame:
    """Distinct airport names (nulls dropped), sorted."""
    return (
        view.select("airport_name")
        .where(F.col("airport_name").isNotNull())
        .distinct()
        .orderBy("airport_name")
    )


def default_selection(view: DataFrame, k: int = DEFAULT_SELECTION) -> DataFrame:
    """The first ``k`` option names, with their 1-based position."""
    first = airport_options(view).limit(k)
    # ``first`` has at most k rows, so numbering it in one task is bounded.
    return first.select(F.row_number().over(Window.orderBy("airport_name")).alias("position"), "airport_name")


def filter_airports(view: DataFrame, selection: Selection) -> DataFrame:
    """Rows whose name is selected.

    ``None`` selects every option (all non-null names), a list filters with
    ``isin`` (pushed into the scan), an empty list gives no rows with the same
    schema, and a DataFrame of names is applied as a left-semi join.
    """
    name = F.col("airport_name")
    if selection is None:
        return view.where(name.isNotNull())
    if isinstance(selection, DataFrame):
        return view.join(selection.select("airport_name").distinct(), "airport_name", "left_semi").select(
            *view.columns
        )
    names = list(dict.fromkeys(selection))
    if not names:
        return view.where(F.lit(False))
    return view.where(name.isin(names))


def airports_total(view: DataFrame) -> Column:
    """``len(options)``: distinct non-null names of the whole view, as a scalar."""
    return view.agg(F.countDistinct("airport_name")).scalar()


def revenue_kpis(view: DataFrame, selection: Selection) -> DataFrame:
    """Airports shown / total, Σ bookings, Σ revenue, unweighted mean of the
    per-airport average (the revenue tab's KPI row)."""
    sel = filter_airports(view, selection)
    return sel.agg(
        F.count(F.lit(1)).alias("airports"),
        F.sum("total_bookings").alias("total_bookings"),
        F.sum(F.col("total_revenue").cast(CENTS)).cast("double").alias("total_revenue"),
        (
            F.sum(F.col("avg_revenue_per_booking").cast(CENTS)).cast("double")
            / F.count("avg_revenue_per_booking").cast("double")
        ).alias("avg_revenue_per_booking"),
    ).select("airports", airports_total(view).alias("airports_total"), "total_bookings", "total_revenue",
             "avg_revenue_per_booking")


def performance_kpis(view: DataFrame, selection: Selection) -> DataFrame:
    """Airports shown / total, Σ flights, Σ passengers (passenger-airport pairs:
    a passenger seen at two airports counts twice), Σrev/Σpax, Σrev/Σbookings."""
    sel = filter_airports(view, selection)
    revenue = F.sum(F.col("total_revenue").cast(CENTS)).cast("double")
    return sel.agg(
        F.count(F.lit(1)).alias("airports"),
        F.sum("total_flights").alias("total_flights"),
        F.sum("unique_passengers").alias("unique_passengers"),
        safe_ratio(revenue, F.sum("unique_passengers")).alias("revenue_per_passenger"),
        safe_ratio(revenue, F.sum("total_bookings")).alias("avg_booking_value"),
    ).select("airports", airports_total(view).alias("airports_total"), "total_flights", "unique_passengers",
             "revenue_per_passenger", "avg_booking_value")
