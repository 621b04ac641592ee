"""Chart-ready series and detail tables of the dashboard.

The dashboard drew figures and HTML from sorted pandas frames.  The data
behind each figure is produced here as a DataFrame: positions (sort order),
values, axis bounds, stable category slots, shares of the maximum, labels.
Positions are numbered over all tasks, all orders of a tab in one pass
(:func:`positions`), from which each series takes its rows; maxima and counts
are scalar subqueries.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tarmac.functions.ordinal import Order, in_series, with_position, with_positions
from tarmac.functions.ratios import capped_share
from tarmac.functions.text import first_word
from tarmac.sources.staging import Staging

PALETTE_SIZE = 10
AXIS_HEADROOM = 1.20
LABEL_MAX_POINTS = 10
# ties in every sort are broken by the identifying text columns of the views
TIE = ("airport_name", "city", "country")


def _tie_cols() -> list[Column]:
    return [F.col(c).asc_nulls_first() for c in TIE]


# Bars are sorted ascending by their value, detail tables by revenue from the highest.
RANK = "rank"
RANGE = "avg_booking_value"


def positions(selected: DataFrame, bars: Sequence[str], staging: Staging | None = None) -> DataFrame:
    """The selected rows once per order: ascending by each of ``bars``, and by rank; numbered in one pass."""
    orders = {c: Order(F.col(c)) for c in bars} | {RANK: Order(F.col("total_revenue"), descending=True)}
    return with_positions(selected, orders, _tie_cols(), staging=staging)


def category_slots(*views: DataFrame, size: int = PALETTE_SIZE, staging: Staging | None = None) -> DataFrame:
    """Stable slot ``0..size-1`` per airport name: names of all views, sorted,
    numbered from 0, modulo ``size`` (the same name gets the same slot on
    every tab)."""
    names = None
    for v in views:
        part = v.select("airport_name").where(F.col("airport_name").isNotNull())
        names = part if names is None else names.union(part)
    names = names.distinct()
    numbered = with_position(names, [F.col("airport_name").asc()], name="__n", start=0, staging=staging)
    return numbered.select("airport_name", (F.col("__n") % F.lit(size)).cast("int").alias("slot"))


def _with_slot(df: DataFrame, slots: DataFrame) -> DataFrame:
    # names missing from the slot table take slot 0
    return df.join(slots, "airport_name", "left").withColumn("slot", F.coalesce(F.col("slot"), F.lit(0)))


def bar_series(selected: DataFrame, value: str, slots: DataFrame, numbered: DataFrame | None = None) -> DataFrame:
    """Horizontal bar data: rows sorted ascending by ``value`` (nulls last),
    ``axis_max`` = 1.2 × the largest value, ``slot`` for the colour.

    ``numbered`` (from :func:`positions`) may be shared by the series of a tab."""
    ordered = in_series(numbered if numbered is not None else positions(selected, [value]), value)
    axis_max = ordered.agg(F.max(F.col(value).cast("double")) * F.lit(AXIS_HEADROOM)).scalar()
    return _with_slot(ordered.select("position", "airport_name", F.col(value).cast("double").alias("value")), slots).select(
        "position", "airport_name", "value", axis_max.alias("axis_max"), "slot"
    )


def booking_range(selected: DataFrame, numbered: DataFrame | None = None) -> DataFrame:
    """Grouped min / avg / max bars per airport, airports sorted by the average."""
    ordered = in_series(numbered if numbered is not None else positions(selected, [RANGE]), RANGE)
    long = ordered.unpivot(
        ["position", "airport_name"],
        ["min_booking_value", "avg_booking_value", "max_booking_value"],
        "measure",
        "value",
    )
    return long.select(
        "position",
        "airport_name",
        F.substring_index(F.col("measure"), "_", 1).alias("stat"),
        F.col("value").cast("double").alias("value"),
    )


def _labels(selected: DataFrame) -> Column:
    """First word of the name, shown only when at most 10 points are drawn."""
    points = selected.agg(F.count(F.lit(1))).scalar()
    return F.when(points <= F.lit(LABEL_MAX_POINTS), first_word(F.col("airport_name")))


def revenue_scatter(selected: DataFrame, slots: DataFrame) -> DataFrame:
    """Bookings × revenue points; size = max(14, avg revenue per booking / 60)."""
    return _with_slot(selected, slots).select(
        "airport_name",
        "slot",
        "total_bookings",
        "total_revenue",
        "avg_revenue_per_booking",
        F.greatest(F.lit(14.0), F.col("avg_revenue_per_booking") / F.lit(60.0)).alias("size"),
        _labels(selected).alias("label"),
    )


def performance_scatter(selected: DataFrame, slots: DataFrame) -> DataFrame:
    """Flights × revenue points; size = max(12, passengers × 1.8)."""
    return _with_slot(selected, slots).select(
        "airport_name",
        "slot",
        "total_flights",
        "total_revenue",
        "unique_passengers",
        "revenue_per_pax",
        F.greatest(F.lit(12.0), F.col("unique_passengers").cast("double") * F.lit(1.8)).alias("size"),
        _labels(selected).alias("label"),
    )


def _shares(selected: DataFrame, columns: Sequence[str]) -> dict[str, Column]:
    maxima = selected.agg(*[F.max(F.col(c).cast("double")).alias(c) for c in columns])
    return {c: capped_share(F.col(c), maxima.select(c).scalar()) for c in columns}


def _ranked(selected: DataFrame, numbered: DataFrame | None) -> DataFrame:
    """Rank 1 = highest revenue (nulls last), ties by name, city, country."""
    return in_series(numbered if numbered is not None else positions(selected, []), RANK).withColumnRenamed("position", "rank")


def revenue_table(selected: DataFrame, numbered: DataFrame | None = None) -> DataFrame:
    """Revenue detail rows with each measure's share of the column maximum."""
    ranked = _ranked(selected, numbered)
    share = _shares(ranked, ["total_bookings", "total_revenue", "avg_revenue_per_booking"])
    return ranked.select(
        "rank",
        "airport_name",
        "city",
        "country",
        "total_bookings",
        share["total_bookings"].alias("bookings_share"),
        "total_revenue",
        share["total_revenue"].alias("revenue_share"),
        "avg_revenue_per_booking",
        share["avg_revenue_per_booking"].alias("avg_share"),
    )


def performance_table(selected: DataFrame, numbered: DataFrame | None = None) -> DataFrame:
    """Performance detail rows; the maximum booking value has no share bar."""
    cols = ["total_flights", "unique_passengers", "pax_per_flight", "avg_booking_value", "revenue_per_pax"]
    ranked = _ranked(selected, numbered)
    share = _shares(ranked, cols)
    return ranked.select(
        "rank",
        "airport_name",
        "city",
        "total_flights",
        share["total_flights"].alias("flights_share"),
        "unique_passengers",
        share["unique_passengers"].alias("passengers_share"),
        "pax_per_flight",
        share["pax_per_flight"].alias("pax_per_flight_share"),
        "avg_booking_value",
        share["avg_booking_value"].alias("avg_share"),
        "max_booking_value",
        "revenue_per_pax",
        share["revenue_per_pax"].alias("revenue_per_pax_share"),
    )
