"""The dashboard's data, read from the gold tables.

Like the original dashboard, both views are loaded once at start-up (here:
cached on the executors, one row per airport) together with the colour-slot
table; each tab then answers a selection of airport names with named
DataFrames (KPIs, chart series, detail table).  Nothing is collected here.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tarmac.config import PipelineConfig
from tarmac.functions.ordinal import in_series
from tarmac.operators import series, views
from tarmac.sources.staging import Staging
from tarmac.sources.tables import load_table

DEFAULT = "default"


def revenue_data(spark: SparkSession, cfg: PipelineConfig, ordered: bool = True) -> DataFrame:
    return views.revenue_view(load_table(spark, cfg, "gold", "gold_airport_revenue_summary"), ordered)


def performance_data(spark: SparkSession, cfg: PipelineConfig, ordered: bool = True) -> DataFrame:
    return views.performance_view(load_table(spark, cfg, "gold", "gold_airport_performance"), ordered)


class Dashboard:
    """Start-up state of the two tabs; call :meth:`close` to release it.

    A tab numbers the selected rows once, for all its charts and its table; the
    numbered rows are staged on shared storage until the tab's next selection."""

    def __init__(self, spark: SparkSession, cfg: PipelineConfig) -> None:
        self.spark = spark
        self.staging = Staging(spark)
        self.tabs: dict[str, Staging] = {}
        # every output orders itself, so the cached views skip the name sort
        self.revenue = revenue_data(spark, cfg, ordered=False).cache()
        self.performance = performance_data(spark, cfg, ordered=False).cache()
        self.slots = series.category_slots(self.revenue, self.performance, staging=self.staging).cache()

    def _select(self, tab: str, view: DataFrame, selection, bars) -> tuple[DataFrame, DataFrame, views.Selection]:
        """(selected rows, the same numbered by every order of the tab, selection).

        ``"default"`` = first five names (initial state), ``None`` = all
        names ("select all"), ``[]`` = cleared, or a list / DataFrame of names."""
        if isinstance(selection, str) and selection == DEFAULT:
            selection = views.default_selection(view)
        if tab in self.tabs:
            self.tabs[tab].close()
        self.tabs[tab] = Staging(self.spark)
        numbered = series.positions(views.filter_airports(view, selection), bars, self.tabs[tab])
        return in_series(numbered, series.RANK).drop("position"), numbered, selection

    def revenue_tab(self, selection=DEFAULT) -> dict[str, DataFrame]:
        bars = ["total_bookings", "total_revenue", "avg_revenue_per_booking"]
        sel, numbered, chosen = self._select("revenue", self.revenue, selection, bars)
        return {
            "kpis": views.revenue_kpis(self.revenue, chosen),
            "bookings": series.bar_series(sel, "total_bookings", self.slots, numbered),
            "revenue": series.bar_series(sel, "total_revenue", self.slots, numbered),
            "avg_revenue": series.bar_series(sel, "avg_revenue_per_booking", self.slots, numbered),
            "scatter": series.revenue_scatter(sel, self.slots),
            "table": series.revenue_table(sel, numbered),
        }

    def performance_tab(self, selection=DEFAULT) -> dict[str, DataFrame]:
        bars = ["revenue_per_pax", "pax_per_flight", series.RANGE]
        sel, numbered, chosen = self._select("performance", self.performance, selection, bars)
        return {
            "kpis": views.performance_kpis(self.performance, chosen),
            "revenue_per_pax": series.bar_series(sel, "revenue_per_pax", self.slots, numbered),
            "pax_per_flight": series.bar_series(sel, "pax_per_flight", self.slots, numbered),
            "booking_range": series.booking_range(sel, numbered),
            "scatter": series.performance_scatter(sel, self.slots),
            "table": series.performance_table(sel, numbered),
        }

    def close(self) -> None:
        for df in (self.revenue, self.performance, self.slots):
            df.unpersist()
        for staging in (self.staging, *self.tabs.values()):
            staging.close()
        self.tabs.clear()
