"""Top-k previews of the gold marts (``ORDER BY … LIMIT 5``).

Each preview is a bounded top-k: Spark plans ``orderBy(...).limit(k)`` as
TakeOrderedAndProject, every task keeps its own k best rows and only those are
merged, so no task ever holds more than k rows per partition.  The order is
made total with the mart keys so the five rows are well defined under ties.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Preview:
    name: str
    mart: str
    columns: tuple[str, ...]
    # (column, descending?) in priority order, ending with the mart keys
    order: tuple[tuple[str, bool], ...]
    k: int = 5


_AIRPORT_TIE = (("airport_id", False), ("airport_name", False), ("city", False), ("country", False))

PREVIEWS = (
    Preview(
        "preview_top_airports",
        "gold_top_airports",
        ("airport_name", "city", "country", "total_bookings", "total_revenue"),
        (("total_bookings", True),) + _AIRPORT_TIE,
    ),
    Preview(
        "preview_monthly_trends",
        "gold_monthly_booking_trends",
        ("year_month", "total_bookings", "total_revenue"),
        (("year_month", False),),
    ),
    Preview(
        "preview_airport_revenue",
        "gold_airport_revenue_summary",
        ("airport_name", "city", "total_bookings", "total_revenue"),
        (("total_revenue", True),) + _AIRPORT_TIE,
    ),
    Preview(
        "preview_top_passengers",
        "gold_passenger_booking_summary",
        ("passenger_name", "nationality", "total_bookings", "total_spend"),
        (
            ("total_spend", True),
            ("passenger_id", False),
            ("passenger_name", False),
            ("gender", False),
            ("nationality", False),
        ),
    ),
)

PREVIEW_BY_NAME = {p.name: p for p in PREVIEWS}


def top_k(df: DataFrame, order: tuple[tuple[str, bool], ...], k: int) -> DataFrame:
    cols = [F.col(c).desc_nulls_last() if desc else F.col(c).asc_nulls_first() for c, desc in order]
    return df.orderBy(*cols).limit(k)


def preview(mart_df: DataFrame, spec: Preview) -> DataFrame:
    return top_k(mart_df, spec.order, spec.k).select(*spec.columns)
