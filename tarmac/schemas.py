"""Typed schemas of the three sources and the wide table.

Columns are matched by name (never by position).  A source file may carry more
columns than listed here; they are kept as strings.  A caller may give another
schema (ids as text, say) or have the types inferred from the values.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql.types import LongType, StringType, StructField, StructType

from tarmac.functions.money import MONEY

BOOKINGS = StructType(
    [
        StructField("booking_id", LongType()),
        StructField("passenger_id", LongType()),
        StructField("flight_id", LongType()),
        StructField("airport_id", LongType()),
        StructField("amount", MONEY),
        # kept as text in bronze; parsed with an explicit policy in gold
        StructField("booking_date", StringType()),
    ]
)

PASSENGERS = StructType(
    [
        StructField("passenger_id", LongType()),
        StructField("name", StringType()),
        StructField("gender", StringType()),
        StructField("nationality", StringType()),
    ]
)

AIRPORTS = StructType(
    [
        StructField("airport_id", LongType()),
        StructField("airport_name", StringType()),
        StructField("city", StringType()),
        StructField("country", StringType()),
    ]
)


@dataclass(frozen=True)
class SourceSpec:
    """One raw dataset: table name, where its CSV files live, its typed schema.

    ``schema=None`` infers every column's type from its values, as ``infer``
    says: ``plain`` (bigint, double, text) or ``exact`` (also boolean, decimal
    and date; see :mod:`tarmac.sources.types`).  ``multi_line`` says whether a
    quoted field may hold line breaks.  Without it a record that breaks across
    lines raises, and files are read once."""

    name: str
    path: str
    schema: StructType | None
    multi_line: bool = True
    infer: str = "plain"


SCHEMAS = {"bookings": BOOKINGS, "passengers": PASSENGERS, "airports": AIRPORTS}

# The wide table: join keys first (each USING join moves its key to the front),
# then the remaining columns of bookings, passengers and airports.
OBT_COLUMNS = [
    "airport_id",
    "passenger_id",
    "booking_id",
    "flight_id",
    "amount",
    "booking_date",
    "name",
    "gender",
    "nationality",
    "airport_name",
    "city",
    "country",
]
