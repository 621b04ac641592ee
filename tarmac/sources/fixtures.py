"""Bookings, passengers and airports derived from the driver's TPC-H-like tables.

The mapping (FIXTURES.md §2) makes some booking keys null and shifts others out
of the dimensions' range on purpose, so that null groups and unmatched bookings
are exercised.  It reads whole tables and keeps every row of each.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pyspark.sql.types import TimestampNTZType

from tarmac.functions.money import MONEY


# Added to a booking key to make it match no dimension row.
NO_SUCH_KEY = 1_000_000_000


def _key(name: str, null_when, dangling_when):
    return (
        F.when(null_when, F.lit(None))
        .when(dangling_when, F.col(name) + F.lit(NO_SUCH_KEY))
        .otherwise(F.col(name))
        .cast("long")
    )


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def utc_date(df: DataFrame, column: str):
    """Calendar date of a parquet timestamp written without a zone.

    Read as ``timestamp_ntz`` (Spark's default inference) a plain cast is
    exact; read as a zoned timestamp (inference off) the value is an instant
    in UTC, so its UTC day is taken from the epoch seconds — neither depends on
    the session time zone."""
    c = F.col(column)
    if isinstance(df.schema[column].dataType, TimestampNTZType):
        return c.cast("date")
    return F.date_from_unix_date(F.floor(F.unix_seconds(c) / F.lit(86400)).cast("int"))


def price(li: DataFrame):
    return F.col("l_extendedprice").cast("decimal(12,2)")


def discounted(li: DataFrame):
    """Price after discount: four decimals."""
    return price(li) * (F.lit(1) - F.col("l_discount").cast("decimal(4,2)"))


def bookings(spark: SparkSession, sf_dir: str, amount=price) -> DataFrame:
    li = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_discount"
    )
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    j = li.join(orders, li.l_orderkey == orders.o_orderkey, "inner")
    return j.select(
        F.when((F.col("l_orderkey") + F.col("l_linenumber")) % 89 == 0, F.lit(None))
        .otherwise(F.col("l_orderkey") * 10 + F.col("l_linenumber"))
        .cast("long")
        .alias("booking_id"),
        _key("o_custkey", F.col("l_partkey") % 97 == 0, F.col("o_custkey") % 10 == 7).alias("passenger_id"),
        F.col("l_partkey").cast("long").alias("flight_id"),
        _key("l_suppkey", F.col("l_partkey") % 101 == 0, F.col("l_suppkey") % 10 == 3).alias("airport_id"),
        amount(li).cast(MONEY).alias("amount"),
        F.date_format(utc_date(j, "o_orderdate"), "yyyy-MM-dd").alias("booking_date"),
    )


def passengers(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer")
    n = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    return c.join(n, c.c_nationkey == n.n_nationkey, "left").select(
        F.col("c_custkey").cast("long").alias("passenger_id"),
        F.col("c_name").alias("name"),
        F.col("c_mktsegment").alias("gender"),
        F.col("n_name").alias("nationality"),
    )


def airports(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = table(spark, sf_dir, "supplier")
    n = table(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey")
    r = table(spark, sf_dir, "region").select("r_regionkey", "r_name")
    return (
        s.join(n, s.s_nationkey == n.n_nationkey, "left")
        .join(r, F.col("n_regionkey") == r.r_regionkey, "left")
        .select(
            F.col("s_suppkey").cast("long").alias("airport_id"),
            F.concat(F.col("n_name"), F.lit(" "), F.col("s_name")).alias("airport_name"),
            F.col("n_name").alias("city"),
            F.col("r_name").alias("country"),
        )
    )


def sources(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return {
        "bookings": bookings(spark, sf_dir),
        "passengers": passengers(spark, sf_dir),
        "airports": airports(spark, sf_dir),
    }


# Untidy headers and a mix of missing-value tokens for the CSV round trip;
# passengers are written with their columns in another order than the schema.
CSV_HEADERS = {
    "bookings": {
        "booking_id": " Booking ID ",
        "passenger_id": "Passenger Id",
        "flight_id": "FLIGHT_ID",
        "airport_id": "airport id",
        "amount": "Amount",
        "booking_date": "Booking Date ",
    },
    "passengers": {"name": "Name", "gender": " Gender", "nationality": "NATIONALITY", "passenger_id": "Passenger ID"},
    "airports": {"airport_id": "Airport ID", "airport_name": "Airport Name", "city": "City", "country": "Country"},
}
CSV_TOKENS = {"booking_id": "NA", "passenger_id": "null", "airport_id": "n/a", "nationality": "None"}


def untidy(df: DataFrame, name: str) -> DataFrame:
    """Text columns with untidy headers; nulls written as missing-value tokens."""
    headers = CSV_HEADERS[name]
    cols = []
    for c, header in headers.items():
        text = F.col(c).cast("string")
        if c in CSV_TOKENS:
            text = F.coalesce(text, F.lit(CSV_TOKENS[c]))
        cols.append(text.alias(header))
    return df.select(*cols)


# Column used to spread each exported dimension over several CSV files.  Bookings are written by the tasks that make
# them: a shuffle would only scatter the rows of an order, which later aggregations then find apart.
EXPORT_SPREAD = {"passengers": "passenger_id", "airports": "airport_id"}


def export_csv(spark: SparkSession, sf_dir: str, root: str, names=None) -> dict[str, str]:
    """Test-data setup: write the sources as CSV under ``root`` (untidy headers,
    missing-value tokens), several files per source as landed data would be,
    so that ingestion runs one task per file.  Returns ``{name: path}``."""
    from tarmac.sources.csv import write_csv

    src = sources(spark, sf_dir)
    files = int(spark.conf.get("spark.sql.shuffle.partitions"))
    paths = {}
    for name in names or src:
        path = f"{root.rstrip('/')}/{name}.csv"
        spread = src[name].repartition(files, EXPORT_SPREAD[name]) if name in EXPORT_SPREAD else src[name]
        write_csv(untidy(spread, name), path)
        paths[name] = path
    return paths
