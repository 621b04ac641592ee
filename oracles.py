"""DuckDB oracle SQL for every registered query (independent of the Spark code).

Money is integer cents: sums are exact and an average is rounded half-up with
integer arithmetic, ``(2*sum + n) // (2*n)`` (non-negative sums; the fixtures
have positive amounts).  Counts are cast to BIGINT, weekday numbers to INTEGER,
money and ratios to DOUBLE so that column types match the Spark side.
"""

from __future__ import annotations

# The fixture mapping of FIXTURES.md §2, with the wide table on top.
BASE = """
WITH bookings AS (
  SELECT CAST(CASE WHEN (l_orderkey + l_linenumber) % 89 = 0 THEN NULL
                   ELSE l_orderkey * 10 + l_linenumber END AS BIGINT) AS booking_id,
         CAST(CASE WHEN l_partkey % 97 = 0 THEN NULL WHEN o_custkey % 10 = 7 THEN o_custkey + 1000000000
                   ELSE o_custkey END AS BIGINT) AS passenger_id,
         CAST(l_partkey AS BIGINT) AS flight_id,
         CAST(CASE WHEN l_partkey % 101 = 0 THEN NULL WHEN l_suppkey % 10 = 3 THEN l_suppkey + 1000000000
                   ELSE l_suppkey END AS BIGINT) AS airport_id,
         CAST(CAST(l_extendedprice AS DECIMAL(12,2)) AS DECIMAL(18,6)) AS amount,
         CAST(CAST(l_extendedprice AS DECIMAL(12,2)) * (1 - CAST(l_discount AS DECIMAL(4,2))) * 10000 AS BIGINT) AS net_units,
         substr(CAST(CAST(o_orderdate AS DATE) AS VARCHAR), 1, 10) AS booking_date
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey
),
passengers AS (
  SELECT CAST(c_custkey AS BIGINT) AS passenger_id, c_name AS name, c_mktsegment AS gender, n_name AS nationality
  FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey
),
airports AS (
  SELECT CAST(s_suppkey AS BIGINT) AS airport_id, concat(n_name, ' ', s_name) AS airport_name,
         n_name AS city, r_name AS country
  FROM supplier LEFT JOIN nation ON s_nationkey = n_nationkey
                LEFT JOIN region ON n_regionkey = r_regionkey
),
obt AS (
  SELECT b.airport_id, b.passenger_id, b.booking_id, b.flight_id, b.amount, b.booking_date,
         p.name, p.gender, p.nationality, a.airport_name, a.city, a.country,
         CAST(b.amount * 100 AS BIGINT) AS cents, b.net_units
  FROM bookings b
  LEFT JOIN passengers p ON b.passenger_id = p.passenger_id
  LEFT JOIN airports a ON b.airport_id = a.airport_id
)
"""


def cnt(col: str) -> str:
    return f"CAST(COUNT({col}) AS BIGINT)"


def dst(col: str) -> str:
    return f"CAST(COUNT(DISTINCT {col}) AS BIGINT)"


def money_sum(cents: str = "cents") -> str:
    return f"CAST(SUM({cents}) AS DOUBLE) / 100.0"


def money_avg(cents: str = "cents") -> str:
    return f"CAST((2 * SUM({cents}) + COUNT({cents})) // (2 * COUNT({cents})) AS DOUBLE) / 100.0"


def money_max(cents: str = "cents") -> str:
    return f"CAST(MAX({cents}) AS DOUBLE) / 100.0"


def money_min(cents: str = "cents") -> str:
    return f"CAST(MIN({cents}) AS DOUBLE) / 100.0"


AIRPORT = "airport_id, airport_name, city, country"

MARTS = {
    "gold_airport_revenue_summary": f"""
SELECT {AIRPORT}, {cnt('booking_id')} AS total_bookings, {money_sum()} AS total_revenue,
       {money_avg()} AS avg_revenue_per_booking
FROM obt GROUP BY {AIRPORT}""",
    "gold_top_airports": f"""
SELECT {AIRPORT}, {cnt('booking_id')} AS total_bookings, {dst('passenger_id')} AS unique_passengers,
       {money_sum()} AS total_revenue
FROM obt GROUP BY {AIRPORT}""",
    "gold_monthly_booking_trends": f"""
SELECT strftime(CAST(booking_date AS DATE), '%Y-%m') AS year_month, {cnt('booking_id')} AS total_bookings,
       {dst('passenger_id')} AS unique_passengers, {money_sum()} AS total_revenue,
       {money_avg()} AS avg_revenue_per_booking
FROM obt GROUP BY 1""",
    "gold_airport_performance": f"""
SELECT {AIRPORT}, {dst('flight_id')} AS total_flights, {dst('passenger_id')} AS unique_passengers,
       {cnt('booking_id')} AS total_bookings, {money_sum()} AS total_revenue, {money_avg()} AS avg_booking_value,
       {money_max()} AS max_booking_value, {money_min()} AS min_booking_value
FROM obt GROUP BY {AIRPORT}""",
    "gold_passenger_booking_summary": f"""
SELECT passenger_id, name AS passenger_name, gender, nationality, {cnt('booking_id')} AS total_bookings,
       {money_sum()} AS total_spend, {money_avg()} AS avg_spend_per_booking, {money_max()} AS max_single_booking,
       {dst('airport_id')} AS airports_visited, {dst('flight_id')} AS flights_taken
FROM obt GROUP BY passenger_id, name, gender, nationality""",
    "gold_gender_booking_summary": f"""
SELECT gender, {dst('passenger_id')} AS unique_passengers, {cnt('booking_id')} AS total_bookings,
       {money_sum()} AS total_revenue, {money_avg()} AS avg_spend_per_booking
FROM obt GROUP BY gender""",
    "gold_nationality_revenue": f"""
SELECT nationality, {dst('passenger_id')} AS unique_passengers, {cnt('booking_id')} AS total_bookings,
       {money_sum()} AS total_revenue, {money_avg()} AS avg_spend_per_passenger
FROM obt GROUP BY nationality""",
    "gold_peak_travel_days": f"""
SELECT CAST(booking_date AS DATE) AS travel_date,
       CAST(dayofweek(CAST(booking_date AS DATE)) + 1 AS INTEGER) AS day_of_week_num,
       strftime(CAST(booking_date AS DATE), '%A') AS day_of_week_name,
       {cnt('booking_id')} AS total_bookings, {dst('passenger_id')} AS unique_passengers,
       {money_sum()} AS total_revenue
FROM obt GROUP BY 1, 2, 3""",
}


PREVIEWS = {
    "preview_top_airports": f"""
SELECT airport_name, city, country, total_bookings, total_revenue FROM ({MARTS['gold_top_airports']}) m
ORDER BY total_bookings DESC, airport_id ASC NULLS FIRST, airport_name ASC NULLS FIRST, city ASC NULLS FIRST,
         country ASC NULLS FIRST LIMIT 5""",
    "preview_monthly_trends": f"""
SELECT year_month, total_bookings, total_revenue FROM ({MARTS['gold_monthly_booking_trends']}) m
ORDER BY year_month ASC NULLS FIRST LIMIT 5""",
    "preview_airport_revenue": f"""
SELECT airport_name, city, total_bookings, total_revenue FROM ({MARTS['gold_airport_revenue_summary']}) m
ORDER BY total_revenue DESC, airport_id ASC NULLS FIRST, airport_name ASC NULLS FIRST, city ASC NULLS FIRST,
         country ASC NULLS FIRST LIMIT 5""",
    "preview_top_passengers": f"""
SELECT passenger_name, nationality, total_bookings, total_spend FROM ({MARTS['gold_passenger_booking_summary']}) m
ORDER BY total_spend DESC, passenger_id ASC NULLS FIRST, passenger_name ASC NULLS FIRST, gender ASC NULLS FIRST,
         nationality ASC NULLS FIRST LIMIT 5""",
}

# AG8 with spoiled dates: a trailing time (booking_id % 13 = 0) or month 13
# (booking_id % 17 = 0); both become one null date group.
BAD_DATES = """
, spoiled AS (
  SELECT *, CASE WHEN booking_id % 13 = 0 THEN concat(booking_date, ' 10:00:00')
                 WHEN booking_id % 17 = 0 THEN concat(substr(booking_date, 1, 5), '13', substr(booking_date, 8, 3))
                 ELSE booking_date END AS bad_date
  FROM obt
), parsed AS (
  SELECT *, CAST(try_strptime(bad_date, '%Y-%m-%d') AS DATE) AS d FROM spoiled
)
SELECT d AS travel_date, CAST(dayofweek(d) + 1 AS INTEGER) AS day_of_week_num,
       strftime(d, '%A') AS day_of_week_name, CAST(COUNT(booking_id) AS BIGINT) AS total_bookings,
       CAST(COUNT(DISTINCT passenger_id) AS BIGINT) AS unique_passengers,
       CAST(SUM(cents) AS DOUBLE) / 100.0 AS total_revenue
FROM parsed GROUP BY 1, 2, 3"""

# Dashboard views: the two airport marts with their cents kept for exact sums.
VIEWS = f"""
, rev AS (
  SELECT airport_name, city, country, {cnt('booking_id')} AS total_bookings,
         SUM(cents) AS rev_cents, (2 * SUM(cents) + COUNT(cents)) // (2 * COUNT(cents)) AS avg_cents
  FROM obt GROUP BY {AIRPORT}
), revv AS (
  SELECT airport_name, city, country, total_bookings, CAST(rev_cents AS DOUBLE) / 100.0 AS total_revenue,
         CAST(avg_cents AS DOUBLE) / 100.0 AS avg_revenue_per_booking, rev_cents, avg_cents
  FROM rev
), perf AS (
  SELECT airport_name, city, country, {dst('flight_id')} AS total_flights, {dst('passenger_id')} AS unique_passengers,
         {cnt('booking_id')} AS total_bookings, SUM(cents) AS rev_cents, {money_avg()} AS avg_booking_value,
         {money_max()} AS max_booking_value, {money_min()} AS min_booking_value
  FROM obt GROUP BY {AIRPORT}
), perfv AS (
  SELECT airport_name, city, country, total_flights, unique_passengers, total_bookings,
         CAST(rev_cents AS DOUBLE) / 100.0 AS total_revenue, avg_booking_value, max_booking_value,
         min_booking_value,
         CAST(unique_passengers AS DOUBLE) / NULLIF(CAST(total_flights AS DOUBLE), 0) AS pax_per_flight,
         (CAST(rev_cents AS DOUBLE) / 100.0) / NULLIF(CAST(unique_passengers AS DOUBLE), 0) AS revenue_per_pax,
         rev_cents
  FROM perf
), rev_def AS (
  SELECT airport_name FROM (SELECT DISTINCT airport_name FROM revv WHERE airport_name IS NOT NULL)
  ORDER BY airport_name LIMIT 5
), perf_def AS (
  SELECT airport_name FROM (SELECT DISTINCT airport_name FROM perfv WHERE airport_name IS NOT NULL)
  ORDER BY airport_name LIMIT 5
), rev_sel AS (
  SELECT * FROM revv WHERE airport_name IN (SELECT airport_name FROM rev_def)
), perf_sel AS (
  SELECT * FROM perfv WHERE airport_name IN (SELECT airport_name FROM perf_def)
), rev_all AS (
  SELECT * FROM revv WHERE airport_name IS NOT NULL
), perf_all AS (
  SELECT * FROM perfv WHERE airport_name IS NOT NULL
), slots AS (
  SELECT airport_name, CAST((row_number() OVER (ORDER BY airport_name) - 1) % 10 AS INTEGER) AS slot
  FROM (SELECT airport_name FROM revv WHERE airport_name IS NOT NULL
        UNION SELECT airport_name FROM perfv WHERE airport_name IS NOT NULL)
)
"""

REV_COLS = "airport_name, city, country, total_bookings, total_revenue, avg_revenue_per_booking"
PERF_COLS = (
    "airport_name, city, country, total_flights, unique_passengers, total_bookings, total_revenue, "
    "avg_booking_value, max_booking_value, min_booking_value, pax_per_flight, revenue_per_pax"
)
TIE = "airport_name ASC NULLS FIRST, city ASC NULLS FIRST, country ASC NULLS FIRST"


def share(col: str, frame: str) -> str:
    pct = f"CAST({col} AS DOUBLE) / COALESCE(NULLIF((SELECT MAX(CAST({col} AS DOUBLE)) FROM {frame}), 0), 1.0) * 100.0"
    return f"CASE WHEN {pct} > 100.0 THEN 100.0 ELSE {pct} END"


def bar(frame: str, col: str) -> str:
    return f"""
SELECT CAST(row_number() OVER (ORDER BY CAST(f.{col} AS DOUBLE) ASC NULLS LAST, f.airport_name ASC NULLS FIRST,
                                    f.city ASC NULLS FIRST, f.country ASC NULLS FIRST) AS INTEGER) AS position,
       f.airport_name, CAST(f.{col} AS DOUBLE) AS value,
       (SELECT MAX(CAST({col} AS DOUBLE)) FROM {frame}) * 1.2 AS axis_max, COALESCE(s.slot, 0) AS slot
FROM {frame} f LEFT JOIN slots s ON f.airport_name = s.airport_name"""


def label(frame: str) -> str:
    return (
        f"CASE WHEN (SELECT COUNT(*) FROM {frame}) <= 10 "
        f"THEN NULLIF(regexp_extract(f.airport_name, '^\\s*(\\S+)', 1), '') END"
    )


DASHBOARD = {
    "view_airport_revenue": f"SELECT {REV_COLS} FROM revv",
    "view_airport_performance": f"SELECT {PERF_COLS} FROM perfv",
    "airport_options": "SELECT DISTINCT airport_name FROM revv WHERE airport_name IS NOT NULL",
    "default_airports": "SELECT CAST(row_number() OVER (ORDER BY airport_name) AS INTEGER) AS position, airport_name FROM rev_def",
    "selected_airport_revenue": f"SELECT {REV_COLS} FROM rev_sel",
    "selected_airport_performance": f"SELECT {PERF_COLS} FROM perf_sel",
    "kpis_empty_selection": """
SELECT CAST(0 AS BIGINT) AS airports, CAST(COUNT(DISTINCT airport_name) AS BIGINT) AS airports_total,
       CAST(NULL AS BIGINT) AS total_bookings, CAST(NULL AS DOUBLE) AS total_revenue,
       CAST(NULL AS DOUBLE) AS avg_revenue_per_booking
FROM revv""",
    "airport_slots": "SELECT airport_name, slot FROM slots",
    "revenue_kpis": """
SELECT CAST(COUNT(*) AS BIGINT) AS airports,
       (SELECT CAST(COUNT(DISTINCT airport_name) AS BIGINT) FROM revv) AS airports_total,
       CAST(SUM(total_bookings) AS BIGINT) AS total_bookings,
       CAST(SUM(rev_cents) AS DOUBLE) / 100.0 AS total_revenue,
       (CAST(SUM(avg_cents) AS DOUBLE) / 100.0) / CAST(COUNT(avg_cents) AS DOUBLE) AS avg_revenue_per_booking
FROM rev_sel""",
    "performance_kpis": """
SELECT CAST(COUNT(*) AS BIGINT) AS airports,
       (SELECT CAST(COUNT(DISTINCT airport_name) AS BIGINT) FROM perfv) AS airports_total,
       CAST(SUM(total_flights) AS BIGINT) AS total_flights,
       CAST(SUM(unique_passengers) AS BIGINT) AS unique_passengers,
       (CAST(SUM(rev_cents) AS DOUBLE) / 100.0) / NULLIF(CAST(SUM(unique_passengers) AS DOUBLE), 0) AS revenue_per_passenger,
       (CAST(SUM(rev_cents) AS DOUBLE) / 100.0) / NULLIF(CAST(SUM(total_bookings) AS DOUBLE), 0) AS avg_booking_value
FROM perf_sel""",
    "revenue_table": f"""
SELECT CAST(row_number() OVER (ORDER BY total_revenue DESC NULLS LAST, {TIE}) AS INTEGER) AS rank,
       airport_name, city, country,
       total_bookings, {share('total_bookings', 'rev_all')} AS bookings_share,
       total_revenue, {share('total_revenue', 'rev_all')} AS revenue_share,
       avg_revenue_per_booking, {share('avg_revenue_per_booking', 'rev_all')} AS avg_share
FROM rev_all""",
    "performance_table": f"""
SELECT CAST(row_number() OVER (ORDER BY total_revenue DESC NULLS LAST, {TIE}) AS INTEGER) AS rank,
       airport_name, city,
       total_flights, {share('total_flights', 'perf_all')} AS flights_share,
       unique_passengers, {share('unique_passengers', 'perf_all')} AS passengers_share,
       pax_per_flight, {share('pax_per_flight', 'perf_all')} AS pax_per_flight_share,
       avg_booking_value, {share('avg_booking_value', 'perf_all')} AS avg_share,
       max_booking_value,
       revenue_per_pax, {share('revenue_per_pax', 'perf_all')} AS revenue_per_pax_share
FROM perf_all""",
    "chart_bookings": bar("rev_all", "total_bookings"),
    "chart_revenue": bar("rev_all", "total_revenue"),
    "chart_avg_revenue": bar("rev_all", "avg_revenue_per_booking"),
    "chart_revenue_per_pax": bar("perf_all", "revenue_per_pax"),
    "chart_pax_per_flight": bar("perf_all", "pax_per_flight"),
    "chart_booking_range": f"""
SELECT position, airport_name, stat, value FROM (
  SELECT CAST(row_number() OVER (ORDER BY avg_booking_value ASC NULLS LAST, {TIE}) AS INTEGER) AS position,
         airport_name, min_booking_value, avg_booking_value, max_booking_value
  FROM perf_all) p,
  LATERAL (VALUES ('min', min_booking_value), ('avg', avg_booking_value), ('max', max_booking_value)) AS v(stat, value)""",
    "chart_revenue_scatter": f"""
SELECT f.airport_name, COALESCE(s.slot, 0) AS slot, f.total_bookings, f.total_revenue, f.avg_revenue_per_booking,
       GREATEST(14.0, f.avg_revenue_per_booking / 60.0) AS size, {label('rev_sel')} AS label
FROM rev_sel f LEFT JOIN slots s ON f.airport_name = s.airport_name""",
    "chart_performance_scatter": f"""
SELECT f.airport_name, COALESCE(s.slot, 0) AS slot, f.total_flights, f.total_revenue, f.unique_passengers,
       f.revenue_per_pax, GREATEST(12.0, CAST(f.unique_passengers AS DOUBLE) * 1.8) AS size,
       {label('perf_all')} AS label
FROM perf_all f LEFT JOIN slots s ON f.airport_name = s.airport_name""",
}


LAYERS = {
    "bronze_bookings": "SELECT * EXCLUDE (net_units) FROM bookings",
    "bronze_passengers": "SELECT * FROM passengers",
    "bronze_airports": "SELECT * FROM airports",
    "bronze_normalized_names": "SELECT * FROM airports",
    "bronze_null_tokens": "SELECT * EXCLUDE (net_units) FROM bookings",
    "bronze_inferred_types": "SELECT * EXCLUDE (net_units) REPLACE (CAST(amount AS DOUBLE) AS amount) FROM bookings",
    "bronze_line_breaks": """
SELECT passenger_id, concat(name, chr(10), 'of "', nationality, '", ', gender) AS name, gender, nationality
FROM passengers""",
    "bronze_line_breaks_ranges": """
SELECT passenger_id, concat(name, chr(10), 'of "', nationality, '", ', gender) AS name, gender, nationality
FROM passengers""",
    "bronze_exact_types": """
SELECT booking_id, concat(flight_id % 40 + 1, ['D', 'F', 'd', 'f'][flight_id % 4 + 1]) AS seat,
       concat('0x1p', flight_id % 9) AS tag, lpad(CAST(flight_id AS VARCHAR), 9, '0') AS ticket,
       CAST(amount AS DOUBLE) AS price, CAST(booking_date AS DATE) AS day, flight_id % 2 = 0 AS paid,
       'bigint' AS booking_id_type, 'string' AS seat_type, 'string' AS tag_type, 'string' AS ticket_type,
       concat('decimal(', length(CAST(MAX(CAST(whole AS BIGINT)) OVER () AS VARCHAR)) + 2, ',2)') AS price_type,
       'date' AS day_type, 'boolean' AS paid_type
FROM (SELECT *, floor(amount) AS whole FROM bookings)""",
    "gold_airport_revenue_string_ids": f"""
SELECT 'A' || airport_id AS airport_id, airport_name, city, country, {cnt('booking_id')} AS total_bookings,
       {money_sum()} AS total_revenue, {money_avg()} AS avg_revenue_per_booking
FROM obt GROUP BY airport_id, airport_name, city, country""",
    "gold_subcent_revenue": f"""
SELECT {AIRPORT}, {cnt('booking_id')} AS total_bookings,
       CAST((2 * SUM(net_units) + 100) // 200 AS DOUBLE) / 100.0 AS total_revenue,
       CAST((2 * SUM(net_units) + 100 * COUNT(net_units)) // (200 * COUNT(net_units)) AS DOUBLE) / 100.0
         AS avg_revenue_per_booking
FROM obt GROUP BY {AIRPORT}""",
    "bronze_row_counts": """
SELECT 'airports' AS table_name, CAST(COUNT(*) AS BIGINT) AS rows_written, CAST(COUNT(*) AS BIGINT) AS row_count FROM airports
UNION ALL SELECT 'bookings', CAST(COUNT(*) AS BIGINT), CAST(COUNT(*) AS BIGINT) FROM bookings
UNION ALL SELECT 'passengers', CAST(COUNT(*) AS BIGINT), CAST(COUNT(*) AS BIGINT) FROM passengers""",
    "silver_bookings_obt": """
SELECT airport_id, passenger_id, booking_id, flight_id, amount, booking_date, name, gender, nationality,
       airport_name, city, country FROM obt""",
    "unmatched_bookings": """
SELECT 'passengers' AS dimension, COUNT(*) FILTER (passenger_id IS NULL) AS null_key_rows,
       COUNT(*) FILTER (passenger_id IS NOT NULL AND passenger_id NOT IN (SELECT passenger_id FROM passengers)) AS dangling_key_rows
FROM obt
UNION ALL
SELECT 'airports', COUNT(*) FILTER (airport_id IS NULL),
       COUNT(*) FILTER (airport_id IS NOT NULL AND airport_id NOT IN (SELECT airport_id FROM airports))
FROM obt""",
    "silver_row_counts": """
SELECT 'bookings_obt' AS table_name, CAST(COUNT(*) AS BIGINT) AS rows_written, CAST(COUNT(*) AS BIGINT) AS row_count FROM obt""",
}

# The comment of each gold table, written out.
COMMENTS = {
    "gold_airport_revenue_summary": "Total bookings and revenue by airport. Identifies highest-revenue airports for business planning.",
    "gold_top_airports": "Airports ranked by booking frequency. Highlights most popular travel destinations.",
    "gold_monthly_booking_trends": "Month-over-month booking volume and revenue. Used for growth tracking and seasonality analysis.",
    "gold_airport_performance": "Comprehensive airport metrics: flights, passengers, bookings, and revenue range. Supports operational planning.",
    "gold_passenger_booking_summary": "Passenger-level lifetime booking behaviour: spend, frequency, airports visited. Supports CRM and loyalty programs.",
    "gold_gender_booking_summary": "Booking and revenue distribution by passenger gender. Supports demographic analysis and targeted marketing.",
    "gold_nationality_revenue": "Revenue and booking volume by passenger nationality. Identifies key traveller markets for route planning.",
    "gold_peak_travel_days": "Daily booking volumes and revenue to identify peak travel days. Supports capacity planning and dynamic pricing.",
}


def build_summary_sql() -> str:
    parts = []
    for name, body in MARTS.items():
        comment = COMMENTS[name].replace("'", "''")
        parts.append(
            f"SELECT '{name}' AS table_name, CAST(COUNT(*) AS BIGINT) AS rows_written, "
            f"CAST(COUNT(*) AS BIGINT) AS row_count, '{comment}' AS comment "
            f"FROM ({body}) m"
        )
    return "\nUNION ALL\n".join(parts)


def oracle_sql() -> dict[str, str]:
    out: dict[str, str] = {}
    for name, body in MARTS.items():
        out[name] = BASE + body
    for name, body in PREVIEWS.items():
        out[name] = BASE + body
    out["bad_dates_as_null"] = BASE + BAD_DATES
    for name, body in DASHBOARD.items():
        out[name] = BASE + VIEWS + body
    for name, body in LAYERS.items():
        out[name] = BASE + body
    out["gold_build_summary"] = BASE + build_summary_sql()
    # the same data through the written gold tables
    for tab in ("revenue", "performance"):
        out[f"dashboard_{tab}_kpis"] = out[f"{tab}_kpis"]
        out[f"dashboard_{tab}_table"] = out[f"{tab}_table"]
    return out
