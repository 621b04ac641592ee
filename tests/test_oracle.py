"""Every registered query against its DuckDB oracle (the driver's gate), on sf0.001."""

from __future__ import annotations

import math
import os

import duckdb
import pytest

from conftest import SF_SMALL

import __spark_entry__ as E
import oracles
from tarmac import registry

TABLES = "region nation customer supplier part orders lineitem".split()


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(v)
    if hasattr(v, "isoformat"):
        return v.isoformat()
    return v if v is None else str(v)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


def test_every_query_has_an_oracle():
    assert set(registry.QUERIES) == set(oracles.oracle_sql())
    assert set(registry.QUERIES) <= set(E.queries()) and set(E.oracle_sql()) <= set(E.queries())


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == [
        "airport_id",
        "airport_name",
        "city",
        "country",
        "total_bookings",
        "total_revenue",
        "avg_revenue_per_booking",
    ]
    assert df.count() > 0


@pytest.mark.parametrize("name", sorted(registry.QUERIES))
def test_query_matches_oracle(spark, duck, name):
    df = registry.QUERIES[name](spark, SF_SMALL)
    cols = sorted(df.columns)
    got = sorted((tuple(_norm(r[c]) for c in cols) for r in df.collect()), key=repr)
    cur = duck.execute(oracles.oracle_sql()[name])
    ocols = [d[0] for d in cur.description]
    assert sorted(ocols) == cols
    idx = {c: i for i, c in enumerate(ocols)}
    want = sorted((tuple(_norm(r[idx[c]]) for c in cols) for r in cur.fetchall()), key=repr)
    assert got == want


ONE_PASS = """airport_slots chart_avg_revenue chart_booking_range chart_bookings chart_pax_per_flight
chart_performance_scatter chart_revenue chart_revenue_per_pax chart_revenue_scatter performance_kpis performance_table
revenue_kpis revenue_table selected_airport_performance selected_airport_revenue""".split()


@pytest.mark.parametrize("name", ["chart_pax_per_flight", "performance_kpis", "revenue_table"])
def test_dashboard_queries_do_not_read_bookings_again(spark, name):
    """What a query returns reads the staged airport states only: the bookings were read once, to stage them."""
    assert name in ONE_PASS
    files = registry.QUERIES[name](spark, SF_SMALL).inputFiles()
    assert not any("lineitem" in f or "orders" in f for f in files)
