"""Dashboard views and series: ratios, shares, labels, slots, selection, positions."""

from __future__ import annotations

import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from tarmac.functions.ordinal import with_position
from tarmac.functions.text import first_word
from tarmac.operators import series, views

PERF = (
    "airport_name string, city string, country string, total_flights long, unique_passengers long, "
    "total_bookings long, total_revenue double, avg_booking_value double, max_booking_value double, "
    "min_booking_value double"
)
REV = "airport_name string, city string, country string, total_bookings long, total_revenue double, avg_revenue_per_booking double"


def test_zero_divisor_gives_null(spark):
    df = spark.createDataFrame([("A", "c", "k", 3, 0, 5, 50.0, 10.0, 20.0, 5.0)], PERF)
    row = views.performance_view(df).collect()[0]
    assert row.revenue_per_pax is None and row.pax_per_flight == 0.0


def test_share_when_max_is_zero(spark):
    df = spark.createDataFrame([("A", "c", "k", 0, 0.0, 0.0), ("B", "c", "k", 0, 0.0, 0.0)], REV)
    rows = series.revenue_table(df).collect()
    assert all(r.bookings_share == 0.0 and r.revenue_share == 0.0 for r in rows)


def test_share_is_capped_and_relative(spark):
    df = spark.createDataFrame([("A", "c", "k", 5, 50.0, 10.0), ("B", "c", "k", 10, 100.0, 10.0)], REV)
    rows = {r.airport_name: r for r in series.revenue_table(df).collect()}
    assert rows["A"].revenue_share == 50.0 and rows["B"].revenue_share == 100.0
    assert (rows["B"].rank, rows["A"].rank) == (1, 2)


@pytest.mark.parametrize("name,word", [("Dubai", "Dubai"), ("  Dubai  Intl", "Dubai"), ("", None), (None, None)])
def test_first_word(spark, name, word):
    df = spark.createDataFrame([(name,)], "n string")
    assert df.select(first_word(F.col("n")).alias("w")).collect()[0].w == word


def test_same_name_two_ids(spark):
    df = spark.createDataFrame([("X", "c1", "k", 1, 1.0, 1.0), ("X", "c2", "k", 2, 2.0, 1.0), ("Y", "c", "k", 3, 3.0, 1.0)], REV)
    assert views.filter_airports(df, ["X"]).count() == 2
    kpi = views.revenue_kpis(df, ["X"]).collect()[0]
    assert (kpi.airports, kpi.airports_total, kpi.total_bookings) == (2, 2, 3)
    one = views.revenue_kpis(df.where("airport_name = 'X'"), ["X"]).collect()[0]
    assert one.airports_total == 1


def test_empty_selection(spark):
    df = spark.createDataFrame([("X", "c", "k", 1, 1.0, 1.0)], REV)
    empty = views.filter_airports(df, [])
    assert empty.count() == 0 and empty.schema == df.schema


def test_labels_only_up_to_ten_points(spark):
    rows = [(f"Airport{i} Intl", "c", "k", i, float(i), 1.0) for i in range(11)]
    df = spark.createDataFrame(rows, REV)
    slots = series.category_slots(df)
    assert all(r.label is None for r in series.revenue_scatter(df, slots).collect())
    ten = views.filter_airports(df, [r[0] for r in rows[:10]])
    labels = {r.label for r in series.revenue_scatter(ten, slots).collect()}
    assert labels == {f"Airport{i}" for i in range(10)}


def test_slots_wrap_after_ten_names(spark):
    names = [f"N{i:02d}" for i in range(11)]
    df = spark.createDataFrame([(n, "c", "k", 1, 1.0, 1.0) for n in names], REV)
    slots = {r.airport_name: r.slot for r in series.category_slots(df, df).collect()}
    assert slots["N10"] == 0 and slots["N09"] == 9 and len(slots) == 11


def test_default_selection_is_first_five_names(spark):
    df = spark.createDataFrame([(n, "c", "k", 1, 1.0, 1.0) for n in "edcbaf"] + [(None, "c", "k", 1, 1.0, 1.0)], REV)
    got = [(r.position, r.airport_name) for r in views.default_selection(df).orderBy("position").collect()]
    assert got == list(enumerate("abcde", start=1))


def test_with_position_matches_row_number(spark):
    rnd = random.Random(7)
    data = [(rnd.randint(0, 20), rnd.choice("abc"), i) for i in range(500)]
    df = spark.createDataFrame(data, "v int, s string, i int")
    order = [F.col("v").desc(), F.col("s").asc(), F.col("i").asc()]
    want = {r.i: r.p for r in df.select("i", F.row_number().over(Window.orderBy(*order)).alias("p")).collect()}
    numbered = with_position(df, order, partitions=7)
    assert "__pos_part" in numbered._jdf.queryExecution().optimizedPlan().toString()
    assert {r.i: r.position for r in numbered.collect()} == want
    assert {r.i: r.position + 1 for r in with_position(df, order, start=0).collect()} == want


def test_booking_range_is_long_format(spark):
    df = spark.createDataFrame(
        [("A", "c", "k", 1, 1, 1, 1.0, 5.0, 9.0, 1.0), ("B", "c", "k", 1, 1, 1, 1.0, 3.0, 4.0, 2.0)], PERF
    )
    rows = series.booking_range(views.performance_view(df)).collect()
    assert {(r.position, r.airport_name, r.stat, r.value) for r in rows} == {
        (1, "B", "min", 2.0), (1, "B", "avg", 3.0), (1, "B", "max", 4.0),
        (2, "A", "min", 1.0), (2, "A", "avg", 5.0), (2, "A", "max", 9.0),
    }


@settings(max_examples=8, deadline=None)
@given(
    st.lists(st.tuples(st.one_of(st.none(), st.integers(-3, 3)), st.sampled_from("ab")), min_size=0, max_size=60),
    st.integers(1, 5),
)
def test_positions_equal_row_number(spark, values, partitions):
    df = spark.createDataFrame([(v, s, i) for i, (v, s) in enumerate(values)], "v int, s string, i int")
    order = [F.col("v").asc_nulls_last(), F.col("s").desc(), F.col("i").asc()]
    want = {r.i: r.p for r in df.select("i", F.row_number().over(Window.orderBy(*order)).alias("p")).collect()}
    assert {r.i: r.position for r in with_position(df, order, partitions=partitions).collect()} == want


def test_all_orders_of_a_frame_are_numbered_in_one_pass(spark):
    from tarmac.functions.ordinal import Order, in_series, with_positions

    rnd = random.Random(9)
    data = [(rnd.choice([None, 0.0, -0.0, 1.5, 2.5]), rnd.choice([None, 1, 2, 2**40]), rnd.choice("abc"), i) for i in range(400)]
    df = spark.createDataFrame(data, "v double, w long, s string, i int")
    ties = [F.col("s").asc_nulls_first(), F.col("i").asc()]
    got = with_positions(df, {"up": Order(F.col("v")), "down": Order(F.col("w"), descending=True)}, ties).cache()
    assert got.count() == 800
    for name, first in (("up", F.col("v").asc_nulls_last()), ("down", F.col("w").desc_nulls_last())):
        want = {r.i: r.p for r in df.select("i", F.row_number().over(Window.orderBy(first, *ties)).alias("p")).collect()}
        assert {r.i: r.position for r in in_series(got, name).collect()} == want
    assert in_series(with_positions(df.limit(0), {"up": Order(F.col("v"))}, ties), "up").collect() == []


def test_a_tab_is_numbered_once_and_leaves_nothing(spark, cfg, monkeypatch):
    import os

    from tarmac import registry
    from tarmac.functions import ordinal
    from tarmac.plans import build_gold
    from tarmac.plans.dashboard import Dashboard
    from tarmac.plans.silver import write_obt

    src = registry.fixtures.sources(spark, "/root/testdata/sf0.001")
    write_obt(src["bookings"], src["passengers"], src["airports"], cfg)
    build_gold(spark, cfg)
    passes = []
    real = ordinal._numbered
    monkeypatch.setattr(ordinal, "_numbered", lambda *a: passes.append(1) or real(*a))
    board = Dashboard(spark, cfg)
    assert len(passes) == 1  # the slots
    for tab in (board.revenue_tab, board.performance_tab, board.revenue_tab):
        before = len(passes)
        frames = tab(None)
        assert all(df.count() > 0 for df in frames.values())
        assert len(passes) == before + 1
    folders = [s.folder.removeprefix("file://") for s in (board.staging, *board.tabs.values())]
    assert all(os.path.isdir(f) for f in folders) and len(folders) == 3
    board.close()
    assert not any(os.path.exists(f) for f in folders)
