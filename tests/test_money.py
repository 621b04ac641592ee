"""Exact money: half-up averages against Python Decimal on random groups."""

from __future__ import annotations

from decimal import ROUND_HALF_UP, Decimal

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tarmac.functions.money import MONEY, half_up_avg

cents = st.integers(min_value=-10**9, max_value=10**11)
groups = st.lists(st.lists(cents, min_size=1, max_size=40), min_size=1, max_size=25)


def expected(values: list[int]) -> float:
    mean = Decimal(sum(values)) / Decimal(100) / Decimal(len(values))
    return float(mean.quantize(Decimal("0.01"), rounding=ROUND_HALF_UP))


@settings(max_examples=15, deadline=None)
@given(groups)
def test_half_up_average_is_exact(spark, data):
    rows = [(g, Decimal(v) / 100) for g, values in enumerate(data) for v in values]
    df = spark.createDataFrame(rows, "g int, amount decimal(18,6)")
    states = df.groupBy("g").agg(F.sum("amount").alias("s"), F.count("amount").alias("n"))
    got = {r.g: r.a for r in states.select("g", half_up_avg("s", "n").alias("a")).collect()}
    assert got == {g: expected(values) for g, values in enumerate(data)}


def test_ties_far_from_zero_and_large_groups(spark):
    # 2,000,001 bookings whose mean is 1.004999997…: exact rounding gives 1.00,
    # rounding to six places first would give 1.01
    df = spark.range(1).select(
        F.lit(Decimal("2010001.00")).cast("decimal(28,6)").alias("s"), F.lit(2_000_001).cast("long").alias("n")
    )
    assert df.select(half_up_avg("s", "n").alias("a")).first().a == 1.0
    ties = spark.createDataFrame([(Decimal("-10.05"), 2), (Decimal("10.05"), 2), (None, 0)], "s decimal(28,6), n long")
    assert [r.a for r in ties.select(half_up_avg("s", "n").alias("a")).collect()] == [-5.03, 5.03, None]
    assert MONEY.precision == 18 and MONEY.scale == 6


def test_sub_cent_sums_are_rounded_once(spark):
    from tarmac.functions.money import money_to_double

    df = spark.createDataFrame([(Decimal("10.004"),)] * 100, "amount decimal(18,6)")
    states = df.agg(F.sum("amount").alias("s"), F.count("amount").alias("n"))
    row = states.select(money_to_double(F.col("s")).alias("total"), half_up_avg("s", "n").alias("mean")).first()
    assert (row.total, row.mean) == (1000.4, 10.0)
