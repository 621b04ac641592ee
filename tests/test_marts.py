"""Gold marts: dates, rounding, rollups and cross-mart invariants."""

from __future__ import annotations

from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from tarmac import registry
from tarmac.operators import marts
from tarmac.operators.join import build_obt
from tarmac.schemas import AIRPORTS, BOOKINGS, PASSENGERS


def wide(spark, cfg, bookings):
    b = spark.createDataFrame(bookings, BOOKINGS)
    p = spark.createDataFrame([(1, "Ann", "F", "NL")], PASSENGERS)
    a = spark.createDataFrame([(100, "Dubai Intl", "Dubai", "AE")], AIRPORTS)
    return build_obt(b, p, a, cfg)


def B(bid, amount, day, pid=1, aid=100):
    return (bid, pid, 1, aid, Decimal(amount), day)


def test_bad_dates_fail_or_null(spark, cfg):
    obt = wide(spark, cfg, [B(1, "1.00", "2024-13-01"), B(2, "1.00", "2024-01-01 10:00:00"), B(3, "2.00", "2024-01-07")])
    with pytest.raises(Exception, match="cannot parse date"):
        marts.build_mart(obt, "gold_peak_travel_days", cfg).collect()
    rows = marts.build_mart(obt, "gold_peak_travel_days", cfg.with_(on_bad_date="null")).collect()
    nulls = [r for r in rows if r.travel_date is None]
    assert len(nulls) == 1 and nulls[0].total_bookings == 2


def test_sunday_is_one(spark, cfg):
    obt = wide(spark, cfg, [B(1, "1.00", "2024-01-07")])
    row = marts.build_mart(obt, "gold_peak_travel_days", cfg).collect()[0]
    assert (row.day_of_week_num, row.day_of_week_name) == (1, "Sunday")
    month = marts.build_mart(obt, "gold_monthly_booking_trends", cfg).collect()[0]
    assert month.year_month == "2024-01"


def test_rounding_tie_is_half_up(spark, cfg):
    obt = wide(spark, cfg, [B(1, "5.02", "2024-01-07"), B(2, "5.03", "2024-01-07")])
    row = marts.build_mart(obt, "gold_airport_revenue_summary", cfg).collect()[0]
    assert row.avg_revenue_per_booking == 5.03
    assert row.total_revenue == 10.05


def test_rollups_equal_direct_aggregates(spark, cfg):
    obt = registry.obt(spark, SF_SMALL, cfg)
    for name, key in (("gold_gender_booking_summary", "gender"), ("gold_nationality_revenue", "nationality")):
        rolled = {r[key]: r for r in marts.build_mart(obt, name, cfg).collect()}
        direct = obt.groupBy(key).agg(
            F.countDistinct("passenger_id").alias("u"), F.count("booking_id").alias("b"), F.sum("amount").alias("s")
        )
        for r in direct.collect():
            got = rolled[r[key]]
            assert (got.unique_passengers, got.total_bookings) == (r.u, r.b)
            assert got.total_revenue == float(r.s)


def test_invariants_across_marts(spark, cfg):
    obt = registry.obt(spark, SF_SMALL, cfg)
    ids = obt.where(F.col("booking_id").isNotNull()).count()
    built = {m.name: marts.build_mart(obt, m.name, cfg) for m in marts.MARTS}
    for name, df in built.items():
        assert df.agg(F.sum("total_bookings")).collect()[0][0] == ids, name
    perf = built["gold_airport_performance"].collect()
    for r in perf:
        assert r.unique_passengers <= r.total_bookings
        assert r.min_booking_value <= r.avg_booking_value <= r.max_booking_value
    rev = sum(r.total_revenue for r in perf)
    for name in ("gold_gender_booking_summary", "gold_nationality_revenue", "gold_peak_travel_days"):
        other = built[name].agg(F.sum("total_revenue")).collect()[0][0]
        assert abs(other - rev) < 0.01


def odd_wide(spark):
    """Ids with several names, without an id, hot or not; values that come twice or are null."""
    import random

    rnd = random.Random(3)
    rows = []
    for i in range(600):
        pid = None if i % 11 == 0 else 1 if i % 3 == 0 else rnd.randrange(2, 9)
        aid = None if i % 13 == 0 else 100 if i % 2 == 0 else rnd.randrange(101, 105)
        day = None if i % 17 == 0 else f"2024-0{rnd.randrange(1, 4)}-{rnd.choice(['01', '15', '29'])}"
        flight = None if i % 5 == 0 else rnd.randrange(20)
        amount = None if i % 7 == 0 else Decimal(rnd.randrange(10000)) / 100
        name = None if pid is None else f"N{pid}-{i % 2}"
        rows.append((aid, pid, None if i % 19 == 0 else i, flight, amount, day, name, "F", rnd.choice([None, "NL"]), f"A{aid}", "c", None))
    columns = "airport_id long, passenger_id long, booking_id long, flight_id long, amount decimal(18,6), booking_date string, "
    return spark.createDataFrame(rows, columns + "name string, gender string, nationality string, airport_name string, city string, country string")


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("hot_key_rows", [50, 2_000_000])
@pytest.mark.parametrize("grain", ["airport", "passenger"])
def test_one_shuffle_by_id_counts_what_count_distinct_counts(spark, cfg, grain, hot_key_rows):
    obt = odd_wide(spark).cache()
    states = marts.grain_states(obt, grain, cfg.with_(hot_key_rows=hot_key_rows), stored=True)
    names = [c for c in states.columns if c.startswith("__")]
    direct = obt.groupBy(*marts.GRAINS[grain].keys).agg(*map(marts._state_agg, names))
    assert sorted(map(repr, states.select(direct.columns).collect())) == sorted(map(repr, direct.collect()))
    # Rows are copied per counted column only where they are hot or have no id.
    plan = plan_of(states)
    assert plan.count("Expand") == 1 and plan.count("REPARTITION_BY_COL") == 1


def test_months_and_days_count_distinct_values_from_months(spark, cfg):
    obt = odd_wide(spark).cache()
    states = marts.grain_states(obt, "calendar", cfg)
    g = marts.GRAINS["calendar"]
    names = [c for c in states.columns if c.startswith("__") and c != marts.SET_ID]
    sets = [["year_month"], list(g.keys[1:])]
    dated = marts.with_booking_dates(obt, "fail")
    direct = dated.groupingSets(sets, *g.keys).agg(F.grouping_id().alias(marts.SET_ID), *map(marts._state_agg, names))
    assert sorted(map(repr, states.select(direct.columns).collect())) == sorted(map(repr, direct.collect()))
    assert "Expand" not in plan_of(states)


def test_bookings_are_exported_without_a_shuffle(spark, cfg):
    from tarmac.sources import fixtures

    path = fixtures.export_csv(spark, SF_SMALL, cfg.root, ["bookings"])["bookings"]
    made = fixtures.bookings(spark, SF_SMALL)
    assert len(spark.read.text(path).inputFiles()) <= made.rdd.getNumPartitions()
