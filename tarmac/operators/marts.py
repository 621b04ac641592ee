"""The eight gold marts, declared as data and built from shared aggregation states.

Each mart is a GROUP BY over the wide table.  Marts with the same grain share
one aggregation: the *states* (counts, exact decimal sums, extremes, distinct
counts) are computed once per grain and every mart of that grain is a
projection of them.  Coarser marts whose keys are columns of a finer grain
(gender, nationality ⊂ passenger) re-aggregate the finer states instead of
re-reading the wide table, and months are added up from days.

Distinct counts are exact.  ``countDistinct`` of several columns shuffles every
row once per column, with all its keys, so grains with an id (airport, passenger)
count otherwise: their rows are shuffled once, by the id, and in each task sorts
find the first row of each value in its group.  The rows of hot ids, and those
without an id, keep ``countDistinct``, which spreads a group by its values.
Everything else is combined inside each task before a shuffle, so a key holding
a third of the rows is no harm.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tarmac.config import PipelineConfig
from tarmac.functions.dates import parse_date
from tarmac.functions.money import half_up_avg, money_to_double
from tarmac.operators.join import sketch_counts
from tarmac.sources.staging import process_staging

KINDS = ("count", "count_distinct", "sum", "avg", "max", "min")


@dataclass(frozen=True)
class Measure:
    """``name = kind(column)``; money kinds (sum/avg/max/min) are rounded to cents."""

    name: str
    kind: str
    column: str

    def __post_init__(self) -> None:
        if self.kind not in KINDS:
            raise ValueError(f"unknown measure kind {self.kind!r}")


@dataclass(frozen=True)
class MartSpec:
    name: str
    grain: str
    # (output column, grain column)
    keys: tuple[tuple[str, str], ...]
    measures: tuple[Measure, ...]
    # (output column, descending?) — output keys are appended as tie-breakers
    order: tuple[tuple[str, bool], ...]
    comment: str
    # True when the keys are coarser than the grain: re-aggregate its states
    rollup: bool = False
    # columns that readers look single values up by: their files carry Bloom filters
    lookup: tuple[str, ...] = ()

    @property
    def columns(self) -> list[str]:
        return [k for k, _ in self.keys] + [m.name for m in self.measures]


@dataclass(frozen=True)
class Grain:
    """Grouping columns of one aggregation.  Marts of a grain may group by
    different subsets of them."""

    name: str
    keys: tuple[str, ...]
    needs_dates: bool = False
    # the key that settles the others as a rule (not needed for right results)
    id: str | None = None


def bookings(name: str = "total_bookings") -> Measure:
    return Measure(name, "count", "booking_id")


def passengers(name: str = "unique_passengers") -> Measure:
    return Measure(name, "count_distinct", "passenger_id")


def revenue(name: str = "total_revenue") -> Measure:
    return Measure(name, "sum", "amount")


def average(name: str) -> Measure:
    return Measure(name, "avg", "amount")


AIRPORT_KEYS = (("airport_id", "airport_id"), ("airport_name", "airport_name"), ("city", "city"), ("country", "country"))

# Table comments of the eight gold tables.
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

MARTS: tuple[MartSpec, ...] = (
    MartSpec(
        "gold_airport_revenue_summary",
        "airport",
        AIRPORT_KEYS,
        (bookings(), revenue(), average("avg_revenue_per_booking")),
        (("total_revenue", True),),
        COMMENTS["gold_airport_revenue_summary"],
        lookup=("airport_name",),
    ),
    MartSpec(
        "gold_top_airports",
        "airport",
        AIRPORT_KEYS,
        (bookings(), passengers(), revenue()),
        (("total_bookings", True),),
        COMMENTS["gold_top_airports"],
    ),
    MartSpec(
        "gold_monthly_booking_trends",
        "calendar",
        (("year_month", "year_month"),),
        (bookings(), passengers(), revenue(), average("avg_revenue_per_booking")),
        (("year_month", False),),
        COMMENTS["gold_monthly_booking_trends"],
    ),
    MartSpec(
        "gold_airport_performance",
        "airport",
        AIRPORT_KEYS,
        (
            Measure("total_flights", "count_distinct", "flight_id"),
            passengers(),
            bookings(),
            revenue(),
            average("avg_booking_value"),
            Measure("max_booking_value", "max", "amount"),
            Measure("min_booking_value", "min", "amount"),
        ),
        (),
        COMMENTS["gold_airport_performance"],
        lookup=("airport_name",),
    ),
    MartSpec(
        "gold_passenger_booking_summary",
        "passenger",
        (("passenger_id", "passenger_id"), ("passenger_name", "name"), ("gender", "gender"), ("nationality", "nationality")),
        (
            bookings(),
            revenue("total_spend"),
            average("avg_spend_per_booking"),
            Measure("max_single_booking", "max", "amount"),
            Measure("airports_visited", "count_distinct", "airport_id"),
            Measure("flights_taken", "count_distinct", "flight_id"),
        ),
        (("total_spend", True),),
        COMMENTS["gold_passenger_booking_summary"],
    ),
    MartSpec(
        "gold_gender_booking_summary",
        "passenger",
        (("gender", "gender"),),
        # avg of amount per booking, despite the name (kept as specified)
        (passengers(), bookings(), revenue(), average("avg_spend_per_booking")),
        (),
        COMMENTS["gold_gender_booking_summary"],
        rollup=True,
    ),
    MartSpec(
        "gold_nationality_revenue",
        "passenger",
        (("nationality", "nationality"),),
        # avg of amount per booking, despite the name (kept as specified)
        (passengers(), bookings(), revenue(), average("avg_spend_per_passenger")),
        (("total_revenue", True),),
        COMMENTS["gold_nationality_revenue"],
        rollup=True,
    ),
    MartSpec(
        "gold_peak_travel_days",
        "calendar",
        (("travel_date", "travel_date"), ("day_of_week_num", "day_of_week_num"), ("day_of_week_name", "day_of_week_name")),
        (bookings(), passengers(), revenue()),
        (("total_bookings", True),),
        COMMENTS["gold_peak_travel_days"],
    ),
)

MART_BY_NAME = {m.name: m for m in MARTS}

GRAINS = {
    "airport": Grain("airport", ("airport_id", "airport_name", "city", "country"), id="airport_id"),
    "passenger": Grain("passenger", ("passenger_id", "name", "gender", "nationality"), id="passenger_id"),
    # month and day marts: the parsed date and what follows from it
    "calendar": Grain(
        "calendar", ("year_month", "travel_date", "day_of_week_num", "day_of_week_name"), needs_dates=True
    ),
}
SET_ID = "__set"


# ── aggregation states ─────────────────────────────────────────────────────


def _state_names(m: Measure) -> list[str]:
    c = m.column
    return {
        "count": [f"__cnt__{c}"],
        "count_distinct": [f"__dst__{c}"],
        "sum": [f"__sum__{c}"],
        "avg": [f"__sum__{c}", f"__num__{c}"],
        "max": [f"__max__{c}"],
        "min": [f"__min__{c}"],
    }[m.kind]


def _state_agg(state: str) -> Column:
    kind, column = state[2:].split("__", 1)
    c = F.col(column)
    return {
        "cnt": F.count(c),
        "dst": F.countDistinct(c),
        "sum": F.sum(c),
        "num": F.count(c),
        "max": F.max(c),
        "min": F.min(c),
    }[kind].alias(state)


def _rollup_agg(state: str) -> Column:
    kind, column = state[2:].split("__", 1)
    s = F.col(state)
    return {
        "cnt": F.sum(s),
        "dst": F.countDistinct(F.col(column)),
        "sum": F.sum(s),
        "num": F.sum(s),
        "max": F.max(s),
        "min": F.min(s),
    }[kind].alias(state)


def _unique(items: Iterable[str]) -> list[str]:
    return list(dict.fromkeys(items))


def states_for(measures: Iterable[Measure], rollup: bool = False) -> list[str]:
    """States a grain must keep so that ``measures`` can be finalized.

    For a rollup, distinct counts are recomputed from the grain keys, so the
    fine grain needs no state for them."""
    return _unique(
        s for m in measures if not (rollup and m.kind == "count_distinct") for s in _state_names(m)
    )


def with_booking_dates(df: DataFrame, on_bad_date: str) -> DataFrame:
    """Parse ``booking_date`` once and derive the date keys (month, weekday)."""
    day = parse_date(F.col("booking_date"), on_bad_date)
    return date_keys(df.select("*", day.alias("travel_date")))


def date_keys(df: DataFrame) -> DataFrame:
    """The month and weekday of ``travel_date``."""
    return df.select(
        "*",
        F.date_format("travel_date", "yyyy-MM").alias("year_month"),
        F.dayofweek("travel_date").alias("day_of_week_num"),
        F.date_format("travel_date", "EEEE").alias("day_of_week_name"),
    )


def _key_set(spec: MartSpec) -> tuple[str, ...]:
    """Grain columns the mart's states are grouped by (all of them for a rollup)."""
    return GRAINS[spec.grain].keys if spec.rollup else tuple(g for _, g in spec.keys)


def _set_id(grain: Grain, key_set: tuple[str, ...]) -> int:
    """Spark's ``grouping_id()`` of a grouping set: one bit per grain column
    (first column = highest bit), set when the column is not grouped."""
    value = 0
    for column in grain.keys:
        value = (value << 1) | (column not in key_set)
    return value


def _counted_columns(states: Sequence[str]) -> dict[str, set[str]]:
    """Kinds of state by the column that they are of."""
    kinds: dict[str, set[str]] = {}
    for state in states:
        kind, column = state[2:].split("__", 1)
        kinds.setdefault(column, set()).add(kind)
    return kinds


def _states_by_id(obt: DataFrame, g: Grain, states: Sequence[str], cfg: PipelineConfig, stored: bool) -> DataFrame:
    """The states of a grain with an id, its distinct values counted after one shuffle of the rows by the id.

    Finding the hot ids reads the rows once more, so rows that are not ``stored`` are staged."""
    kinds = _counted_columns(states)
    only_counted = [c for c, k in kinds.items() if k <= {"cnt", "num"} and c not in g.keys]
    columns = [c for c in obt.columns if c in g.keys or (c in kinds and c not in only_counted)]
    rows = obt.select(*columns, *(F.when(F.col(c).isNotNull(), 1).alias(c) for c in only_counted))
    if not stored:
        rows = process_staging(obt.sparkSession).write(rows, f"{g.name}-rows")
    hot = [k for k, n in sketch_counts(rows, [g.id])[g.id] if n >= cfg.hot_key_rows and k is not None]
    apart = F.col(g.id).isNull() | F.col(g.id).isin(hot)
    firsts = {}
    for state in states:
        kind, column = state[2:].split("__", 1)
        if kind == "dst":
            same = Window.partitionBy(*g.keys, column).orderBy(column)
            firsts[state] = F.when(F.col(column).isNotNull() & (F.row_number().over(same) == 1), 1)
    # Rows of one id beside each other on their way out of a task compress to the values that differ.  A sort right
    # under a shuffle would be planned away, so the task's number comes between.
    ordered = rows.where(~apart).sortWithinPartitions(*g.keys).withColumn("__task", F.spark_partition_id())
    flagged = ordered.repartition(g.id)
    for state, first in firsts.items():
        flagged = flagged.withColumn(state, first)
    aggs = [F.count(s).alias(s) if s in firsts else _state_agg(s) for s in states]
    usual = flagged.groupBy(*g.keys).agg(*aggs)
    return usual.unionByName(rows.where(apart).groupBy(*g.keys).agg(*map(_state_agg, states)))


def _states_by_date(src: DataFrame, g: Grain, sets: Sequence[tuple[str, ...]], states: Sequence[str]) -> DataFrame:
    """The states of the month and the day marts, distinct values counted from one row per month and value.

    Such a row has a bit for each day of the month on which the value occurs (bit 0: no date), so tasks combine the rows
    of a value before the only shuffle, however frequent it is."""
    date = "travel_date"
    plain = [s for s in states if not s.startswith("__dst__")]
    days = src.groupBy(date).agg(*map(_state_agg, plain))
    months = days.groupBy(F.trunc(date, "MM").alias(date)).agg(*map(_rollup_agg, plain))
    for state in states:
        if state in plain:
            continue
        value = F.col(state[2:].split("__", 1)[1])
        bit = F.call_function("shiftleft", F.lit(1).cast("bigint"), F.coalesce(F.dayofmonth(date), F.lit(0)))
        seen = src.where(value.isNotNull()).groupBy(F.trunc(date, "MM").alias("__month"), value.alias("__value")).agg(F.bit_or(bit).alias("__days"))
        by_month = seen.groupBy("__month").agg(F.count(F.lit(1)).alias(state))
        marked = F.filter(F.sequence(F.lit(0), F.lit(31)), lambda d: F.getbit("__days", d) == 1)
        on = seen.select("__month", F.explode(marked).alias("__day"))
        on = on.groupBy(F.when(F.col("__day") > 0, F.date_add("__month", F.col("__day") - 1)).alias("__month"))
        by_day = on.agg(F.count(F.lit(1)).alias(state))
        days = _with_count(days, by_day, date, state)
        months = _with_count(months, by_month, date, state)
    found = {"year_month": months, date: days}
    return reduce(DataFrame.unionByName, [_dated(found[keys[0]], g, keys, states) for keys in sets])


def _with_count(frame: DataFrame, counts: DataFrame, date: str, state: str) -> DataFrame:
    joined = frame.join(counts, F.col(date).eqNullSafe(F.col("__month")), "left")
    return joined.select(*frame.columns, F.coalesce(state, F.lit(0)).alias(state))


def _dated(frame: DataFrame, g: Grain, keys: tuple[str, ...], states: Sequence[str]) -> DataFrame:
    """The columns that GROUPING SETS would give one of its sets."""
    dated = date_keys(frame)
    columns = [F.col(c) if c in keys else F.lit(None).cast(dated.schema[c].dataType).alias(c) for c in g.keys]
    return dated.select(*columns, F.lit(_set_id(g, keys)).cast("bigint").alias(SET_ID), *states)


def grain_states(
    obt: DataFrame, grain: str, cfg: PipelineConfig, marts: Sequence[MartSpec] | None = None, stored: bool = False
) -> DataFrame:
    """One aggregation of the wide table at ``grain`` holding the states of all
    marts built from it (or of ``marts`` only).

    When those marts group by different column sets of the grain, rows are
    tagged with ``__set``, as GROUPING SETS does.
    ``stored`` says that ``obt`` is a table, so that reading it again is cheap."""
    g = GRAINS[grain]
    marts = [m for m in (marts if marts is not None else MARTS) if m.grain == grain]
    states = _unique(s for m in marts for s in states_for(m.measures, m.rollup))
    aggs = [_state_agg(s) for s in states]
    src = with_booking_dates(obt, cfg.on_bad_date) if g.needs_dates else obt
    sets = _unique(_key_set(m) for m in marts)
    if g.id is not None and len(sets) == 1 and any(s.startswith("__dst__") for s in states):
        return _states_by_id(src, g, states, cfg, stored)
    if len(sets) == 1:
        return src.groupBy(*sets[0]).agg(*aggs)
    return _states_by_date(src, g, sets, states)


def finalize(states: DataFrame, spec: MartSpec) -> DataFrame:
    """Project a mart out of the states of its grain (rolling up if needed)."""
    if SET_ID in states.columns:
        states = states.where(F.col(SET_ID) == F.lit(_set_id(GRAINS[spec.grain], _key_set(spec))))
    if spec.rollup:
        need = _unique(s for m in spec.measures for s in _state_names(m))
        states = states.groupBy(*[g for _, g in spec.keys]).agg(*[_rollup_agg(s) for s in need])
    keys = [F.col(g).alias(out) for out, g in spec.keys]
    return states.select(*keys, *[_final(m).alias(m.name) for m in spec.measures])


def _final(m: Measure) -> Column:
    """A measure's mart column from its states: counts as they are, money
    rounded to cents and returned as the nearest double."""
    c = m.column
    if m.kind == "count":
        return F.col(f"__cnt__{c}")
    if m.kind == "count_distinct":
        return F.col(f"__dst__{c}")
    if m.kind == "avg":
        return half_up_avg(f"__sum__{c}", f"__num__{c}")
    return money_to_double(F.col(f"__{m.kind}__{c}"))


def build_mart(obt: DataFrame, name: str, cfg: PipelineConfig) -> DataFrame:
    """A single mart over the wide table."""
    spec = MART_BY_NAME[name]
    return finalize(grain_states(obt, spec.grain, cfg, [spec]), spec)


def sort_for_write(df: DataFrame, spec: MartSpec) -> DataFrame:
    """The mart's ORDER BY, made total with its keys as tie-breakers."""
    if not spec.order:
        return df
    order = [F.col(c).desc_nulls_last() if desc else F.col(c).asc_nulls_first() for c, desc in spec.order]
    used = {c for c, _ in spec.order}
    order += [F.col(k).asc_nulls_first() for k, _ in spec.keys if k not in used]
    return df.orderBy(*order)
