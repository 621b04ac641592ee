"""Global row positions without funnelling the frame through one task.

``row_number() OVER (ORDER BY ...)`` with no partition moves every row into a
single task.  Here the frame is range-partitioned on the order, sorted inside
each partition and staged once; rows are numbered inside each partition
(``monotonically_increasing_id`` is consecutive within a partition), and each
partition adds the row count of the partitions before it.  Only the
per-partition counts (one row per partition) are gathered in one place and
broadcast back.  AQE makes as many partitions as the rows need, so a small frame
is one task and one file.

Several orders of one frame are numbered in the same pass
(:func:`with_positions`): every row enters once per order, the order's number is
the first sort key, and as all orders have the same rows, a row's place in its
order is its place among all less the rows of the orders before.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tarmac.sources.staging import Staging, process_staging

_PART, _ID, _OFFSET, _N, _ALL = "__pos_part", "__pos_id", "__pos_offset", "__pos_n", "__pos_all"
SERIES, _LAST, _KEY = "__series", "__series_null", "__series_key"


def _numbered(
    df: DataFrame, order: Sequence[Column], partitions: int | None, staging: Staging | None
) -> tuple[DataFrame, Column, Column]:
    """The staged frame, a row's place in it from 0, and the number of all rows."""
    sizes = [] if partitions is None else [partitions]
    staged = (staging or process_staging(df.sparkSession)).write(
        df.repartitionByRange(*sizes, *order)
        .sortWithinPartitions(*order)
        .withColumn(_PART, F.spark_partition_id())
        .withColumn(_ID, F.monotonically_increasing_id()),
        "positions",
    )
    counts = staged.groupBy(_PART).agg(F.count(F.lit(1)).alias(_N))
    # One row per partition: the running total is bounded by their number.
    before = Window.orderBy(_PART).rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.orderBy(_PART).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    offsets = counts.select(
        _PART, F.coalesce(F.sum(_N).over(before), F.lit(0)).alias(_OFFSET), F.sum(_N).over(everything).alias(_ALL)
    )
    local = F.col(_ID) - F.shiftleft(F.col(_PART).cast("long"), 33)
    return staged.join(F.broadcast(offsets), _PART, "inner"), F.col(_OFFSET) + local, F.col(_ALL)


def with_position(
    df: DataFrame,
    order: Sequence[Column],
    name: str = "position",
    start: int = 1,
    partitions: int | None = None,
    staging: Staging | None = None,
) -> DataFrame:
    """Append ``name``: the row's place (from ``start``) in ``order``.

    ``order`` should be a total order (add tie-breaking columns); rows that tie
    on every order column are interchangeable, so the result is still unique.
    """
    numbered, place, _ = _numbered(df, order, partitions, staging)
    return numbered.withColumn(name, (place + F.lit(start)).cast("int")).drop(_PART, _ID, _OFFSET, _ALL)


class Order(NamedTuple):
    """A numeric sort value; nulls come last either way."""

    value: Column
    descending: bool = False


def with_positions(
    df: DataFrame,
    orders: Mapping[str, Order],
    ties: Sequence[Column],
    name: str = "position",
    start: int = 1,
    staging: Staging | None = None,
) -> DataFrame:
    """Every row of ``df`` once per order, with the order's name in ``__series`` and its place in that order.

    Equal values are ordered by ``ties``.  One sort and one staged table serve
    all orders."""
    entries = []
    for at, order in enumerate(orders.values()):
        value = order.value.cast("double")
        key = -value if order.descending else value
        entries.append(F.struct(F.lit(at).alias(SERIES), value.isNull().alias(_LAST), key.alias(_KEY)))
    long = df.withColumn("__entry", F.explode(F.array(*entries))).select(*df.columns, "__entry.*")
    sort = [F.col(SERIES), F.col(_LAST), F.col(_KEY), *ties]
    numbered, place, total = _numbered(long, sort, None, staging)
    place = place - F.col(SERIES) * (total / F.lit(len(orders))).cast("bigint") + F.lit(start)
    names = F.element_at(F.array(*map(F.lit, orders)), F.col(SERIES) + 1)
    return numbered.select(*df.columns, names.alias(SERIES), place.cast("int").alias(name))


def in_series(numbered: DataFrame, name: str) -> DataFrame:
    """The rows of one order of :func:`with_positions`."""
    return numbered.where(F.col(SERIES) == F.lit(name)).drop(SERIES)
