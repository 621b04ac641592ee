"""Running totals over a global order, without one task that sees every row.

The frame is range-partitioned on the order and written once; each partition
numbers its own rows while it streams past, and adds the totals of the
partitions before it.  Only the totals (one row per partition and group) meet
in one window.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .storage import materialize

PART, LOCAL = "__part", "__local"


def local_sums(weight: str, group: str | None) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """mapInArrow function: append the weight of the partition's earlier rows (of the same group, rows sorted by it)."""

    def run(batches):
        carry, current = 0, None
        for batch in batches:
            n = batch.num_rows
            if n == 0:
                continue
            w = np.asarray(batch.column(batch.schema.names.index(weight))).astype(np.int64)
            before = np.cumsum(w) - w + carry
            carry = int(before[-1] + w[-1])
            if group is not None:
                g = np.asarray(batch.column(batch.schema.names.index(group)))
                starts = np.flatnonzero(np.r_[current is None or g[0] != current, g[1:] != g[:-1]])
                if len(starts):
                    run_of = np.searchsorted(starts, np.arange(n), side="right") - 1
                    base = np.where(run_of >= 0, before[starts[np.maximum(run_of, 0)]], 0)
                    before = before - base
                carry, current = int(before[-1] + w[-1]), g[-1]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(before, pa.int64())], names=[*batch.schema.names, LOCAL]
            )

    return run


def running_total(
    df: DataFrame, order: Sequence[Column], weight: str, name: str, group: str | None = None, label: str = "offsets"
) -> DataFrame:
    """Append ``name``: the sum of ``weight`` over all earlier rows in ``order`` (earlier rows of the same ``group``).

    ``weight`` holds non-null longs and ``group`` a non-null integer.  Rows that
    tie on every order column take either place.  The result is a table on the
    shared folder, so it reads alike however often it is used.
    """
    keys = ([F.col(group)] if group else []) + list(order)
    ranged = df.repartitionByRange(*keys).sortWithinPartitions(*keys).withColumn(PART, F.spark_partition_id())
    schema = T.StructType([*ranged.schema.fields, T.StructField(LOCAL, T.LongType())])
    table = materialize(ranged.mapInArrow(local_sums(weight, group), schema), label)
    by = [PART, *([group] if group else [])]
    totals = table.groupBy(*by).agg(F.sum(weight).alias("__total"))
    window = Window.partitionBy(group) if group else Window.partitionBy(F.lit(0))
    window = window.orderBy(PART).rowsBetween(Window.unboundedPreceding, -1)
    base = totals.select(*by, F.coalesce(F.sum("__total").over(window), F.lit(0)).alias("__base"))
    return (
        table.join(base, by)
        .withColumn(name, F.col("__base") + F.col(LOCAL))
        .drop(PART, LOCAL, "__base")
    )
