"""Shards by jump consistent hashing.

``shard_of`` maps a stable 64-bit key to one of ``shards`` numbers with no ring
table.  When shards are appended, a key either stays or moves to a new shard,
and only the necessary fraction moves (Lamping and Veach, "A Fast, Minimal
Memory, Consistent Hash Algorithm").

The key is an integer column as it is, any other column's 64-bit xxHash.  A
null key counts as key 0.  Rows with equal keys share a shard, not a task.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .offsets import running_total

_STEP = np.uint64(2862933555777941757)  # fixed by the published algorithm


def jump_hash(keys: np.ndarray, shards: int) -> np.ndarray:
    """The published loop over a whole array: each round advances the keys that have not yet jumped past ``shards``."""
    if shards < 1:
        raise ValueError("shards must be at least 1")
    state = keys.astype(np.int64).view(np.uint64).copy()
    bucket = np.full(len(state), -1, dtype=np.int64)
    jump = np.zeros(len(state), dtype=np.int64)
    live = np.arange(len(state))
    while len(live):
        bucket[live] = jump[live]
        state[live] = state[live] * _STEP + np.uint64(1)
        span = (state[live] >> np.uint64(33)).astype(np.float64) + 1.0
        jump[live] = ((bucket[live] + 1).astype(np.float64) * (float(1 << 31) / span)).astype(np.int64)
        live = live[jump[live] < shards]
    return bucket


def _hashed(shards: int):
    @F.pandas_udf("int")
    def assign(keys: pd.Series) -> pd.Series:
        return pd.Series(jump_hash(keys.to_numpy(dtype=np.int64), shards), dtype="int32")

    return assign


def shard_of(key, shards: int, key_type: str = "bigint"):
    """Column: the shard of a key column."""
    stable = key.cast("bigint") if key_type in ("tinyint", "smallint", "int", "bigint") else F.xxhash64(key)
    return _hashed(shards)(F.coalesce(stable, F.lit(0).cast("bigint")))


def _aside(df: DataFrame, name: str) -> DataFrame:
    """A column that has the name of a new one is kept, with underscores behind its name."""
    taken = {c.lower() for c in df.columns}
    if name.lower() not in taken:
        return df
    other = name
    while other.lower() in taken:
        other += "_"
    return df.withColumnRenamed(name, other)


def assign_shards(df: DataFrame, key: str, shards: int, name: str = "shard") -> DataFrame:
    """Append the shard of each row.  An empty frame stays empty; other columns are untouched, but for one that is
    called ``name``, which gets underscores behind its name."""
    kind = dict(df.dtypes)[key]
    aside = _aside(df, name)
    now = aside.columns[df.columns.index(key)]  # the key itself may have had that name
    return aside.withColumn(name, shard_of(F.col(f"`{now}`"), shards, kind))


def number_in_shards(df: DataFrame, key: str, shard: str = "shard", name: str = "slot") -> DataFrame:
    """Append each row's place in its shard, from 0 without gaps, in key order; repeated keys take adjacent places.

    The frame is sorted over all tasks by (shard, key, a hash of the row), so
    neither a large shard nor a key that very many rows share (null, say) stays
    with one task, and only the counts per task and shard meet (see ``offsets``).
    A column that is called ``name`` gets underscores behind its name."""
    aside = _aside(df, name)
    columns = [F.col(f"`{c}`") for c in aside.columns]
    keyed = aside.select(
        F.struct(*columns).alias("row"),
        F.col(f"`{aside.columns[df.columns.index(key)]}`").alias("key"),
        F.col(f"`{aside.columns[df.columns.index(shard)]}`").alias("shard"),
        F.xxhash64(*(F.col(f"`{c}`") for c, kind in aside.dtypes if "map<" not in kind)).alias("tie"),
        F.lit(1).cast("bigint").alias("one"),
    )
    numbered = running_total(keyed, [F.col("key"), F.col("tie")], "one", "slot", group="shard", label="shards")
    return numbered.select(*(F.col(f"row.`{c}`").alias(c) for c in aside.columns), F.col("slot").alias(name))


def write_shards(df: DataFrame, path: str, shard: str = "shard") -> None:
    """One folder of Parquet files per shard."""
    df.write.mode("error").partitionBy(shard).parquet(path)
