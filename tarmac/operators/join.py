"""The wide table: bookings left-joined to passengers and airports.

Left joins never drop a booking.  Each dimension is joined by one of these plans:

* **broadcast hash join** when one aggregate proves the dimension small
  (``cfg.broadcast_max_rows`` rows and ``cfg.broadcast_max_bytes`` bytes of
  values): the fact side is not shuffled at all, so hot keys cost nothing;
* **salted shuffle join** otherwise: the hot keys, null included (at least
  ``cfg.hot_key_rows`` fact rows), are spread over
  ``ceil(rows / cfg.salt_rows)`` sub-keys each; dimension
  rows of hot keys are copied once per sub-key.  Every other key
  joins as a plain equi-join, and AQE skew splitting still applies on top
  (``cfg.skew_salting=False`` leaves only the plain shuffle join and AQE).

The wide table finds the hot keys of all its joins in one pass: each task keeps
a frequent-items sketch of every key column, the sketches are merged, and at most
``SKETCH_KEYS`` keys a column come out.  Counts are estimates, and a key that the
sketch misses is joined unsalted: that costs time, never rows.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.types import (
    BinaryType,
    BooleanType,
    ByteType,
    DataType,
    DateType,
    DecimalType,
    FloatType,
    IntegerType,
    ShortType,
    StringType,
    StructField,
    StructType,
)

from tarmac.config import PipelineConfig
from tarmac.sources.staging import process_staging

SKETCH_KEYS, SKETCH_ITEMS = 4096, 1 << 16  # hot keys that a sketch gives, and keys that it follows

_HOT = "__hot_key"
_BUCKETS = "__buckets"
_SALT = "__salt"


def _col(name: str) -> Column:
    """Column by exact name (names from CSV headers may contain dots)."""
    return F.col(f"`{name}`")


def check_no_clash(left: DataFrame, right: DataFrame, key: str) -> None:
    """Fail early when a non-key column exists on both sides of a join."""
    lower_left = {c.lower(): c for c in left.columns}
    shared = sorted(
        (lower_left[c.lower()], c) for c in right.columns if c.lower() in lower_left and c.lower() != key.lower()
    )
    if shared:
        names = ", ".join(a if a == b else f"{a}/{b}" for a, b in shared)
        raise ValueError(f"join on {key!r}: column(s) present on both sides: {names}")


def _fixed_width(dtype: DataType) -> int:
    if isinstance(dtype, (ByteType, BooleanType)):
        return 1
    if isinstance(dtype, ShortType):
        return 2
    if isinstance(dtype, (IntegerType, FloatType, DateType)):
        return 4
    if isinstance(dtype, DecimalType):
        return 8 if dtype.precision <= 18 else 16
    return 8


def _payload_bytes(df: DataFrame) -> Column:
    """Bytes of one row's values: exact for strings/binary, type width otherwise."""
    sizes = []
    for field in df.schema.fields:
        c = _col(field.name)
        if isinstance(field.dataType, (StringType, BinaryType)):
            sizes.append(F.coalesce(F.octet_length(c), F.lit(0)).cast("long"))
        else:
            sizes.append(F.lit(_fixed_width(field.dataType)).cast("long"))
    return reduce(lambda a, b: a + b, sizes, F.lit(0).cast("long"))


def fits_broadcast(dim: DataFrame, cfg: PipelineConfig) -> bool:
    """Prove a dimension small enough to broadcast: one distributed aggregate
    (a partial count and byte sum per task) of its row count and payload bytes."""
    row = dim.agg(F.count(F.lit(1)).alias("rows"), F.sum(_payload_bytes(dim)).alias("bytes")).collect()[0]
    return row["rows"] <= cfg.broadcast_max_rows and (row["bytes"] or 0) <= cfg.broadcast_max_bytes


def hot_keys(fact: DataFrame, key: str, cfg: PipelineConfig) -> DataFrame:
    """``(key, __buckets)`` for the keys — null included — holding at least
    ``cfg.hot_key_rows`` fact rows, each with the number of sub-keys that leaves
    about ``cfg.salt_rows`` rows per sub-key."""
    counts = fact.groupBy(key).agg(F.count(F.lit(1)).alias("__rows"))
    return (
        counts.where(F.col("__rows") >= cfg.hot_key_rows)
        .select(key, F.ceil(F.col("__rows") / F.lit(cfg.salt_rows)).cast("int").alias(_BUCKETS))
    )


def sketch_counts(fact: DataFrame, keys: Sequence[str]) -> dict[str, list[tuple]]:
    """``(value, estimated rows)`` of at most ``SKETCH_KEYS`` frequent values of each column, from one scan."""
    sketches = [F.expr(f"approx_top_k(`{k}`, {SKETCH_KEYS}, {max(SKETCH_ITEMS, SKETCH_KEYS)})").alias(k) for k in keys]
    found = fact.agg(*sketches).first()
    return {k: [(x["item"], x["count"]) for x in found[k] or []] for k in keys}


def sketch_hot_keys(fact: DataFrame, keys: Sequence[str], cfg: PipelineConfig) -> dict[str, DataFrame]:
    """As :func:`hot_keys` for several keys, from one scan of their columns and without a shuffle of their values: at
    most ``SKETCH_KEYS`` keys each, by estimated counts."""
    out = {}
    for key, found in sketch_counts(fact, keys).items():
        rows = [(item, -(-count // cfg.salt_rows)) for item, count in found if count >= cfg.hot_key_rows]
        schema = StructType([StructField(key, fact.schema[key].dataType), StructField(_BUCKETS, IntegerType())])
        out[key] = fact.sparkSession.createDataFrame(rows, schema)
    return out


def salted_left_join(
    fact: DataFrame,
    dim: DataFrame,
    key: str,
    cfg: PipelineConfig,
    hot: DataFrame | None = None,
) -> DataFrame:
    """Left equi-join on ``key`` that survives a key holding a third of the rows.

    A hot key with ``r`` rows is split into ``ceil(r / cfg.salt_rows)``
    sub-keys, so the spread grows with the data.  ``hot`` (from
    :func:`sketch_hot_keys`: bounded, so broadcast) may be computed on a cheaper
    frame than ``fact`` — e.g. the raw bookings instead of an already joined
    frame: which keys are salted only spreads load, the join result is exact
    either way.  Without it the keys of ``fact`` are counted exactly."""
    if hot is not None:
        hot = F.broadcast(hot)
    else:
        # Counted once; broadcast only behind the same size proof as a dimension.
        hot = process_staging(fact.sparkSession).write(hot_keys(fact, key, cfg), "hot-keys")
        if fits_broadcast(hot, cfg):
            hot = F.broadcast(hot)
    hot_key = hot.select(_col(key).alias(_HOT), _BUCKETS)
    # Spread by row content and input partition: deterministic on task retry,
    # and exact copies of one row still land in different sub-keys when they
    # come from different input splits.
    spread = F.pmod(F.xxhash64(F.spark_partition_id(), *[_col(c) for c in fact.columns]), F.col(_BUCKETS))
    salted_fact = (
        # null-safe: a hot null key (never matching) is spread like any other
        fact.join(hot_key, fact[f"`{key}`"].eqNullSafe(hot_key[_HOT]), "left")
        .withColumn(_SALT, F.when(F.col(_BUCKETS).isNotNull(), spread).otherwise(F.lit(0)).cast("int"))
        .drop(_HOT, _BUCKETS)
    )
    copies = F.when(F.col(_BUCKETS).isNotNull(), F.sequence(F.lit(0), F.col(_BUCKETS) - 1))
    salted_dim = (
        dim.join(hot, key, "left")
        .withColumn(_SALT, F.explode(copies.otherwise(F.array(F.lit(0)))))
        .drop(_BUCKETS)
    )
    return salted_fact.join(salted_dim, [key, _SALT], "left").drop(_SALT)


def left_join_dimension(
    fact: DataFrame,
    dim: DataFrame,
    key: str,
    cfg: PipelineConfig,
    hot: DataFrame | None = None,
    small: bool | None = None,
) -> DataFrame:
    """``fact LEFT JOIN dim USING (key)`` with the plan chosen by dimension size (``small``, if proven before)."""
    check_no_clash(fact, dim, key)
    if fits_broadcast(dim, cfg) if small is None else small:
        joined = fact.join(F.broadcast(dim), key, "left")
    elif cfg.skew_salting:
        joined = salted_left_join(fact, dim, key, cfg, hot)
    else:
        joined = fact.join(dim, key, "left")
    rest = [c for c in fact.columns if c != key] + [c for c in dim.columns if c != key]
    return joined.select(_col(key), *[_col(c) for c in rest])


def build_obt(
    bookings: DataFrame,
    passengers: DataFrame,
    airports: DataFrame,
    cfg: PipelineConfig,
    keys: Sequence[str] = ("passenger_id", "airport_id"),
    unmatched: Observation | None = None,
) -> DataFrame:
    """One row per booking (times duplicate dimension rows), all columns.

    Column order follows two USING joins: ``airport_id, passenger_id``, then
    the other booking, passenger and airport columns.  ``unmatched`` observes
    (see :func:`unmatched_metrics`) while the rows are used, whatever for.
    """
    pax_key, apt_key = keys
    check_no_clash(bookings, passengers, pax_key)
    check_no_clash(bookings.drop(pax_key), airports, apt_key)
    check_no_clash(passengers.drop(pax_key), airports.drop(apt_key), apt_key)
    small = {pax_key: fits_broadcast(passengers, cfg), apt_key: fits_broadcast(airports, cfg)}
    large = [k for k in keys if not small[k]] if cfg.skew_salting else []
    # Hot keys of both joins come from the booking key columns alone, in one
    # scan, never from the already joined frame.
    hot = sketch_hot_keys(bookings, large, cfg) if large else {}
    if unmatched is not None:
        passengers, airports = passengers.withColumn(_mark(pax_key), F.lit(True)), airports.withColumn(_mark(apt_key), F.lit(True))
    with_pax = left_join_dimension(bookings, passengers, pax_key, cfg, hot.get(pax_key), small[pax_key])
    wide = left_join_dimension(with_pax, airports, apt_key, cfg, hot.get(apt_key), small[apt_key])
    if unmatched is None:
        return wide
    return wide.observe(unmatched, *unmatched_metrics(keys)).drop(*(_mark(k) for k in keys))


def _mark(key: str) -> str:
    """Column of a dimension that is true in every row of it, so null where a left join found none."""
    return f"__found_{key}"


def unmatched_metrics(keys: Sequence[str]) -> list[Column]:
    """Rows of the wide table without a key, and rows whose key no dimension row has, for each key."""
    metrics = []
    for key in keys:
        missing = _col(key).isNull()
        metrics.append(F.count(F.when(missing, 1)).alias(f"null:{key}"))
        metrics.append(F.count(F.when(~missing & _col(_mark(key)).isNull(), 1)).alias(f"dangling:{key}"))
    return metrics
