"""Wide-table join: left semantics, clashes, and the salted plan for skew."""

from __future__ import annotations

from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tarmac.operators.join import build_obt, left_join_dimension
from tarmac.schemas import AIRPORTS, BOOKINGS, OBT_COLUMNS, PASSENGERS


def frames(spark, bookings, passengers, airports):
    return (
        spark.createDataFrame(bookings, BOOKINGS),
        spark.createDataFrame(passengers, PASSENGERS),
        spark.createDataFrame(airports, AIRPORTS),
    )


def B(bid, pid, aid, amount="10.00", day="2024-01-07", fid=1):
    return (bid, pid, fid, aid, Decimal(amount), day)


def test_left_semantics(spark, cfg):
    b, p, a = frames(
        spark,
        [B(1, 10, 100), B(2, None, None), B(3, 11, 101)],
        [(10, "Ann", "F", "NL"), (10, "Ann B", "F", "BE"), (None, "Nobody", "M", "XX")],
        [(100, "Dubai Intl", "Dubai", "AE"), (None, "Null Port", "N", "N")],
    )
    obt = build_obt(b, p, a, cfg)
    assert obt.columns == OBT_COLUMNS
    rows = {(r.booking_id, r.name): r for r in obt.collect()}
    # duplicate dimension key: two wide rows for booking 1
    assert {(1, "Ann"), (1, "Ann B")} <= set(rows)
    # null key on both sides: kept, no match
    assert rows[(2, None)].airport_name is None
    # dangling key: kept, key retained, null attributes
    assert rows[(3, None)].airport_id == 101 and rows[(3, None)].airport_name is None
    assert obt.count() == 4


def test_non_key_clash_raises(spark, cfg):
    b, p, a = frames(spark, [B(1, 10, 100)], [(10, "Ann", "F", "NL")], [(100, "X", "Y", "Z")])
    with pytest.raises(ValueError, match="amount"):
        build_obt(b, p.withColumn("amount", F.lit(1)), a, cfg)


def test_salted_join_equals_broadcast_join_under_skew(spark, cfg):
    # one passenger holds a third of the bookings, another third has no key
    rows = [B(i, 7 if i % 3 == 0 else (None if i % 3 == 1 else i), 100 + i % 4) for i in range(600)]
    pax = [(7, "Hot", "F", "NL"), (7, "Hot copy", "F", "NL")] + [(i, f"P{i}", "M", "DE") for i in range(2, 600, 3)]
    b, p, _ = frames(spark, rows, pax, [])
    broadcast = left_join_dimension(b, p, "passenger_id", cfg)
    salted_cfg = cfg.with_(broadcast_max_bytes=0, hot_key_rows=50, salt_rows=25)
    salted = left_join_dimension(b, p, "passenger_id", salted_cfg)
    assert "__salt" in salted._jdf.queryExecution().optimizedPlan().toString()
    key = lambda r: tuple("" if v is None else str(v) for v in r)
    assert sorted(map(key, salted.collect())) == sorted(map(key, broadcast.collect()))
    assert salted.count() == 800  # 200 hot bookings match two passenger rows
    plain = left_join_dimension(b, p, "passenger_id", salted_cfg.with_(skew_salting=False))
    assert "__salt" not in plain._jdf.queryExecution().optimizedPlan().toString()
    assert sorted(map(key, plain.collect())) == sorted(map(key, broadcast.collect()))


def test_broadcast_needs_row_and_byte_bound(spark, cfg):
    from tarmac.operators.join import fits_broadcast

    p = spark.createDataFrame([(1, "x" * 100, "F", "NL"), (2, None, "M", "DE")], PASSENGERS)
    assert fits_broadcast(p, cfg)
    assert not fits_broadcast(p, cfg.with_(broadcast_max_rows=1))
    # 2 ids (8 B each) + 100 + 1 + 1 + 2 + 2 bytes of text = 122 bytes
    assert fits_broadcast(p, cfg.with_(broadcast_max_bytes=122))
    assert not fits_broadcast(p, cfg.with_(broadcast_max_bytes=121))


def test_salting_spreads_a_third_of_the_rows(spark, cfg):
    """One passenger holds a third of the bookings and another third has no
    key: without salting those land in two reduce tasks; salted in proportion
    to their size, no reduce partition holds more than a tenth of the rows."""
    n = 3000
    rows = [B(i, 7 if i % 3 == 0 else (None if i % 3 == 1 else i), 100) for i in range(n)]
    pax = [(7, "Hot", "F", "NL")] + [(i, f"P{i}", "M", "DE") for i in range(2, n, 3)]
    b, p, _ = frames(spark, rows, pax, [])
    keys = ("spark.sql.adaptive.enabled", "spark.sql.autoBroadcastJoinThreshold", "spark.sql.shuffle.partitions")
    saved = {k: spark.conf.get(k) for k in keys}
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.shuffle.partitions", "32")
    try:
        # 1,000 rows per hot key / 64 rows per sub-key = 16 sub-keys each
        salted_cfg = cfg.with_(broadcast_max_bytes=0, hot_key_rows=100, salt_rows=64)
        for config, limit in ((salted_cfg, n // 10), (salted_cfg.with_(hot_key_rows=10**9), None)):
            joined = left_join_dimension(b.repartition(8), p, "passenger_id", config)
            sizes = [r["count"] for r in joined.groupBy(F.spark_partition_id()).count().collect()]
            assert sum(sizes) == n
            if limit is not None:
                assert max(sizes) <= limit, sizes
            else:  # unsalted: the hot key and the null keys each sit in one task
                assert max(sizes) >= n // 3
    finally:
        for k, v in saved.items():
            spark.conf.set(k, v)


def test_extra_columns_with_dots_survive_the_join(spark, cfg):
    b, p, a = frames(spark, [B(1, 10, 100)], [(10, "Ann", "F", "NL")], [(100, "X", "Y", "Z")])
    b = b.withColumn("fare.class", F.lit("Y"))
    for c in (cfg, cfg.with_(broadcast_max_bytes=0, hot_key_rows=1)):
        row = build_obt(b, p, a, c).collect()[0]
        assert row["fare.class"] == "Y" and row["name"] == "Ann" and row["airport_name"] == "X"


def test_sub_keys_grow_with_the_key(spark, cfg):
    from tarmac.operators.join import hot_keys

    rows = [B(i, 7 if i < 500 else (None if i < 800 else i), 100) for i in range(1000)]
    b, _, _ = frames(spark, rows, [], [])
    got = {r["passenger_id"]: r["__buckets"] for r in hot_keys(b, "passenger_id", cfg.with_(hot_key_rows=100, salt_rows=50)).collect()}
    assert got == {7: 10, None: 6}


def test_every_hot_key_is_split(spark, cfg):
    """No cap: with a low threshold thousands of keys are hot, and the join stays exact whether they fit a broadcast or not."""
    from tarmac.operators.join import hot_keys, left_join_dimension

    fact = spark.range(60_000).select(F.col("id").alias("b"), (F.col("id") % 12_000).alias("k"))
    dim = spark.range(11_000).select(F.col("id").alias("k"), (F.col("id") * 3).alias("v"))
    many = cfg.with_(broadcast_max_rows=0, hot_key_rows=5, salt_rows=2)
    assert hot_keys(fact, "k", many).count() == 12_000
    for limit in (0, 1_000_000):
        got = left_join_dimension(fact, dim, "k", many if limit == 0 else many.with_(broadcast_max_bytes=0, broadcast_max_rows=limit))
        row = got.agg(F.count("*").alias("n"), F.count("v").alias("m"), F.sum("v").alias("s")).first()
        assert (row.n, row.m, row.s) == (60_000, 55_000, 5 * 3 * sum(range(11_000)))


def test_unmatched_rows_are_counted_on_the_joined_rows(spark, cfg):
    from tarmac.plans.silver import write_obt

    bookings = spark.createDataFrame(
        [(1, 10, 5, 100), (2, None, 5, 100), (3, 99, 5, None), (4, 10, 5, 101), (5, None, 5, None), (6, 11, 5, 100)],
        "booking_id bigint, passenger_id bigint, flight_id bigint, airport_id bigint",
    )
    # Passenger 10 has two rows: its bookings are two rows of the wide table each.
    passengers = spark.createDataFrame([(10, "a"), (10, "b"), (11, "c"), (None, "n")], "passenger_id bigint, name string")
    airports = spark.createDataFrame([(100, None), (None, "x")], "airport_id bigint, airport_name string")
    for small in (cfg, cfg.with_(broadcast_max_rows=0, hot_key_rows=2, salt_rows=1)):
        written, unmatched = write_obt(bookings, passengers, airports, small)
        assert written.rows == 8
        assert sorted(map(tuple, unmatched.collect())) == [("airports", 2, 2), ("passengers", 2, 1)]
        assert "__found" not in " ".join(spark.table(written.name).columns)
    _, none = write_obt(bookings.limit(0), passengers, airports, cfg)
    assert sorted(map(tuple, none.collect())) == [("airports", 0, 0), ("passengers", 0, 0)]


def test_unmatched_counts_take_no_second_scan_or_join(spark, cfg):
    from pyspark.sql import Observation

    from tarmac import registry

    src = registry.fixtures.sources(spark, "/root/testdata/sf0.001")
    plain = build_obt(src["bookings"], src["passengers"], src["airports"], cfg)
    audited = build_obt(src["bookings"], src["passengers"], src["airports"], cfg, unmatched=Observation())
    count = lambda df, word: df._jdf.queryExecution().sparkPlan().toString().count(word)
    for word in ("FileScan", "Join"):
        assert count(audited, word) == count(plain, word) > 0
    assert audited.columns == plain.columns


def test_sketched_hot_keys_equal_counted_ones_where_all_are_followed(spark, cfg):
    from tarmac.operators.join import hot_keys, sketch_hot_keys

    df = spark.range(20_000).select(
        F.when(F.col("id") % 3 == 0, None).when(F.col("id") % 3 == 1, F.lit(7)).otherwise(F.col("id")).alias("a"),
        F.concat(F.lit("k"), F.col("id") % 50).alias("b"),
    )
    config = cfg.with_(hot_key_rows=300, salt_rows=150)
    found = sketch_hot_keys(df, ["a", "b"], config)
    for key in ("a", "b"):
        assert sorted(map(tuple, found[key].collect()), key=repr) == sorted(map(tuple, hot_keys(df, key, config).collect()), key=repr)
        assert found[key].schema[key].dataType == df.schema[key].dataType
    assert sketch_hot_keys(df.limit(0), ["a"], config)["a"].collect() == []


def test_a_hot_key_that_the_sketch_misses_costs_no_row(spark, cfg, monkeypatch):
    from tarmac.operators import join

    rows = [B(i, i % 3 or None, i % 2, "1.00") for i in range(3000)]
    b, p, a = frames(spark, rows, [(1, "x", "F", "NL"), (2, "y", "M", "BE"), (2, "z", "M", "BE")], [(0, "A", "c", "k")])
    want = sorted(map(tuple, build_obt(b, p, a, cfg).collect()), key=repr)
    large = cfg.with_(broadcast_max_rows=0, hot_key_rows=10, salt_rows=100)
    for k, items in ((4096, 1 << 16), (1, 1)):
        monkeypatch.setattr(join, "SKETCH_KEYS", k)
        monkeypatch.setattr(join, "SKETCH_ITEMS", items)
        assert sorted(map(tuple, build_obt(b, p, a, large).collect()), key=repr) == want


def test_both_keys_are_sketched_in_one_scan(spark, cfg, monkeypatch):
    from tarmac.operators import join

    seen = []
    real = join.sketch_hot_keys
    monkeypatch.setattr(join, "sketch_hot_keys", lambda fact, keys, cfg: seen.append(list(keys)) or real(fact, keys, cfg))
    b, p, a = frames(spark, [B(1, 1, 1)], [(1, "x", "F", "NL")], [(1, "A", "c", "k")])
    build_obt(b, p, a, cfg.with_(broadcast_max_rows=0))
    build_obt(b, p, a, cfg)
    assert seen == [["passenger_id", "airport_id"]]
