"""Bronze edge rows: headers, missing-value tokens, CSV dialect, checked casts."""

from __future__ import annotations

from decimal import Decimal

import pytest
from pyspark.sql.types import DecimalType, LongType, StringType, StructField, StructType

from conftest import write_text
from tarmac.schemas import BOOKINGS, PASSENGERS, SourceSpec
from tarmac.sources import csv as csv_source

TEXT = StructType([StructField("a", StringType())])


def read(spark, cfg, path, schema):
    return csv_source.read_source(spark, SourceSpec("t", path, schema))


def test_header_normalisation(spark, cfg, scratch):
    p = write_text(f"{scratch}/h.csv", " Booking ID ,Passenger Id,a  b\n1,2,x\n")
    df = csv_source.read_raw(spark, p)
    assert df.columns == ["booking_id", "passenger_id", "a__b"]


def test_header_collision_names_both(spark, scratch):
    p = write_text(f"{scratch}/c.csv", "A B,a_b\n1,2\n")
    with pytest.raises(ValueError, match="'A B'.*'a_b'"):
        csv_source.read_raw(spark, p)


@pytest.mark.parametrize("header", ["a,a", "a,"])
def test_duplicate_or_empty_header_raises(spark, scratch, header):
    p = write_text(f"{scratch}/d{len(header)}.csv", f"{header}\n1,2\n")
    with pytest.raises(ValueError):
        csv_source.read_raw(spark, p)


def test_missing_tokens_become_null(spark, cfg, scratch):
    p = write_text(f"{scratch}/t.csv", 'a\nNA\nnull\nn/a\n""\nNone\nNamibia\n\nN/A\n')
    got = [r.a for r in read(spark, cfg, p, TEXT).collect()]
    assert sorted(got, key=lambda v: (v is not None, v)) == [None] * 6 + ["Namibia"]


def test_blank_in_integer_column(spark, cfg, scratch):
    schema = StructType([StructField("id", LongType())])
    p = write_text(f"{scratch}/i.csv", "id\n1\n\n1.0\n")
    df = read(spark, cfg, p, schema)
    assert df.schema["id"].dataType == LongType()
    assert sorted(r.id for r in df.collect() if r.id is not None) == [1, 1]
    assert df.where("id IS NULL").count() <= 1


def test_quotes_commas_and_line_breaks(spark, cfg, scratch):
    p = write_text(f"{scratch}/q.csv", 'a,b\n"a ""b"" c, d","x\ny"\n')
    schema = StructType([StructField("a", StringType()), StructField("b", StringType())])
    rows = read(spark, cfg, p, schema).collect()
    assert [(r.a, r.b) for r in rows] == [('a "b" c, d', "x\ny")]


def test_columns_matched_by_name(spark, cfg, scratch):
    p = write_text(f"{scratch}/o.csv", "Name,Nationality,Gender,Passenger ID\nAnn,NL,F,7\n")
    df = read(spark, cfg, p, PASSENGERS)
    row = df.collect()[0]
    assert (row.passenger_id, row.name, row.gender, row.nationality) == (7, "Ann", "F", "NL")


def test_text_amount_raises(spark, cfg, scratch):
    p = write_text(
        f"{scratch}/x.csv",
        "booking_id,passenger_id,flight_id,airport_id,amount,booking_date\n1,1,1,1,x,2024-01-01\n",
    )
    with pytest.raises(Exception, match="not a decimal"):
        read(spark, cfg, p, BOOKINGS).collect()


def test_fractional_id_raises(spark, cfg, scratch):
    schema = StructType([StructField("id", LongType())])
    p = write_text(f"{scratch}/f.csv", "id\n1.5\n")
    with pytest.raises(Exception, match="not an integer"):
        read(spark, cfg, p, schema).collect()


def test_integer_amount_keeps_money_type(spark, cfg, scratch):
    p = write_text(
        f"{scratch}/m.csv",
        "booking_id,passenger_id,flight_id,airport_id,amount,booking_date\n1,1,1,1,3,2024-01-01\n2,1,1,1,4,2024-01-01\n",
    )
    df = read(spark, cfg, p, BOOKINGS)
    assert df.schema["amount"].dataType == DecimalType(18, 6)
    assert sorted(r.amount for r in df.collect()) == [Decimal(3), Decimal(4)]


def test_extra_columns_kept_as_text(spark, cfg, scratch):
    p = write_text(f"{scratch}/e.csv", "a,Extra Col\nq,5\n")
    df = read(spark, cfg, p, TEXT)
    assert df.columns == ["a", "extra_col"]
    assert df.schema["extra_col"].dataType == StringType()


def test_byte_order_mark_is_not_part_of_the_name(spark, scratch):
    p = write_text(f"{scratch}/bom.csv", "\ufeffBooking ID,x\n1,2\n")
    assert csv_source.read_raw(spark, p).columns == ["booking_id", "x"]


def test_files_with_different_column_order_fail(spark, cfg, scratch):
    write_text(f"{scratch}/multi/part-1.csv", "a,b\n1,2\n")
    write_text(f"{scratch}/multi/part-2.csv", "b,a\n3,4\n")
    schema = StructType([StructField("a", StringType()), StructField("b", StringType())])
    with pytest.raises(Exception, match="(?i)header"):
        read(spark, cfg, f"{scratch}/multi", schema).collect()


def test_files_with_the_same_header_are_read_together(spark, cfg, scratch):
    write_text(f"{scratch}/same/part-1.csv", "A,B\n1,2\n")
    write_text(f"{scratch}/same/part-2.csv", "A,B\n3,4\n")
    schema = StructType([StructField("a", StringType()), StructField("b", StringType())])
    assert sorted((r.a, r.b) for r in read(spark, cfg, f"{scratch}/same", schema).collect()) == [("1", "2"), ("3", "4")]


@pytest.mark.parametrize("text", ['a,b\n"x\ny",1\n', 'a,b\n1,"x\n2,y"\n3,z\n', 'a\n"x\ny"\n'])
def test_split_parse_never_tears_a_record(spark, scratch, text):
    p = write_text(f"{scratch}/torn{len(text)}.csv", text)
    assert csv_source.read_source(spark, SourceSpec("t", p, TEXT)).filter("a is not null").count() == text.count("\n") - 2
    with pytest.raises(ValueError, match="breaks across lines"):
        csv_source.read_source(spark, SourceSpec("t", p, TEXT, multi_line=False))


def test_split_parse_reads_whole_lines(spark, scratch):
    p = write_text(f"{scratch}/lines.csv", 'a,b\n"x, ""y""",1\nz,2\n')
    rows = csv_source.read_source(spark, SourceSpec("t", p, TEXT, multi_line=False)).collect()
    assert sorted((r.a, r.b) for r in rows) == [('x, "y"', "1"), ("z", "2")]


@pytest.mark.parametrize("ansi", ["true", "false"])
@pytest.mark.parametrize("bad", ["99999999999999999999", "1.0000001", "1e3", "B1", "-9223372036854775809"])
def test_ids_never_change_silently(spark, scratch, ansi, bad):
    p = write_text(f"{scratch}/id{abs(hash((ansi, bad)))}.csv", f"id\n{bad}\n")
    before = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        with pytest.raises(Exception, match="not an integer"):
            csv_source.read_source(spark, SourceSpec("t", p, StructType([StructField("id", LongType())]))).collect()
    finally:
        spark.conf.set("spark.sql.ansi.enabled", before)


def test_ids_at_the_ends_of_the_range(spark, scratch):
    p = write_text(f"{scratch}/ends.csv", "id\n9223372036854775807\n-9223372036854775808\n+5\n7.\n8.00\n")
    df = csv_source.read_source(spark, SourceSpec("t", p, StructType([StructField("id", LongType())])))
    assert sorted(r.id for r in df.collect()) == [-(2**63), 5, 7, 8, 2**63 - 1]


MONEY_ONLY = StructType([StructField("amount", DecimalType(18, 6))])


def test_amounts_keep_their_digits(spark, scratch):
    p = write_text(f"{scratch}/sub.csv", "amount\n" + "10.004\n" * 100 + "1e-3\n2.5000000000\n")
    values = [r.amount for r in csv_source.read_source(spark, SourceSpec("t", p, MONEY_ONLY)).collect()]
    assert sum(values) == Decimal("1000.4") + Decimal("0.001") + Decimal("2.5")


@pytest.mark.parametrize("bad", ["0.0000001", "1e-7", "1234567890123", "x"])
def test_amounts_that_do_not_fit_raise(spark, scratch, bad):
    p = write_text(f"{scratch}/bad{bad}.csv", f"amount\n{bad}\n")
    with pytest.raises(Exception, match="not a decimal"):
        csv_source.read_source(spark, SourceSpec("t", p, MONEY_ONLY)).collect()


def test_inferred_types(spark, scratch):
    p = write_text(f"{scratch}/inf.csv", "i,f,t,n,big\n1,1.5,B7,NA,99999999999999999999\n-2,3,8,,1\nNA,1e3,9,,2\n")
    df = csv_source.read_source(spark, SourceSpec("t", p, None))
    assert dict(df.dtypes) == {"i": "bigint", "f": "double", "t": "string", "n": "string", "big": "double"}
    assert sorted((r.i, r.f) for r in df.collect() if r.i is not None) == [(-2, 3.0), (1, 1.5)]


CODES = {
    "seat": ["10D", "11F", "12d", "1f"], "hex": ["0x1p3", "0x10", "0xA", "1"], "lead": ["007", "010", "7", "8"],
    "nan": ["Infinity", "-Infinity", "+Infinity", "1"], "dot": [".", "-", "+", "e5"], "num": ["1", "2.5", "-.5", "1e3"],
}


def columns_csv(scratch, name, columns):
    rows = [",".join(columns), *(",".join(r) for r in zip(*columns.values()))]
    return write_text(f"{scratch}/{name}.csv", "\n".join(rows) + "\n")


@pytest.mark.parametrize("mode", ["plain", "exact"])
def test_codes_are_not_numbers(spark, scratch, mode):
    p = columns_csv(scratch, f"codes-{mode}", CODES)
    df = csv_source.read_source(spark, SourceSpec("t", p, None, infer=mode))
    kinds = dict(df.dtypes)
    assert {c for c, k in kinds.items() if k == "string"} >= {"seat", "hex", "lead", "nan", "dot"}
    assert kinds["num"] == ("double" if mode == "plain" else "string")
    got = df.collect()
    for c in ("seat", "hex", "lead", "nan", "dot"):
        assert sorted(r[c] for r in got) == sorted(CODES[c])


@pytest.mark.parametrize("bad", ["10D", "1f", "0x1p3", "Infinity", ".", "1e"])
def test_a_double_of_the_caller_takes_numbers_only(spark, scratch, bad):
    from pyspark.sql.types import DoubleType

    p = write_text(f"{scratch}/dbl{bad.replace('.', '_')}.csv", f"v\n1.5\n{bad}\n")
    with pytest.raises(Exception, match="not a number"):
        csv_source.read_source(spark, SourceSpec("t", p, StructType([StructField("v", DoubleType())]))).collect()


EXACT = {
    "i": (["1", "-2", "0", "9223372036854775807"], "bigint"),
    "big": (["99999999999999999999", "1", "2", "3"], "decimal(20,0)"),
    "money": (["5.00", "-0.5", "12", "3.125"], "decimal(5,3)"),
    "sci": (["1.0E10", "2.5", "0.1", "-3.0"], "double"),
    "loss": (["0.1234567890123456789E3", "1", "2", "3"], "string"),
    "wide": (["1" * 30 + ".5", "0." + "3" * 20, "1", "2"], "string"),
    "day": (["2024-02-29", "1999-12-31", "2024-01-01", "0001-01-01"], "date"),
    "bad_day": (["2024-02-30", "1999-12-31", "2024-01-01", "2024-01-02"], "string"),
    "ok": (["true", "False", "TRUE", "false"], "boolean"),
    "plus": (["+5", "5", "6", "7"], "string"),
    "neg0": (["-0", "1", "2", "3"], "string"),
    "none": (["NA", "", "null", "None"], "string"),
}


def test_exact_types_write_every_value_back(spark, scratch):
    p = columns_csv(scratch, "exact", {c: v for c, (v, _) in EXACT.items()})
    df = csv_source.read_source(spark, SourceSpec("t", p, None, infer="exact"))
    assert dict(df.dtypes) == {c: kind for c, (_, kind) in EXACT.items()}
    rows = df.collect()
    for c, (values, kind) in EXACT.items():
        got = sorted(str(r[c]) for r in rows)
        if kind.startswith("decimal"):
            assert sorted(Decimal(v) for v in values) == sorted(r[c] for r in rows)
        elif kind not in ("boolean", "double") and c != "none":
            assert got == sorted(values)


def test_inference_reads_the_source_once(spark, scratch):
    from tarmac.sources.types import infer_schema

    df = spark.createDataFrame([("1", "x")], "a string, b string")
    assert [f.dataType.simpleString() for f in infer_schema(df, "exact")] == ["bigint", "string"]
    with pytest.raises(ValueError, match="unknown inference"):
        infer_schema(df, "guess")


def random_csv(seed, n):
    import random

    rnd = random.Random(seed)
    fields = ["a", "x y", 'say ""hi""', "l1\nl2", "\n", "", "é,ü", "cr\r\nlf", "tail\n\n", "1"]
    lines = ["Name,Note,N"]
    for i in range(n):
        cells = [rnd.choice(fields) + ("z" * rnd.randrange(40) if rnd.random() < 0.2 else "") for _ in range(2)]
        lines.append(",".join(f'"{c}"' if set(c) & set('",\n\r') or rnd.random() < 0.3 else c for c in cells) + f",{i}")
    return "\n".join(lines) + ("\n" if seed % 2 else "")


@pytest.fixture()
def ranges_of(spark):
    """Sets how many bytes a range has."""
    key = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(key)
    yield lambda n: spark.conf.set(key, str(n))
    spark.conf.set(key, before)


@pytest.mark.parametrize("size", [48, 100, 1000])
def test_ranges_read_what_one_task_per_file_reads(spark, scratch, ranges_of, size):
    folder = f"{scratch}/ranges-{size}"
    for seed in range(3):
        write_text(f"{folder}/part-{seed}.csv", random_csv(seed, 150))
    whole = sorted(map(tuple, csv_source.read_raw(spark, folder).collect()), key=repr)
    assert len(whole) == 450
    ranges_of(size)
    split = csv_source.read_raw(spark, folder)
    assert sorted(map(tuple, split.collect()), key=repr) == whole
    assert split.rdd.getNumPartitions() > 3 if size == 48 else True


def test_ranges_check_every_header_and_open_quotes(spark, scratch, ranges_of):
    write_text(f"{scratch}/heads/part-1.csv", "a,b\n" + "1,2\n" * 50)
    write_text(f"{scratch}/heads/part-2.csv", "b,a\n" + "3,4\n" * 50)
    p = write_text(f"{scratch}/open.csv", 'a,b\n1,"2\n' + "3,4\n" * 50)
    ranges_of(40)
    with pytest.raises(Exception, match="its header is"):
        csv_source.read_raw(spark, f"{scratch}/heads").collect()
    with pytest.raises(ValueError, match="left open"):
        csv_source.read_raw(spark, p)


def test_ranges_raise_on_a_torn_record(spark, scratch, ranges_of):
    p = write_text(f"{scratch}/short.csv", "a,b\n" + "1,2\n" * 50 + "1,2,3\n")
    ranges_of(40)
    with pytest.raises(Exception):
        csv_source.read_raw(spark, p).collect()


def test_a_record_longer_than_many_ranges(spark, scratch, ranges_of):
    long = "\n".join(f"line {i}" for i in range(300))
    p = write_text(f"{scratch}/long.csv", f'a,b\n1,x\n2,"{long}"\n3,"{long} ""q"""\n4,y\n')
    ranges_of(64)
    rows = sorted(map(tuple, csv_source.read_raw(spark, p).collect()))
    assert rows == [("1", "x"), ("2", long), ("3", f'{long} "q"'), ("4", "y")]


def test_ranges_stay_the_same_when_a_read_selects_fewer_files(spark, scratch, ranges_of):
    """Only one file has records that cross ranges; a core's share of the bytes is smaller without the other file."""
    rows = "".join(f'{i},"x\n{i}"\n' for i in range(400))
    write_text(f"{scratch}/some/part-1.csv", "a,b\n")
    write_text(f"{scratch}/some/part-2.csv", "a,b\n" + rows)
    key = "spark.sql.files.openCostInBytes"
    before = spark.conf.get(key)
    spark.conf.set(key, "400")
    ranges_of(3000)
    try:
        split = csv_source.read_raw(spark, f"{scratch}/some")
        ranges_of(500)  # a frame keeps the ranges that its quotes were counted in
        found = sorted(map(tuple, split.collect()))
    finally:
        spark.conf.set(key, before)
    assert found == sorted((str(i), f"x\n{i}") for i in range(400))
