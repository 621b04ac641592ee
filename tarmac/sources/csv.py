"""Typed CSV ingestion (bronze).

Executors parse the files; the driver only reads the header row.  Order of
work: every column read as text by header name → names normalised → missing-
value tokens turned into null → each known column cast by *name* to its type
(unknown extra columns stay text).  Casts are checked: a value that does not
fit its type (a fraction or too large a number for an integer, too many digits
for a decimal) raises instead of silently changing or becoming null, whatever
the session's ANSI setting.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (
    DataType,
    DecimalType,
    FractionalType,
    IntegralType,
    StringType,
    StructType,
)

from tarmac.schemas import SourceSpec
from tarmac.sources.ranges import largest_file, read_ranges, split_bytes
from tarmac.sources.types import infer_schema, is_number

# The strings pandas.read_csv treats as missing by default.
NA_TOKENS = (
    "",
    "#N/A",
    "#N/A N/A",
    "#NA",
    "-1.#IND",
    "-1.#QNAN",
    "-NaN",
    "-nan",
    "1.#IND",
    "1.#QNAN",
    "<NA>",
    "N/A",
    "NA",
    "NULL",
    "NaN",
    "None",
    "n/a",
    "nan",
    "null",
)

CSV_OPTIONS = {"quote": '"', "escape": '"'}


def normalize_name(name: str) -> str:
    """Header → column name: strip, lower-case, each space → ``_``.

    A UTF-8 byte-order mark in front of the first header is dropped too."""
    return name.lstrip("\ufeff").strip().lower().replace(" ", "_")


def check_header(header: list[str | None]) -> None:
    """Reject empty or duplicate headers, before and after normalisation."""
    empty = [i for i, h in enumerate(header) if h is None or not normalize_name(h)]
    if empty:
        raise ValueError(f"empty column header at position(s) {empty}")
    seen: dict[str, str] = {}
    for h in header:
        key = normalize_name(h)
        if key in seen:
            if seen[key] == h:
                raise ValueError(f"duplicate column header {h!r}")
            raise ValueError(f"headers {seen[key]!r} and {h!r} both normalise to {key!r}")
        seen[key] = h


def normalize_columns(df: DataFrame) -> DataFrame:
    """Rename every column with :func:`normalize_name`; collisions raise."""
    check_header(list(df.columns))
    return df.toDF(*[normalize_name(c) for c in df.columns])


def null_tokens(df: DataFrame, tokens: tuple[str, ...] = NA_TOKENS) -> DataFrame:
    """Every string column: a missing-value token becomes null (one projection)."""
    cols = []
    for field in df.schema.fields:
        c = F.col(f"`{field.name}`")
        if isinstance(field.dataType, StringType):
            c = F.when(c.isin(list(tokens)), F.lit(None).cast("string")).otherwise(c)
        cols.append(c.alias(field.name))
    return df.select(*cols)


def _checked_cast(name: str, dtype: DataType) -> Column:
    s = F.col(f"`{name}`")
    if isinstance(dtype, StringType):
        return s
    if isinstance(dtype, IntegralType):
        # ids may be written "1.0"; a fraction, however small, or no number raises
        value = F.when(s.rlike(r"^\s*[+-]?\d+(\.0*)?\s*$"), F.regexp_replace(s, r"\.0*\s*$", "")).try_cast(dtype)
        kind = f"an integer that fits {dtype.simpleString()}"
    elif isinstance(dtype, DecimalType):
        rounded = s.try_cast(dtype)
        digits = F.length(F.regexp_extract(s, r"\.(\d*?)0*\s*$", 1))
        # exponents have no fixed place for the point: they must survive a round trip at full scale
        whole = F.when(s.rlike("[eE]"), rounded == s.try_cast("decimal(38,18)")).otherwise(digits <= dtype.scale)
        value = F.when(whole, rounded)
        kind = f"a decimal with at most {dtype.scale} digits after the point that fits {dtype.simpleString()}"
    elif isinstance(dtype, FractionalType):
        value = F.when(is_number(s), s).try_cast(dtype)  # Java's parser would take suffixes and hexadecimal
        kind = f"a number that fits {dtype.simpleString()}"
    else:
        value = s.try_cast(dtype)
        kind = dtype.simpleString()
    bad = s.isNotNull() & value.isNull()
    message = F.concat(F.lit(f"column {name}: not {kind}: "), s)
    return F.when(bad, F.raise_error(message)).otherwise(value)


def cast_by_name(df: DataFrame, schema: StructType, source: str = "source") -> DataFrame:
    """Cast the schema's columns by name; keep file order and extra columns."""
    missing = [f.name for f in schema.fields if f.name not in df.columns]
    if missing:
        raise ValueError(f"{source}: missing column(s) {missing}; found {df.columns}")
    types = {f.name: f.dataType for f in schema.fields}
    return df.select(
        *[_checked_cast(c, types[c]).alias(c) if c in types else F.col(f"`{c}`") for c in df.columns]
    )


def read_header(spark: SparkSession, path: str, multi_line: bool = True) -> list[str | None]:
    """The header row of the first file (one record read by one task)."""
    first = (
        spark.read.options(**CSV_OPTIONS)
        .option("header", False)
        .option("multiLine", multi_line)
        .csv(path)
        .first()
    )
    if first is None:
        raise ValueError(f"{path}: no header row")
    return list(first)


def read_raw(spark: SparkSession, path: str, multi_line: bool = True) -> DataFrame:
    """All columns as text, named by the normalised header.

    With ``multi_line``, files that Spark would divide if they had no quoted line
    breaks are read by ranges (:mod:`tarmac.sources.ranges`); smaller ones are a
    task each anyway and go to Spark's own reader."""
    header = read_header(spark, path, multi_line)
    check_header(header)
    names = [normalize_name(h) for h in header]
    if multi_line and largest_file(spark, path) > split_bytes(spark):
        return read_ranges(spark, path, [h.removeprefix("\ufeff") for h in header], CSV_OPTIONS).toDF(*names)
    raw = (
        spark.read.options(**CSV_OPTIONS)
        .option("header", True)
        .option("inferSchema", False)
        # every file's header is checked against the first one: a file with
        # its columns in another order fails instead of being misaligned
        .option("enforceSchema", False)
        .option("multiLine", multi_line)
        .option("mode", "FAILFAST")
        .csv(path)
    )
    return raw.toDF(*names)


def check_quotes(spark: SparkSession, path: str) -> None:
    """Raise if a line has an odd number of quotes: its record goes on in the next line, and a split parse would tear it."""
    quotes = F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))
    torn = spark.read.text(path).where(quotes % 2 == 1).take(1)
    if torn:
        raise ValueError(f"{path}: a quoted field breaks across lines; read it with multi_line: {torn[0].value!r}")


def read_source(spark: SparkSession, spec: SourceSpec) -> DataFrame:
    """CSV files of one source → typed DataFrame (bronze contents)."""
    if not spec.multi_line:
        check_quotes(spark, spec.path)
    text = null_tokens(read_raw(spark, spec.path, spec.multi_line))
    return cast_by_name(text, infer_schema(text, spec.infer) if spec.schema is None else spec.schema, spec.name)


def write_csv(df: DataFrame, path: str) -> None:
    """Write text columns as CSV with a header (quotes doubled inside quotes)."""
    df.write.mode("overwrite").options(**CSV_OPTIONS).option("header", True).csv(path)
