"""Types of text columns from all their values, without changing a value.

Each column climbs a lattice of types: a type holds for the column if it holds
for each of its values, and it holds for a value if the typed value would be
written like that again.  One aggregate counts, per column, the values that each
type holds for and the widest digits seen; such states merge in any order, so
one pass over all tasks decides all columns.

``EXACT`` takes the first that holds of: boolean, bigint, decimal (of the least
scale that has room for every value), double, date, text.  ``PLAIN`` is what a
data-frame reader would choose: bigint, double, text, where a number is double
if it is no bigint.

Not numbers in either: ``10D``, ``1f``, ``0x1p3``, ``NaN``, ``Infinity`` (codes,
or spelled by no number format used here) and ``007`` (its zeros would go).  In
``EXACT`` a leading plus, an exponent form like ``1e3`` where digits would
change, and more digits than a double holds also make a column text, unless a
decimal has room; zeros after the point (``5.00``) are part of a decimal.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DataType, DateType, DecimalType, DoubleType, LongType, StringType, StructField, StructType

PLAIN, EXACT = "plain", "exact"

# Optional sign, digits without idle leading zeros, fraction, exponent.
NUMBER = r"^\s*[+-]?(0|[1-9][0-9]*|(?=\.))(\.[0-9]*)?([eE][+-]?[0-9]+)?\s*$"
INTEGER = r"^\s*[+-]?(0|[1-9][0-9]*)\s*$"
_FIXED = r"^-?(0|[1-9][0-9]*)\.[0-9]+$"
_WHOLE = r"^(0|-?[1-9][0-9]*)$"
_DAY = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}$"
_TRUTH = ("true", "false", "True", "False", "TRUE", "FALSE")
DOUBLE_DIGITS = 15  # a number of so many digits survives a double


def is_number(s: Column) -> Column:
    """Whether text spells a number: no type suffix, no hexadecimal, at least one digit."""
    return s.rlike(NUMBER) & s.rlike("[0-9]")


def as_double(s: Column) -> Column:
    return F.when(is_number(s), s).try_cast("double")


def _places(s: Column) -> tuple[Column, Column]:
    """Digits before and after the point of a plain number."""
    digits = F.length(F.regexp_extract(s, r"^-?([0-9]*)", 1))
    return digits, F.length(F.regexp_extract(s, r"\.([0-9]*)$", 1))


def _states(name: str, mode: str) -> dict[str, Column]:
    s = F.col(f"`{name}`")

    def held(test: Column) -> Column:
        return F.count(F.when(test, 1))

    if mode == PLAIN:
        whole = F.when(s.rlike(INTEGER), s).try_cast("bigint").isNotNull()
        return {"n": F.count(s), "bigint": held(whole), "double": held(as_double(s).isNotNull())}
    fixed = s.rlike(_FIXED) | s.rlike(_WHOLE)
    before, after = _places(F.when(fixed, s))
    # Digits that count: without sign, point, exponent and the zeros around them.
    digits = F.length(F.regexp_replace(F.regexp_replace(s, r"^[+-]?[0.]*|[eE].*$|\.", ""), r"0*$", ""))
    value = as_double(s)
    finite = value.isNotNull() & (F.abs(value) != F.lit(float("inf"))) & ((value != 0) | ~s.rlike("[1-9].*[eE]|[1-9]"))
    written = s.rlike(_FIXED) | s.rlike(_WHOLE) | (value.cast("string") == s)
    return {
        "n": F.count(s),
        "boolean": held(s.isin(*_TRUTH)),
        "bigint": held(s.rlike(_WHOLE) & s.try_cast("bigint").isNotNull()),
        "decimal": held(fixed),
        "before": F.max(before),
        "after": F.max(after),
        "double": held(written & finite & (digits <= DOUBLE_DIGITS)),
        "date": held(s.rlike(_DAY) & (s.try_cast("date").cast("string") == s)),
    }


def _decided(seen: dict[str, int], mode: str) -> DataType:
    n = seen["n"]
    if not n:
        return StringType()
    if mode == PLAIN:
        kinds = {"bigint": LongType(), "double": DoubleType()}
        return next((t for k, t in kinds.items() if seen[k] == n), StringType())
    if seen["boolean"] == n:
        return BooleanType()
    if seen["bigint"] == n:
        return LongType()
    if seen["decimal"] == n and seen["before"] + seen["after"] <= 38:
        return DecimalType(max(1, seen["before"] + seen["after"]), seen["after"])
    if seen["double"] == n:
        return DoubleType()
    return DateType() if seen["date"] == n else StringType()


def infer_schema(df: DataFrame, mode: str = PLAIN) -> StructType:
    """The type of each text column of ``df`` (one aggregate, one row of counts to the driver; all null is text)."""
    if mode not in (PLAIN, EXACT):
        raise ValueError(f"unknown inference {mode!r}")
    states = {c: _states(c, mode) for c in df.columns}
    names = [(c, k) for c in df.columns for k in states[c]]
    seen = df.agg(*(states[c][k].alias(f"{at}") for at, (c, k) in enumerate(names))).first()
    by_column: dict[str, dict[str, int]] = {c: {} for c in df.columns}
    for at, (c, k) in enumerate(names):
        by_column[c][k] = seen[at] or 0
    return StructType([StructField(c, _decided(by_column[c], mode)) for c in df.columns])
