"""Date parsing with an explicit bad-input policy (independent of ANSI mode)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

BOOKING_DATE_PATTERN = "yyyy-MM-dd"


def parse_date(c: Column, on_bad: str = "fail", pattern: str = BOOKING_DATE_PATTERN) -> Column:
    """``TO_DATE(c, pattern)``.

    ``on_bad="fail"`` raises on a non-null string that does not parse (what
    Spark's ANSI mode does for ``to_date``); ``"null"`` turns it into null.
    Written with ``try_to_date`` so the outcome does not depend on
    ``spark.sql.ansi.enabled``.
    """
    parsed = F.try_to_date(c, pattern)
    if on_bad == "null":
        return parsed
    if on_bad != "fail":
        raise ValueError(f"on_bad must be 'fail' or 'null', got {on_bad!r}")
    bad = parsed.isNull() & c.isNotNull()
    message = F.concat(F.lit(f"cannot parse date with pattern {pattern}: "), c)
    return F.when(bad, F.raise_error(message)).otherwise(parsed)
