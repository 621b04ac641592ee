"""Ratios and shares."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def safe_ratio(numerator: Column, denominator: Column) -> Column:
    """``numerator / denominator`` as double; null when the divisor is 0 or null."""
    return F.try_divide(numerator.cast("double"), denominator.cast("double"))


def capped_share(value: Column, maximum: Column) -> Column:
    """Percent of the maximum, capped at 100: ``min(100, v / m * 100)``.

    A maximum of 0 (or null) counts as 1, so the share is then 0 and never an
    error.  A null value gives a null share.
    """
    divisor = F.coalesce(F.nullif(maximum.cast("double"), F.lit(0.0)), F.lit(1.0))
    pct = value.cast("double") / divisor * F.lit(100.0)
    return F.when(pct > F.lit(100.0), F.lit(100.0)).otherwise(pct)
