"""Exact money arithmetic.

Amounts are ``decimal(18,6)`` from ingestion to the last aggregate, so sums and
extremes are exact and independent of row order; ingestion raises for an amount
that does not fit.  Outputs are rounded once, half-up, to two decimals and are
the nearest double to that.  Averages are rounded half-up from the
exact quotient ``sum / count`` (no intermediate rounding to a fixed scale), the
same rule as ``ROUND(x, 2)`` applied to the true mean.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

SCALE = 6
MONEY = DecimalType(18, SCALE)


def money_to_double(c: Column) -> Column:
    """Exact amount → its two-decimal rounding (half-up) as a double."""
    return F.round(c, 2).cast("double")


def half_up_avg(sum_col: str, count_col: str) -> Column:
    """``ROUND(sum / count, 2)`` half-up, exact, as double; null when count is 0.

    ``sum_col`` holds a decimal sum of scale ``SCALE``, ``count_col`` the number
    of non-null amounts.  With ``u`` the sum in units of the last digit and
    ``m = n * 10**(SCALE - 2)``, the rounded mean in cents is
    ``sign(u) * ((2|u| + m) div 2m)``, computed with integral decimal division,
    so no digit is lost for any group size.
    """
    s, n = f"`{sum_col}`", f"`{count_col}`"
    units = f"CAST({s} * {10**SCALE} AS DECIMAL(38,0))"
    per = f"(nullif({n}, 0) * {10 ** (SCALE - 2)})"
    return F.expr(f"CAST(signum({s}) * ((2 * abs({units}) + {per}) div (2 * {per})) AS DOUBLE) / 100D")
