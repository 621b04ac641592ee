"""Column-level building blocks (all JVM-side, inside whole-stage codegen)."""

from tarmac.functions.dates import parse_date
from tarmac.functions.money import MONEY, half_up_avg, money_to_double
from tarmac.functions.ordinal import with_position
from tarmac.functions.ratios import capped_share, safe_ratio
from tarmac.functions.text import first_word

__all__ = [
    "MONEY",
    "capped_share",
    "first_word",
    "half_up_avg",
    "money_to_double",
    "parse_date",
    "safe_ratio",
    "with_position",
]
