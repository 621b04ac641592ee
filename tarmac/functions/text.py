"""String helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def first_word(c: Column) -> Column:
    """First whitespace-separated word; null for null, empty or blank text.

    Same result as Python's ``str.split()[0]`` on ASCII whitespace.
    """
    return F.nullif(F.regexp_extract(c, r"^\s*(\S+)", 1), F.lit(""))
