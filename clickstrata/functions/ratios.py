"""Rounding and ratios as the reports print them."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def round2(value: Column) -> Column:
    """Two decimals, ties to even."""
    return F.bround(value, 2)


def percent(part: Column | str, whole: Column | str) -> Column:
    """``100 * (part / whole)``; null when there is no whole."""
    return 100 * F.try_divide(part, whole)
