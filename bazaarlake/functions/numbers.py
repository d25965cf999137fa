"""Exact sums, averages and percentages.

Money stays decimal(18,2) until the last step. Averages are sum / count in decimal arithmetic,
rounded half away from zero, and only the finished number becomes a double.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_WIDE = "decimal(28,2)"


def money(total: Column) -> Column:
    return total.cast("double")


def quotient(numerator: Column, denominator: Column, places: int = 2) -> Column:
    """numerator / denominator rounded to ``places``; NULL for a zero denominator."""
    below = denominator.cast(_WIDE)
    exact = F.round(numerator.cast(_WIDE) / below, places)
    return F.when(below != 0, exact).cast("double")


def percent(part: Column, whole: Column, places: int = 2) -> Column:
    return quotient(part.cast(_WIDE) * 100, whole, places)


def mean(total: Column, count: Column, places: int = 2) -> Column:
    return quotient(total, count, places)
