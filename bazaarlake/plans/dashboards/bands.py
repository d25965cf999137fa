"""Display bands over numbers. Limits and labels as the dashboards show them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# (first, last, label); a missing end is open, and the final label takes everything else.
DELAY_DAYS = [
    (None, -1, "Early Delivery"),
    (0, 0, "On-Time"),
    (1, 3, "1-3 Days Late"),
    (4, 7, "4-7 Days Late"),
    (8, 14, "8-14 Days Late"),
    (None, None, "15+ Days Late"),
]
BASKET_SIZES = [
    (1, 1, "1 item"),
    (2, 2, "2 items"),
    (3, 3, "3 items"),
    (4, 5, "4-5 items"),
    (6, 10, "6-10 items"),
    (None, None, "11+ items"),
]


def banded(value: Column, bands: Sequence[tuple]) -> tuple[Column, Column]:
    """Label and 1-based position of the first band that holds the value."""
    name, position = F.lit(bands[-1][2]), F.lit(len(bands))
    for i, (first, last, text) in reversed(list(enumerate(bands[:-1], start=1))):
        inside = F.lit(True)
        if first is not None:
            inside = inside & (value >= first)
        if last is not None:
            inside = inside & (value <= last)
        name = F.when(inside, text).otherwise(name)
        position = F.when(inside, i).otherwise(position)
    return name, position


def mean_delay_band(total: Column, count: Column, early: str) -> Column:
    """Band of total / count, compared without dividing.

    A mean between two bands (0 to 1, 3 to 4) or above 7 falls to the last one, as the
    dashboards have it.
    """
    return (
        F.when(total < 0, early)
        .when(total == 0, "On-Time")
        .when((total >= count) & (total <= 3 * count), "1-3 Days Late")
        .when((total >= 4 * count) & (total <= 7 * count), "4-7 Days Late")
        .otherwise("8+ Days Late")
    )
