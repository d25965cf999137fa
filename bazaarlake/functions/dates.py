"""Dates, integer date keys, ages."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def date_key(date: Column) -> Column:
    """Date as the integer yyyyMMdd."""
    return F.year(date) * 10000 + F.month(date) * 100 + F.day(date)


def key_date(key: Column) -> Column:
    """Integer yyyyMMdd as a date."""
    return F.make_date(
        F.floor(key / 10000).cast("int"), F.floor(key / 100).cast("int") % 100, key % 100
    )


def month_name_padded(date: Column) -> Column:
    """English month name padded with blanks to nine characters."""
    return F.rpad(F.date_format(date, "MMMM"), 9, " ")


def iso_weekday(date: Column) -> Column:
    """1 = Monday ... 7 = Sunday."""
    return F.weekday(date) + 1


def age_years(birthdate: Column, as_of: Column) -> Column:
    """Completed years."""
    birthday_passed = F.date_format(as_of, "MMdd") >= F.date_format(birthdate, "MMdd")
    return F.year(as_of) - F.year(birthdate) - F.when(birthday_passed, 0).otherwise(1)


def year_month(date: Column) -> Column:
    return F.date_format(date, "yyyy-MM")
