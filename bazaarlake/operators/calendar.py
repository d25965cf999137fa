"""The calendar dimension."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bazaarlake.functions.dates import date_key, iso_weekday, month_name_padded
from bazaarlake.functions.text import digits_int

EXTRA_DAYS = 365


def _range(df: DataFrame, date: Column) -> DataFrame:
    return df.select(date.cast("date").alias("_d")).agg(
        F.min("_d").alias("first"), F.max("_d").alias("last")
    )


def date_span(staging: Mapping[str, DataFrame]) -> DataFrame:
    """One row: first and last date named anywhere in the staging tables."""
    orders = staging["stg_orders"]
    arrival = F.date_add(
        "transaction_date", F.coalesce(digits_int(F.col("estimated_arrival")), F.lit(0))
    )
    ordered = orders.select("transaction_date", arrival.alias("_arrival")).agg(
        F.least(F.min("transaction_date"), F.min("_arrival")).alias("first"),
        F.greatest(F.max("transaction_date"), F.max("_arrival")).alias("last"),
    )
    created = F.col("creation_date")
    spans = [
        ordered,
        _range(staging["stg_user_data"], created),
        _range(staging["stg_merchant_data"], created),
        _range(staging["stg_staff"], created),
        _range(staging["stg_campaign_transactions"], F.col("transaction_date")),
    ]
    both = reduce(DataFrame.unionByName, spans)
    return both.agg(F.min("first").alias("first"), F.max("last").alias("last"))


def calendar_days(span: DataFrame) -> DataFrame:
    """Every day of the span and the year after it, with its attributes."""
    day = F.col("full_date")
    return span.select(
        F.explode(F.sequence("first", F.date_add("last", EXTRA_DAYS))).alias("full_date")
    ).select(
        date_key(day).cast("int").alias("date_key"),
        "full_date",
        F.day(day).alias("day"),
        F.month(day).alias("month"),
        F.year(day).alias("year"),
        month_name_padded(day).alias("month_name"),
        F.quarter(day).alias("quarter"),
        iso_weekday(day).cast("int").alias("day_of_week"),
    )


def load_dim_date(current: DataFrame, staging: Mapping[str, DataFrame]) -> DataFrame:
    """Days already there stay untouched."""
    days = calendar_days(date_span(staging))
    return current.unionByName(days.join(current, "date_key", "left_anti"))
