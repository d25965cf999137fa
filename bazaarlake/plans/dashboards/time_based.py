"""Time-based analysis."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bazaarlake.functions.dates import year_month
from bazaarlake.functions.numbers import mean, money, percent
from bazaarlake.functions.text import label
from bazaarlake.plans.dashboards import scalars
from bazaarlake.plans.dashboards.campaign_performance import availed_orders, top_campaign_days
from bazaarlake.plans.star import Star, days, trailing


def _growth(now: Column, before: Column) -> Column:
    return F.coalesce(percent(now - before, before), F.lit(0.0))


def _net_of_periods(star: Star, period: Column) -> DataFrame:
    """One row: ``net_of`` maps a period to its revenue; years and months stay few."""
    periods = (
        days(star)
        .groupBy(period.alias("period"))
        .agg(F.sum("net").cast("decimal(28,2)").alias("net"), F.max("month").alias("month"))
    )
    return periods.agg(
        F.map_from_entries(F.collect_list(F.struct("period", "net"))).alias("net_of"),
        F.max("period").alias("latest"),
        F.max("month").alias("max_month"),
    )


def time_yoy_growth(star: Star) -> DataFrame:
    nets = _net_of_periods(star, F.col("year"))
    now = F.try_element_at("net_of", F.col("latest"))
    before = F.try_element_at("net_of", F.col("latest") - 1)
    return nets.select(_growth(now, before).alias("yoy_growth_pct"))


def time_mom_growth(star: Star, anchor: str = "max_month") -> DataFrame:
    """Growth of the current month over the one before.

    By default the month is the highest month number of any year, put together with the last
    year, so it is December once any December has orders. ``last_order`` takes the month of the
    last order.
    """
    nets = _net_of_periods(star, F.col("year") * 100 + F.col("month"))
    last_year = F.floor(F.col("latest") / 100).cast("int")
    month = F.col("max_month") if anchor == "max_month" else F.col("latest") % 100
    current = last_year * 100 + month
    previous = F.when(month == 1, (last_year - 1) * 100 + 12).otherwise(current - 1)
    now = F.try_element_at("net_of", current)
    before = F.try_element_at("net_of", previous)
    return nets.select(_growth(now, before).alias("mom_growth_pct"))


def time_rev_30d(star: Star) -> DataFrame:
    recent = trailing(star, days=30)
    return scalars.total_of(recent, "net_order_amount", "current_month_revenue")


def time_orders_30d(star: Star) -> DataFrame:
    return scalars.row_count(trailing(star, days=30), "current_month_orders")


def _monthly(star: Star, months: int) -> DataFrame:
    return (
        days(star, months)
        .groupBy(year_month(F.col("full_date")).alias("year_month"), "month_name", "year")
        .agg(F.sum("net").alias("net"), F.sum("orders").alias("orders"))
        .withColumn("period", label(" ", F.col("month_name"), F.col("year")))
        .orderBy("year_month")
    )


def time_revenue_monthly_24m(star: Star) -> DataFrame:
    return _monthly(star, 24).select(
        "year_month", "period", money(F.col("net")).alias("revenue")
    )


def time_orders_daily_12m(star: Star) -> DataFrame:
    return days(star, months=12).select("full_date", "orders").orderBy("full_date")


def time_aov_monthly_12m(star: Star) -> DataFrame:
    return _monthly(star, 12).select(
        "year_month", "period", mean(F.col("net"), F.col("orders")).alias("average_order_value")
    )


def time_seasonality(star: Star) -> DataFrame:
    return (
        days(star)
        .groupBy("month_name", F.col("month").alias("month_num"))
        .agg(F.sum("orders").alias("orders"))
        .orderBy("month_num")
    )


def time_campaign_by_period(star: Star) -> DataFrame:
    best = top_campaign_days(star, availed_orders(star))
    return (
        best.groupBy(year_month(F.col("full_date")).alias("period"), "campaign_name")
        .agg(money(F.sum("net")).alias("revenue"))
        .orderBy("period", "campaign_name")
    )


QUERIES = [
    time_yoy_growth,
    time_mom_growth,
    time_rev_30d,
    time_orders_30d,
    time_revenue_monthly_24m,
    time_orders_daily_12m,
    time_aov_monthly_12m,
    time_seasonality,
    time_campaign_by_period,
]
