"""Delivery and logistics."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bazaarlake.functions.numbers import mean
from bazaarlake.plans.dashboards import scalars
from bazaarlake.plans.dashboards.bands import DELAY_DAYS, banded, mean_delay_band
from bazaarlake.plans.dashboards.customer_analytics import per_customer_label
from bazaarlake.plans.star import (
    Star,
    days,
    high,
    low,
    orders_by,
    top,
)


def mean_delay():
    return mean(F.col("delay"), F.col("orders")).alias("avg_delay")


def per_merchant(star: Star) -> DataFrame:
    return orders_by(star, "merchant_key", star.dim_merchant, ["name"])


def per_country(star: Star) -> DataFrame:
    placed = star.dim_customer.filter("country is not null")
    return per_customer_label(star, ["country"], placed)


def delay_by_month(star: Star) -> DataFrame:
    return (
        days(star, months=12)
        .groupBy("year", "month", "month_name")
        .agg(F.sum("delay").alias("delay"), F.sum("orders").alias("orders"))
        .orderBy("year", "month")
    )


def delay_per_customer(star: Star) -> DataFrame:
    return star.order_sums.by("customer_key").select("customer_key", "delay", "orders")


def dlv_on_time_pct(star: Star) -> DataFrame:
    return scalars.share_of(star.fact_order, F.col("delay_in_days") <= 0, "on_time_pct")


def dlv_avg_delay(star: Star) -> DataFrame:
    return scalars.average_of(star.fact_order, "delay_in_days", "avg_delay")


def dlv_delayed_orders(star: Star) -> DataFrame:
    return scalars.row_count(star.fact_order.filter("delay_in_days > 0"), "orders_with_delays")


def dlv_worst_delay(star: Star) -> DataFrame:
    return star.fact_order.agg(F.max("delay_in_days").alias("max_delay"))


def dlv_monthly_trend_12m(star: Star) -> DataFrame:
    return delay_by_month(star).select("year", "month", "month_name", mean_delay())


def dlv_top5_merchants_delay(star: Star) -> DataFrame:
    delays = per_merchant(star).filter("orders >= 10").withColumn("avg_delay", mean_delay())
    return top(delays, 5, high("avg_delay"), low("name")).select(
        F.col("name").alias("merchant"), "avg_delay", "orders"
    )


def dlv_delay_by_country(star: Star) -> DataFrame:
    delays = per_country(star).withColumn("avg_delay", mean_delay())
    return top(delays, 15, high("avg_delay"), low("country")).select(
        "country", "avg_delay", "orders"
    )


def dlv_repeat_vs_delay(star: Star) -> DataFrame:
    band = mean_delay_band(F.col("delay"), F.col("orders"), "Early")
    return (
        delay_per_customer(star)
        .filter("orders >= 2")
        .groupBy(band.alias("delay_category"))
        .agg(
            F.count("*").alias("repeat_customers"),
            mean(F.sum("orders"), F.count("*")).alias("avg_orders"),
        )
        .orderBy(high("avg_orders"), low("delay_category"))
    )


def dlv_delay_distribution(star: Star) -> DataFrame:
    name, position = banded(F.col("delay_in_days"), DELAY_DAYS)
    return (
        star.fact_order.groupBy(name.alias("delay_range"), position.alias("_position"))
        .agg(F.count("*").alias("order_count"))
        .orderBy("_position")
        .select("delay_range", "order_count")
    )


QUERIES = [
    dlv_on_time_pct,
    dlv_avg_delay,
    dlv_delayed_orders,
    dlv_worst_delay,
    dlv_monthly_trend_12m,
    dlv_top5_merchants_delay,
    dlv_delay_by_country,
    dlv_repeat_vs_delay,
    dlv_delay_distribution,
]
