"""Merchant performance."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bazaarlake.functions.numbers import mean, money, percent
from bazaarlake.plans.dashboards import scalars
from bazaarlake.plans.dashboards.delivery_logistics import mean_delay, per_merchant
from bazaarlake.plans.star import Star, high, low, top


def _merchant():
    return F.col("name").alias("merchant")


def mer_total(star: Star) -> DataFrame:
    return scalars.distinct_of(star.fact_order, "merchant_key", "total_merchants")


def mer_revenue(star: Star) -> DataFrame:
    return scalars.total_of(star.fact_order, "net_order_amount", "total_revenue")


def mer_avg_orders(star: Star) -> DataFrame:
    return scalars.orders_per(star.fact_order, "merchant_key", "avg_orders_per_merchant")


def mer_avg_delay(star: Star) -> DataFrame:
    return scalars.average_of(star.fact_order, "delay_in_days", "avg_delivery_delay")


def mer_top5_revenue(star: Star) -> DataFrame:
    return top(per_merchant(star), 5, high("net"), low("name")).select(
        _merchant(), money(F.col("net")).alias("revenue"), "orders"
    )


def mer_top5_orders(star: Star) -> DataFrame:
    return top(per_merchant(star), 5, high("orders"), low("name")).select(_merchant(), "orders")


def _regular(star: Star) -> DataFrame:
    return per_merchant(star).filter("orders >= 10").withColumn("avg_delay", mean_delay())


def mer_best_on_time(star: Star) -> DataFrame:
    return top(_regular(star), 5, low("avg_delay"), low("name")).select(
        _merchant(), "avg_delay", "orders"
    )


def mer_worst_delay(star: Star) -> DataFrame:
    return top(_regular(star), 5, high("avg_delay"), low("name")).select(
        _merchant(), "avg_delay", "orders"
    )


def mer_scorecard(star: Star) -> DataFrame:
    sums = per_merchant(star).filter("orders >= 5")
    return top(sums, 20, high("net"), low("name")).select(
        _merchant(),
        "orders",
        money(F.col("net")).alias("revenue"),
        mean(F.col("net"), F.col("orders")).alias("aov"),
        mean_delay(),
        percent(F.col("on_time"), F.col("orders")).alias("on_time_pct"),
    )


QUERIES = [
    mer_total,
    mer_revenue,
    mer_avg_orders,
    mer_avg_delay,
    mer_top5_revenue,
    mer_top5_orders,
    mer_best_on_time,
    mer_worst_delay,
    mer_scorecard,
]
