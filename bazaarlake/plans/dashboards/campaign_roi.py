"""Campaign return on investment."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bazaarlake.functions.numbers import mean, money, percent
from bazaarlake.plans.dashboards import scalars
from bazaarlake.plans.dashboards.campaign_performance import availed_orders
from bazaarlake.plans.dashboards.executive_overview import known_campaigns
from bazaarlake.plans.star import Star, by_dimension, high, low, orders_by, top
from bazaarlake.plans.sums import net_measures


def _per_known_campaign(star: Star, fact: DataFrame) -> DataFrame:
    if fact is star.fact_order:
        return orders_by(star, "campaign_key", known_campaigns(star), ["campaign_name"])
    return by_dimension(
        fact, "campaign_key", known_campaigns(star), ["campaign_name"], net_measures()
    )


def _label(width: int) -> Column:
    """Shortened for display; grouping stays on the full name."""
    return F.left(F.col("campaign_name"), F.lit(width)).alias("campaign")


def _roi(net: Column, discount: Column) -> Column:
    return percent(net - discount, discount)


def roi_revenue(star: Star) -> DataFrame:
    return scalars.total_of(availed_orders(star), "net_order_amount", "campaign_revenue")


def roi_discount_cost(star: Star) -> DataFrame:
    return scalars.total_of(availed_orders(star), "discount_amount", "total_discount_cost")


def roi_net_profit(star: Star) -> DataFrame:
    profit = F.sum("net_order_amount") - F.sum("discount_amount")
    return availed_orders(star).agg(money(profit).alias("net_campaign_profit"))


def roi_percentage(star: Star) -> DataFrame:
    """NULL when nothing was discounted."""
    roi = _roi(F.sum("net_order_amount"), F.sum("discount_amount"))
    return availed_orders(star).agg(roi.alias("campaign_roi_pct"))


def roi_aov_ranking(star: Star) -> DataFrame:
    ranked = (
        _per_known_campaign(star, availed_orders(star))
        .filter("orders >= 5")
        .withColumn("aov", mean(F.col("net"), F.col("orders")))
    )
    return top(ranked, 5, high("aov"), low("campaign_name")).select(_label(30), "aov", "orders")


def roi_conversion_funnel(star: Star) -> DataFrame:
    exposed = _per_known_campaign(star, star.fact_order).filter("orders >= 10")
    return top(exposed, 10, high("orders"), low("campaign_name")).select(
        _label(25),
        (F.col("orders") - F.col("availed")).alias("not_converted"),
        F.col("availed").alias("converted"),
    )


def roi_discount_efficiency(star: Star) -> DataFrame:
    sums = _per_known_campaign(star, star.fact_order).filter("orders >= 5")
    return top(sums, 15, high("net"), low("campaign_name")).select(
        _label(25),
        money(F.col("discount")).alias("total_discount"),
        money(F.col("net")).alias("revenue"),
        "orders",
    )


def roi_scorecard(star: Star) -> DataFrame:
    sums = _per_known_campaign(star, availed_orders(star)).filter("orders >= 5")
    return top(sums, 10, high("net"), low("campaign_name")).select(
        _label(30),
        money(F.col("net")).alias("revenue"),
        "orders",
        mean(F.col("net"), F.col("orders")).alias("aov"),
        money(F.col("discount")).alias("discount_cost"),
        _roi(F.col("net"), F.col("discount")).alias("roi_pct"),
    )


def roi_response_by_segment(star: Star) -> DataFrame:
    per_keys = (
        availed_orders(star)
        .groupBy("customer_key", "campaign_key")
        .agg(F.count("*").alias("orders"))
    )
    counts = (
        per_keys.join(known_campaigns(star), "campaign_key")
        .join(star.dim_customer.select("customer_key", "user_type"), "customer_key")
        .groupBy("user_type", "campaign_name")
        .agg(F.sum("orders").alias("orders"))
        .filter("orders >= 3")
    )
    return top(counts, 30, high("orders"), low("user_type"), low("campaign_name")).select(
        F.col("user_type").alias("customer_type"), _label(25), "orders"
    )


QUERIES = [
    roi_revenue,
    roi_discount_cost,
    roi_net_profit,
    roi_percentage,
    roi_aov_ranking,
    roi_conversion_funnel,
    roi_discount_efficiency,
    roi_scorecard,
    roi_response_by_segment,
]
