"""Campaign performance."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bazaarlake.functions.numbers import mean, money
from bazaarlake.plans.dashboards import scalars
from bazaarlake.plans.star import Star, by_dimension, high, low, orders_by, top, trailing
from bazaarlake.plans.sums import net_measures


def availed_orders(star: Star) -> DataFrame:
    return star.fact_order.filter("availed_flag")


def per_campaign(star: Star, fact: DataFrame | None = None) -> DataFrame:
    if fact is None or fact is star.fact_order:
        return orders_by(star, "campaign_key", star.dim_campaign, ["campaign_name"])
    return by_dimension(
        fact, "campaign_key", star.dim_campaign, ["campaign_name"], net_measures()
    )


def camp_revenue(star: Star) -> DataFrame:
    return scalars.total_of(availed_orders(star), "net_order_amount", "campaign_revenue")


def camp_conversion_rate(star: Star) -> DataFrame:
    return scalars.share_of(star.fact_order, F.col("availed_flag"), "conversion_rate")


def camp_discount_total(star: Star) -> DataFrame:
    return scalars.total_of(availed_orders(star), "discount_amount", "total_discount")


def camp_aov(star: Star) -> DataFrame:
    return scalars.average_of(availed_orders(star), "net_order_amount", "campaign_aov")


def camp_top5_revenue(star: Star) -> DataFrame:
    return top(per_campaign(star), 5, high("net"), low("campaign_name")).select(
        "campaign_name", money(F.col("net")).alias("revenue")
    )


def camp_top5_orders(star: Star) -> DataFrame:
    return top(per_campaign(star), 5, high("orders"), low("campaign_name")).select(
        "campaign_name", "orders"
    )


def camp_discount_vs_revenue(star: Star) -> DataFrame:
    return per_campaign(star).orderBy(high("net"), low("campaign_name")).select(
        "campaign_name",
        mean(F.col("discount"), F.col("orders"), 6).alias("avg_discount"),
        money(F.col("net")).alias("revenue"),
        "orders",
    )


def top_campaign_names(star: Star, fact: DataFrame) -> DataFrame:
    best = top(per_campaign(star, fact), 5, high("net"), low("campaign_name"))
    return best.select("campaign_name")


def top_campaign_days(star: Star, fact: DataFrame) -> DataFrame:
    """Net per day and campaign, last 12 months, for the five best campaigns of ``fact``."""
    recent = trailing(star, months=12)
    if fact is not star.fact_order:
        recent = recent.filter("availed_flag")
    chosen = star.dim_campaign.join(top_campaign_names(star, fact), "campaign_name", "left_semi")
    sums = recent.groupBy("transaction_date_key", "campaign_key").agg(
        F.sum("net_order_amount").alias("net")
    )
    return sums.join(chosen, "campaign_key").join(
        star.dim_date, F.col("transaction_date_key") == F.col("date_key")
    )


def camp_trend_top5_12m(star: Star) -> DataFrame:
    days = top_campaign_days(star, star.fact_order)
    return (
        days.groupBy("full_date", "campaign_name")
        .agg(F.sum("net").alias("net"))
        .orderBy("full_date", high("net"), low("campaign_name"))
        .select("full_date", "campaign_name", money(F.col("net")).alias("revenue"))
    )


QUERIES = [
    camp_revenue,
    camp_conversion_rate,
    camp_discount_total,
    camp_aov,
    camp_top5_revenue,
    camp_top5_orders,
    camp_discount_vs_revenue,
    camp_trend_top5_12m,
]
