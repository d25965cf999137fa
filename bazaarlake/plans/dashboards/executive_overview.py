"""Executive overview."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bazaarlake.functions.numbers import money
from bazaarlake.plans.dashboards import scalars
from bazaarlake.plans.star import (
    NEVER,
    Star,
    before,
    by_dimension,
    day_key,
    days,
    high,
    line_measures,
    low,
    orders_by,
    top,
)


def known_campaigns(star: Star) -> DataFrame:
    return star.dim_campaign.filter(~F.col("campaign_name").ilike("unknown%"))


def exec_total_revenue(star: Star) -> DataFrame:
    return scalars.total_of(star.fact_order, "net_order_amount", "total_revenue")


def exec_total_orders(star: Star) -> DataFrame:
    """The fact holds one row per order, so its rows are its distinct orders."""
    return scalars.row_count(star.fact_order, "total_orders")


def exec_aov(star: Star) -> DataFrame:
    return scalars.average_of(star.fact_order, "net_order_amount", "average_order_value")


def exec_active_customers_30d(star: Star) -> DataFrame:
    """Orders of unknown customers count as one customer. Counted from the daily bitmaps."""
    last = star.last_order_date
    first = NEVER if last is None else day_key(before(last, days=30))
    return star.order_sums.customers_since(first, "active_customers")


def exec_revenue_daily_12m(star: Star) -> DataFrame:
    daily = days(star, months=12)
    return daily.select("full_date", money(F.col("net")).alias("revenue")).orderBy("full_date")


def exec_orders_daily_12m(star: Star) -> DataFrame:
    return days(star, months=12).select("full_date", "orders").orderBy("full_date")


def exec_top5_campaigns(star: Star) -> DataFrame:
    per_campaign = orders_by(star, "campaign_key", known_campaigns(star), ["campaign_name"])
    return top(per_campaign, 5, high("net"), low("campaign_name")).select(
        "campaign_name", money(F.col("net")).alias("revenue")
    )


def top_products(star: Star, n: int) -> DataFrame:
    per_product = by_dimension(
        star.fact_order_line_item,
        "product_key",
        star.dim_product,
        ["product_name"],
        line_measures(),
    )
    return top(per_product, n, high("revenue"), low("product_name"))


def exec_top5_products(star: Star) -> DataFrame:
    return top_products(star, 5).select("product_name", money(F.col("revenue")).alias("revenue"))


def exec_top5_merchants(star: Star) -> DataFrame:
    per_merchant = orders_by(star, "merchant_key", star.dim_merchant, ["name"])
    return top(per_merchant, 5, high("net"), low("name")).select(
        F.col("name").alias("merchant"), money(F.col("net")).alias("revenue")
    )


QUERIES = [
    exec_total_revenue,
    exec_total_orders,
    exec_aov,
    exec_active_customers_30d,
    exec_revenue_daily_12m,
    exec_orders_daily_12m,
    exec_top5_campaigns,
    exec_top5_products,
    exec_top5_merchants,
]
