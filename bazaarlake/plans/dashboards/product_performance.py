"""Product performance."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bazaarlake.functions.numbers import money
from bazaarlake.plans.dashboards import scalars
from bazaarlake.plans.dashboards.executive_overview import top_products
from bazaarlake.plans.star import Star, by_dimension, high, line_measures, low, top


def _typed(star: Star) -> DataFrame:
    return star.dim_product.filter("product_type is not null")


def _lines_by_campaign_use(star: Star) -> DataFrame:
    """Per product type, revenue and line count with and without a campaign on the order."""
    lines = star.fact_order_line_item.select("order_id", "product_key", "line_total_amount")
    flagged = lines.join(star.fact_order.select("order_id", "availed_flag"), "order_id")
    used = F.col("availed_flag")
    amount = F.col("line_total_amount")
    zero = F.lit(0).cast("decimal(18,2)")
    return by_dimension(
        flagged,
        "product_key",
        _typed(star),
        ["product_type"],
        [
            F.sum(amount).alias("revenue"),
            F.sum(F.when(used, amount).otherwise(zero)).alias("campaign_revenue"),
            F.sum(F.when(~used, amount).otherwise(zero)).alias("other_revenue"),
            F.count_if(used).alias("campaign_sales"),
            F.count_if(~used).alias("regular_sales"),
        ],
    )


def prod_total(star: Star) -> DataFrame:
    return scalars.distinct_of(star.fact_order_line_item, "product_key", "total_products")


def prod_units(star: Star) -> DataFrame:
    return scalars.units_of(star.fact_order_line_item, "quantity", "total_units_sold")


def prod_revenue(star: Star) -> DataFrame:
    return scalars.total_of(star.fact_order_line_item, "line_total_amount", "total_revenue")


def prod_avg_unit_price(star: Star) -> DataFrame:
    """Over lines, not weighted by quantity."""
    return scalars.average_of(star.fact_order_line_item, "unit_price", "avg_unit_price")


def prod_top5_revenue(star: Star) -> DataFrame:
    return top_products(star, 5).select("product_name", money(F.col("revenue")).alias("revenue"))


def prod_revenue_by_type(star: Star) -> DataFrame:
    return (
        by_dimension(
            star.fact_order_line_item,
            "product_key",
            _typed(star),
            ["product_type"],
            line_measures(),
        )
        .orderBy(high("revenue"), low("product_type"))
        .select("product_type", money(F.col("revenue")).alias("revenue"))
    )


def prod_campaign_impact(star: Star) -> DataFrame:
    sums = _lines_by_campaign_use(star)
    return top(sums, 10, high("revenue"), low("product_type")).select(
        F.left("product_type", F.lit(10)).alias("product_type"),
        money(F.col("campaign_revenue")).alias("campaign_revenue"),
        money(F.col("other_revenue")).alias("non_campaign_revenue"),
    )


def prod_high_volume_low_revenue(star: Star) -> DataFrame:
    sums = by_dimension(
        star.fact_order_line_item,
        "product_key",
        star.dim_product,
        ["product_name"],
        line_measures(),
    ).filter("units >= 10")
    return top(sums, 5, high("units"), low("revenue"), low("product_name")).select(
        F.left("product_name", F.lit(25)).alias("product_name"),
        F.col("units").alias("volume"),
        money(F.col("revenue")).alias("revenue"),
    )


def prod_types_under_campaigns(star: Star) -> DataFrame:
    return (
        _lines_by_campaign_use(star)
        .orderBy(high("campaign_sales"), low("product_type"))
        .select(
            F.left("product_type", F.lit(15)).alias("product_type"),
            "campaign_sales",
            "regular_sales",
        )
    )


QUERIES = [
    prod_total,
    prod_units,
    prod_revenue,
    prod_avg_unit_price,
    prod_top5_revenue,
    prod_revenue_by_type,
    prod_campaign_impact,
    prod_high_volume_low_revenue,
    prod_types_under_campaigns,
]
