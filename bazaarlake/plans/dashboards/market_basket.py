"""Market baskets."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bazaarlake.functions.numbers import percent
from bazaarlake.operators.baskets import pair_counts
from bazaarlake.plans.dashboards import scalars
from bazaarlake.plans.dashboards.bands import BASKET_SIZES, banded
from bazaarlake.plans.dashboards.executive_overview import top_products
from bazaarlake.plans.star import Star, high, low, top


def mb_avg_items(star: Star) -> DataFrame:
    return scalars.average_of(star.fact_order, "number_of_items", "avg_items_per_order")


def mb_multi_item_pct(star: Star) -> DataFrame:
    return scalars.share_of(star.fact_order, F.col("number_of_items") > 1, "multi_item_orders_pct")


def mb_cross_sell_rate(star: Star) -> DataFrame:
    """Orders without items are in neither count."""
    items = F.col("number_of_items")
    return star.fact_order.agg(
        percent(F.count_if(items > 1), F.count_if(items >= 1)).alias("cross_sell_rate_pct")
    )


def mb_avg_basket_value(star: Star) -> DataFrame:
    several = star.fact_order.filter("number_of_items > 1")
    return scalars.average_of(several, "net_order_amount", "avg_basket_value")


def mb_type_pairs(star: Star) -> DataFrame:
    typed = star.dim_product.filter("product_type is not null").select(
        "product_key", "product_type"
    )
    lines = star.fact_order_line_item.select("order_id", "product_key").join(typed, "product_key")
    pairs = pair_counts(lines, "product_type").filter("pair_count >= 5")
    return top(pairs, 20, high("pair_count"), low("label_a"), low("label_b")).select(
        F.col("label_a").alias("product_a"),
        F.col("label_b").alias("product_b"),
        F.col("pair_count").alias("times_bought_together"),
    )


def mb_product_matrix(star: Star) -> DataFrame:
    """Lines are cut down to the five best products before any pairing."""
    best = top_products(star, 5).select("product_name")
    named = star.dim_product.join(best, "product_name", "left_semi").select(
        "product_key", "product_name"
    )
    lines = star.fact_order_line_item.select("order_id", "product_key").join(named, "product_key")
    pairs = pair_counts(lines, "product_name")
    return top(pairs, 15, high("pair_count"), low("label_a"), low("label_b")).select(
        F.col("label_a").alias("product_a"),
        F.col("label_b").alias("product_b"),
        F.col("pair_count").alias("co_occurrence"),
    )


def mb_basket_sizes(star: Star) -> DataFrame:
    name, position = banded(F.col("number_of_items"), BASKET_SIZES)
    return (
        star.fact_order.groupBy(name.alias("basket_size"), position.alias("_position"))
        .agg(F.count("*").alias("order_count"))
        .orderBy("_position")
        .select("basket_size", "order_count")
    )


QUERIES = [
    mb_avg_items,
    mb_multi_item_pct,
    mb_cross_sell_rate,
    mb_avg_basket_value,
    mb_type_pairs,
    mb_product_matrix,
    mb_basket_sizes,
]
