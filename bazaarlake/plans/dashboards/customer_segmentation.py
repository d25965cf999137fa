"""Customer segmentation. A segment is user type and job level."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bazaarlake.functions.numbers import mean, money, percent, quotient
from bazaarlake.functions.text import label
from bazaarlake.plans.dashboards.customer_analytics import per_customer_label, with_age_band
from bazaarlake.plans.star import Star, high, low, top

SEGMENT = ["user_type", "job_level"]


def _segmented(star: Star) -> DataFrame:
    return star.dim_customer.filter("user_type is not null and job_level is not null")


def _short(star: Star) -> DataFrame:
    joined = label("-", F.col("user_type"), F.col("job_level"))
    return _segmented(star).withColumn("segment", joined)


def _segments(star: Star) -> DataFrame:
    return per_customer_label(star, SEGMENT, _segmented(star))


def _name():
    return label(" - ", F.col("user_type"), F.col("job_level")).alias("segment")


def _buyers(star: Star) -> DataFrame:
    """Order count per customer, with segments."""
    counts = star.order_sums.by("customer_key").select("customer_key", "orders")
    return counts.join(_short(star), "customer_key")


def seg_total(star: Star) -> DataFrame:
    return _buyers(star).agg(F.count_distinct("segment").alias("total_segments"))


def seg_diversity_index(star: Star) -> DataFrame:
    sizes = _buyers(star).groupBy("segment").agg(F.count("*").cast("decimal(18,0)").alias("n"))
    return sizes.agg(
        quotient(
            F.sum(F.col("n") * F.col("n")),
            F.sum("n").cast("decimal(18,0)") * F.sum("n").cast("decimal(18,0)"),
            4,
        ).alias("diversity_index")
    )


def seg_top_revenue(star: Star) -> DataFrame:
    segments = per_customer_label(star, ["segment"], _short(star))
    return top(segments, 1, high("net"), low("segment")).select(
        money(F.col("net")).alias("top_segment_revenue")
    )


def seg_top_orders(star: Star) -> DataFrame:
    segments = per_customer_label(star, ["segment"], _short(star))
    return top(segments, 1, high("orders"), low("segment")).select(
        F.col("orders").alias("top_segment_orders")
    )


def seg_aov_ranking(star: Star) -> DataFrame:
    ranked = (
        _segments(star)
        .filter("orders >= 10")
        .withColumn("aov", mean(F.col("net"), F.col("orders")))
    )
    return top(ranked, 5, high("aov"), low("user_type"), low("job_level")).select(
        _name(), "aov", "orders"
    )


def seg_campaign_usage(star: Star) -> DataFrame:
    used = (
        _segments(star)
        .filter("orders >= 10")
        .withColumn("campaign_usage_pct", percent(F.col("availed"), F.col("orders")))
    )
    return top(used, 15, high("campaign_usage_pct"), low("user_type"), low("job_level")).select(
        _name(), "campaign_usage_pct", F.col("orders").alias("total_orders")
    )


def seg_repeat_rate(star: Star) -> DataFrame:
    name = label(" - ", F.col("user_type"), F.col("job_level"))
    return (
        _buyers(star)
        .groupBy(name.alias("segment"))
        .agg(
            percent(F.count_if(F.col("orders") > 1), F.count("*")).alias("repeat_rate_pct"),
            F.count("*").alias("customers"),
        )
        .filter("customers >= 10")
        .orderBy(high("repeat_rate_pct"), low("segment"))
    )


def seg_matrix(star: Star) -> DataFrame:
    sums = _segments(star).filter("orders >= 10")
    return top(sums, 10, high("net"), low("user_type"), low("job_level")).select(
        _name(),
        money(F.col("net")).alias("revenue"),
        "orders",
        mean(F.col("net"), F.col("orders")).alias("aov"),
    )


def seg_age_gender(star: Star, as_of: str | None = None) -> DataFrame:
    banded = with_age_band(star, as_of).filter(F.col("gender").isNotNull())
    return (
        per_customer_label(star, ["age_group", "age_order", "gender"], banded)
        .orderBy("age_order", low("gender"))
        .select(
            "age_group", "age_order", "gender", "orders", money(F.col("net")).alias("revenue")
        )
    )


QUERIES = [
    seg_total,
    seg_diversity_index,
    seg_top_revenue,
    seg_top_orders,
    seg_aov_ranking,
    seg_campaign_usage,
    seg_repeat_rate,
    seg_matrix,
    seg_age_gender,
]
