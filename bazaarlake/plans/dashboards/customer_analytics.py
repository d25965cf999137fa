"""Customer analytics."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bazaarlake.functions.dates import age_years
from bazaarlake.functions.numbers import mean, money, percent
from bazaarlake.functions.text import label
from bazaarlake.plans.dashboards import scalars
from bazaarlake.plans.star import (
    NEVER,
    Star,
    before,
    day_key,
    high,
    low,
    orders_by,
    top,
)

# Upper age limits of the bands and their labels.
AGE_BANDS = [(24, "Under 25"), (34, "25-34"), (44, "35-44"), (54, "45-54"), (None, "55+")]


def age_band(age: Column) -> tuple[Column, Column]:
    """Label and 1-based position of the age band."""
    name = F.lit(AGE_BANDS[-1][1])
    position = F.lit(len(AGE_BANDS))
    for i, (limit, text) in reversed(list(enumerate(AGE_BANDS[:-1], start=1))):
        name = F.when(age <= limit, text).otherwise(name)
        position = F.when(age <= limit, i).otherwise(position)
    return name, position


def with_age_band(star: Star, as_of: str | None) -> DataFrame:
    """Customers with a birth date and their band on ``as_of`` (today when not given)."""
    day = F.current_date() if as_of is None else F.lit(as_of).cast("date")
    name, position = age_band(age_years(F.col("birthdate"), day))
    known = star.dim_customer.filter(F.col("birthdate").isNotNull())
    return known.withColumn("age_group", name).withColumn("age_order", position)


def per_customer_label(
    star: Star, labels: Sequence[str], customers: DataFrame | None = None
) -> DataFrame:
    dimension = star.dim_customer if customers is None else customers
    return orders_by(star, "customer_key", dimension, labels)


def cust_total(star: Star) -> DataFrame:
    return star.order_sums.customers_since(None, "total_customers")


def cust_repeat_rate_30d(star: Star, anchor: str = "calendar") -> DataFrame:
    """Share of customers with more than one order in the 30 days before the anchor, counted from
    the daily bitmaps.

    ``calendar`` is the last calendar day, which lies a year past the last order, so the answer
    is 0 in practice; ``last_order`` counts back from the last order.
    """
    if anchor == "calendar":
        last = star.dim_date.agg(F.max("full_date")).first()[0]
    else:
        last = star.last_order_date
    first = NEVER if last is None else day_key(before(last, days=30))
    counts = star.order_sums.repeated_since(first)
    rate = percent(F.col("repeated"), F.col("customers"))
    return counts.select(F.coalesce(rate, F.lit(0.0)).alias("repeat_purchase_rate"))


def cust_clv(star: Star) -> DataFrame:
    return star.fact_order.agg(
        mean(F.sum("net_order_amount"), F.count_distinct("customer_key")).alias("clv")
    )


def cust_campaign_response_rate(star: Star) -> DataFrame:
    return scalars.share_of(star.fact_order, F.col("availed_flag"), "campaign_response_rate")


def cust_top5_segments(star: Star) -> DataFrame:
    segments = per_customer_label(star, ["user_type", "job_level"])
    return top(segments, 5, high("net"), low("user_type"), low("job_level")).select(
        label(" - ", F.col("user_type"), F.col("job_level")).alias("segment"),
        money(F.col("net")).alias("revenue"),
    )


def cust_orders_by_type(star: Star) -> DataFrame:
    return (
        per_customer_label(star, ["user_type"])
        .orderBy(high("orders"), low("user_type"))
        .select(F.col("user_type").alias("customer_type"), "orders")
    )


def cust_age_groups_spend(star: Star, as_of: str | None = None) -> DataFrame:
    bands = per_customer_label(star, ["age_group"], with_age_band(star, as_of))
    return top(bands, 5, high("net"), low("age_group")).select(
        "age_group", money(F.col("net")).alias("total_spending")
    )


def cust_response_by_type(star: Star) -> DataFrame:
    return (
        per_customer_label(star, ["user_type"])
        .orderBy(high("availed"), low("user_type"))
        .select(
            F.col("user_type").alias("customer_type"),
            F.col("availed").alias("campaign_orders"),
            (F.col("orders") - F.col("availed")).alias("non_campaign_orders"),
        )
    )


def cust_top5_locations(star: Star) -> DataFrame:
    placed = star.dim_customer.filter("country is not null and city is not null")
    places = per_customer_label(star, ["country", "city"], placed)
    return top(places, 5, high("net"), low("country"), low("city")).select(
        label(", ", F.col("city"), F.col("country")).alias("location"),
        money(F.col("net")).alias("revenue"),
    )


QUERIES = [
    cust_total,
    cust_repeat_rate_30d,
    cust_clv,
    cust_campaign_response_rate,
    cust_top5_segments,
    cust_orders_by_type,
    cust_age_groups_spend,
    cust_response_by_type,
    cust_top5_locations,
]
