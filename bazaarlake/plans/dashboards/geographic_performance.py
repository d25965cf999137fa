"""Geographic performance."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bazaarlake.functions.numbers import money
from bazaarlake.functions.text import label
from bazaarlake.plans.dashboards import scalars
from bazaarlake.plans.dashboards.customer_analytics import per_customer_label
from bazaarlake.plans.dashboards.delivery_logistics import (
    delay_by_month,
    mean_delay,
    per_country,
)
from bazaarlake.plans.star import Star, high, low, top


def _buyer_places(star: Star, column: str) -> DataFrame:
    """The column for customers with orders; each customer once."""
    buyers = star.order_sums.by("customer_key").select("customer_key")
    return star.dim_customer.join(buyers, "customer_key", "left_semi").select(column)


def geo_countries(star: Star) -> DataFrame:
    return scalars.distinct_of(_buyer_places(star, "country"), "country", "total_countries")


def geo_cities(star: Star) -> DataFrame:
    """Cities of the same name in two countries count once."""
    return scalars.distinct_of(_buyer_places(star, "city"), "city", "total_cities")


def geo_avg_delay(star: Star) -> DataFrame:
    return scalars.average_of(star.fact_order, "delay_in_days", "avg_delay")


def geo_on_time_pct(star: Star) -> DataFrame:
    return scalars.share_of(star.fact_order, F.col("delay_in_days") <= 0, "on_time_pct")


def geo_top5_countries(star: Star) -> DataFrame:
    return top(per_country(star), 5, high("net"), low("country")).select(
        "country", money(F.col("net")).alias("revenue")
    )


def geo_top10_cities(star: Star) -> DataFrame:
    placed = star.dim_customer.filter("city is not null")
    cities = per_customer_label(star, ["city", "country"], placed)
    return top(cities, 10, high("net"), low("city"), low("country")).select(
        "city", "country", money(F.col("net")).alias("revenue")
    )


def geo_top10_delay(star: Star) -> DataFrame:
    delays = per_country(star).withColumn("avg_delay", mean_delay())
    return top(delays, 10, high("avg_delay"), low("country")).select(
        "country", "avg_delay", "orders"
    )


def geo_delay_monthly_12m(star: Star) -> DataFrame:
    return delay_by_month(star).select(
        label(" ", F.col("month_name"), F.col("year")).alias("month"), mean_delay()
    )


QUERIES = [
    geo_countries,
    geo_cities,
    geo_avg_delay,
    geo_on_time_pct,
    geo_top5_countries,
    geo_top10_cities,
    geo_top10_delay,
    geo_delay_monthly_12m,
]
