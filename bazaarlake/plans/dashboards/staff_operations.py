"""Staff and operations."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bazaarlake.functions.numbers import mean, money
from bazaarlake.plans.dashboards import scalars
from bazaarlake.plans.dashboards.bands import mean_delay_band
from bazaarlake.plans.dashboards.delivery_logistics import delay_per_customer
from bazaarlake.plans.star import Star, high, low, orders_by, top


def _per_staff(star: Star, labels: Sequence[str], needed: str | None = None) -> DataFrame:
    staff = star.dim_staff if needed is None else star.dim_staff.filter(f"{needed} is not null")
    return orders_by(star, "staff_key", staff, labels)


def staff_total(star: Star) -> DataFrame:
    return scalars.distinct_of(star.fact_order, "staff_key", "total_staff")


def staff_orders(star: Star) -> DataFrame:
    return scalars.row_count(star.fact_order, "total_orders_processed")


def staff_revenue(star: Star) -> DataFrame:
    return scalars.total_of(star.fact_order, "net_order_amount", "revenue_generated")


def staff_avg_orders(star: Star) -> DataFrame:
    return scalars.orders_per(star.fact_order, "staff_key", "avg_orders_per_staff")


def staff_top15(star: Star) -> DataFrame:
    return top(_per_staff(star, ["name"]), 15, high("orders"), low("name")).select(
        F.col("name").alias("staff_name"), "orders", money(F.col("net")).alias("revenue")
    )


def staff_by_job_level(star: Star) -> DataFrame:
    return (
        _per_staff(star, ["job_level"], "job_level")
        .orderBy(high("net"), low("job_level"))
        .select(
            "job_level",
            "orders",
            money(F.col("net")).alias("revenue"),
            mean(F.col("net"), F.col("orders")).alias("aov"),
        )
    )


def staff_by_location(star: Star) -> DataFrame:
    places = _per_staff(star, ["city", "country"], "city")
    return top(places, 15, high("orders"), low("city"), low("country")).select(
        "city", "country", "orders"
    )


def staff_delay_vs_repeat(star: Star) -> DataFrame:
    """All customers, also those with one order."""
    band = mean_delay_band(F.col("delay"), F.col("orders"), "Early Delivery")
    return (
        delay_per_customer(star)
        .groupBy(band.alias("delay_category"))
        .agg(
            mean(F.sum("orders"), F.count("*")).alias("avg_orders_per_customer"),
            F.count("*").alias("number_of_customers"),
        )
        .orderBy(high("avg_orders_per_customer"), low("delay_category"))
    )


QUERIES = [
    staff_total,
    staff_orders,
    staff_revenue,
    staff_avg_orders,
    staff_top15,
    staff_by_job_level,
    staff_by_location,
    staff_delay_vs_repeat,
]
