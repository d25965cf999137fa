"""The dashboard queries, one module per dashboard. Each takes a Star and returns a DataFrame."""

from bazaarlake.plans.dashboards import (
    campaign_performance,
    campaign_roi,
    customer_analytics,
    customer_segmentation,
    delivery_logistics,
    executive_overview,
    geographic_performance,
    market_basket,
    merchant_performance,
    product_performance,
    staff_operations,
    time_based,
)

MODULES = [
    executive_overview,
    campaign_performance,
    campaign_roi,
    customer_analytics,
    customer_segmentation,
    delivery_logistics,
    geographic_performance,
    market_basket,
    merchant_performance,
    product_performance,
    staff_operations,
    time_based,
]

QUERIES = {query.__name__: query for module in MODULES for query in module.QUERIES}
