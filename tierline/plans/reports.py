"""The reports by name, each over the tables of the star layer."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame

from tierline.operators import analysis
from tierline.sources import count_tables

Star = Mapping[str, DataFrame]

REPORTS: dict[str, Callable[[Star], DataFrame]] = {
    "table_listing": count_tables,
    "category_list": lambda t: analysis.category_list(t["dim_products"]),
    "state_list": lambda t: analysis.state_list(t["dim_customers"]),
    "purchase_range": lambda t: analysis.purchase_range(t["fact_order_items"]),
    "price_range": lambda t: analysis.price_range(t["fact_order_items"]),
    "delivery_range": lambda t: analysis.delivery_range(t["fact_order_items"]),
    "monthly_trend": lambda t: analysis.monthly_trend(t["fact_order_items"]),
    "running_revenue": lambda t: analysis.running_revenue(t["fact_order_items"]),
    "spend_segments": lambda t: analysis.spend_segments(t["dim_customers"]),
    "delivery_performance": lambda t: analysis.delivery_performance(
        t["fact_order_items"], t["dim_customers"]
    ),
    "delivery_performance_by_order": lambda t: analysis.delivery_performance_by_order(
        t["fact_order_items"], t["dim_customers"]
    ),
    "revenue_by_state": lambda t: analysis.revenue_by_state(
        t["fact_order_items"], t["dim_customers"]
    ),
    "top_products": lambda t: analysis.top_products(t["fact_order_items"], t["dim_products"]),
    "top_categories": lambda t: analysis.top_categories(
        t["fact_order_items"], t["dim_products"]
    ),
}

# Reports that file footers answer, over tables read for that.
FOOTER_REPORTS: dict[str, Callable[[Star], DataFrame]] = {
    "table_listing": count_tables,
    "delivery_range": lambda t: analysis.delivery_range(t["fact_order_items"], delivered_only=False),
}
