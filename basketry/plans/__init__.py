"""The models: staging, intermediate, marts, reports, checks, metrics and
forecast. Each is a function of DataFrames returning a lazy DataFrame."""

from basketry.plans.staging import stg_orders, stg_sales
from basketry.plans.marts import (
    Marts, order_product_summary, order_customer_history, mart_orders, mart_order_lines,
    mart_product_summary, mart_orders_presentation, mart_order_lines_presentation,
    exercise_4_orders_with_qty, exercise_6_orders_segmented,
)

__all__ = [
    "stg_orders", "stg_sales", "Marts", "order_product_summary", "order_customer_history",
    "mart_orders", "mart_order_lines", "mart_product_summary", "mart_orders_presentation",
    "mart_order_lines_presentation", "exercise_4_orders_with_qty", "exercise_6_orders_segmented",
]
