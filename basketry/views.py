"""Expose every model to Spark SQL by name.

Staging models and presentation views are lazy temp views (re-evaluated per
query, like the source's views); the forecast outputs are registered the same
way, so ``SELECT * FROM v_sales_forecast_all`` behaves like the source's
zero-argument table functions; ``v_sales_forecast_h(days)`` is a SQL table
function of any horizon. The segment rule is registered as the SQL
function ``order_segment(n)``.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from basketry.functions.segments import register_sql_functions
from basketry.plans import forecast as fc
from basketry.plans.marts import Marts


def register_views(spark: SparkSession, m: Marts, with_forecast: bool = True) -> list[str]:
    views = {
        "stg_orders": m.stg_orders,
        "stg_sales": m.stg_sales,
        "int_order_product_summary": m.order_product_summary,
        "int_order_customer_history": m.order_customer_history,
        "mart_orders": m.mart_orders,
        "mart_order_lines": m.mart_order_lines,
        "mart_product_summary": m.mart_product_summary,
        "mart_orders_presentation": m.mart_orders_presentation,
        "mart_order_lines_presentation": m.mart_order_lines_presentation,
        "exercise_4_orders_with_qty": m.exercise_4,
        "exercise_6_orders_segmented": m.exercise_6,
    }
    if with_forecast:
        views["v_sales_forecast"] = fc.sales_forecast(m.mart_orders)
        views["v_sales_forecast_all"] = fc.sales_forecast_all(m.mart_orders)
        fc.register_table_function(spark, m.mart_orders)
    for name, df in views.items():
        df.createOrReplaceTempView(name)
    register_sql_functions(spark, m.cfg)
    return sorted(views)
