"""Declared raw sources: names, grain and columns."""

from pyspark.sql.types import (
    DoubleType, LongType, StructField, StructType, TimestampNTZType,
)

# Raw order headers: one row per order.
RAW_ORDERS_SCHEMA = StructType([
    StructField("date_date", TimestampNTZType(), True),
    StructField("customers_id", LongType(), True),
    StructField("orders_id", LongType(), True),
    StructField("net_sales", DoubleType(), True),
])

# Raw order lines: nominally one row per order and product.
RAW_SALES_SCHEMA = StructType([
    StructField("date_date", TimestampNTZType(), True),
    StructField("customer_id", LongType(), True),
    StructField("order_id", LongType(), True),
    StructField("products_id", LongType(), True),
    StructField("net_sales", DoubleType(), True),
    StructField("qty", LongType(), True),
])

# Columns a raw file must have before it is loaded.
RAW_ORDERS_REQUIRED = ("date_date", "customers_id", "orders_id", "net_sales")
RAW_SALES_REQUIRED = ("order_id", "products_id", "qty")

SOURCES = {
    "orders": {"grain": "order", "schema": RAW_ORDERS_SCHEMA, "required": RAW_ORDERS_REQUIRED},
    "sales": {"grain": "order x product", "schema": RAW_SALES_SCHEMA, "required": RAW_SALES_REQUIRED},
}
