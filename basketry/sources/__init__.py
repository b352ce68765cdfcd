"""Readers, schemas and sinks."""

from basketry.sources.schemas import RAW_ORDERS_SCHEMA, RAW_SALES_SCHEMA, RAW_ORDERS_REQUIRED, RAW_SALES_REQUIRED
from basketry.sources.readers import (
    require_columns, load_orders, load_sales, null_counts, load_profile,
)
from basketry.sources.tpch import raw_orders_from_tables, raw_sales_from_tables, read_table as read_driver_table
from basketry.sources.sinks import (
    write_table, ensure_namespace, materialize, read_table, cluster,
)

__all__ = [
    "RAW_ORDERS_SCHEMA", "RAW_SALES_SCHEMA", "RAW_ORDERS_REQUIRED", "RAW_SALES_REQUIRED",
    "require_columns", "load_orders", "load_sales", "null_counts", "load_profile",
    "raw_orders_from_tables", "raw_sales_from_tables", "read_driver_table",
    "write_table", "ensure_namespace", "materialize", "read_table", "cluster",
]
