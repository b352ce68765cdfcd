"""Staging: typed, renamed views of the raw sources (no row changes)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType, DoubleType, FloatType

from basketry.functions.numeric import MONEY


def _int64(df: DataFrame, name: str) -> Column:
    """Cast to BIGINT; fractional inputs are rounded half away from zero
    first (a plain cast would truncate 2.7 to 2)."""
    c = F.col(name)
    if isinstance(df.schema[name].dataType, (DoubleType, FloatType, DecimalType)):
        c = F.round(c)
    return c.cast("bigint")


def _day(name: str) -> Column:
    """Date part; an unparsable value becomes NULL instead of failing."""
    return F.col(name).try_cast("date")


def staged_orders(raw_orders: DataFrame) -> dict[str, Column]:
    """Staged column -> expression over the raw headers."""
    return {
        "order_date": _day("date_date"),
        "customer_id": _int64(raw_orders, "customers_id"),
        "order_id": _int64(raw_orders, "orders_id"),
        "net_sales": F.col("net_sales").cast(MONEY),
    }


def staged_sales(raw_sales: DataFrame) -> dict[str, Column]:
    """Staged column -> expression over the raw lines."""
    return {
        "order_date": _day("date_date"),
        "customer_id": _int64(raw_sales, "customer_id"),
        "order_id": _int64(raw_sales, "order_id"),
        "product_id": _int64(raw_sales, "products_id"),
        "line_net_sales": F.col("net_sales").cast(MONEY),
        "qty": _int64(raw_sales, "qty"),
    }


def stg_orders(raw_orders: DataFrame) -> DataFrame:
    return raw_orders.select(*[c.alias(n) for n, c in staged_orders(raw_orders).items()])


def stg_sales(raw_sales: DataFrame) -> DataFrame:
    return raw_sales.select(*[c.alias(n) for n, c in staged_sales(raw_sales).items()])
