"""Builders for hand-made raw frames (tests only)."""

import datetime as dt

from basketry.sources.schemas import RAW_ORDERS_SCHEMA, RAW_SALES_SCHEMA


def ts(d):
    if d is None:
        return None
    if isinstance(d, str):
        d = dt.date.fromisoformat(d)
    return dt.datetime(d.year, d.month, d.day)


def raw_orders(spark, rows):
    """rows: (order_id, customer_id, date, net_sales)"""
    data = [(ts(d), c, o, float(n) if n is not None else None) for (o, c, d, n) in rows]
    return spark.createDataFrame(data, RAW_ORDERS_SCHEMA)


def raw_sales(spark, rows):
    """rows: (order_id, customer_id, product_id, date, net_sales, qty)"""
    data = [(ts(d), c, o, p, float(n) if n is not None else None, q) for (o, c, p, d, n, q) in rows]
    return spark.createDataFrame(data, RAW_SALES_SCHEMA)
