"""Adapter: present the generated test tables as the two raw sources.

Role mapping (headers): ``o_orderkey`` -> orders_id, ``o_custkey`` ->
customers_id, ``o_orderdate`` -> date_date, ``o_totalprice`` -> net_sales.
Lines: ``l_orderkey`` -> order_id, ``l_partkey`` -> products_id,
``l_quantity`` -> qty, ``l_extendedprice * (1 - l_discount)`` (exact, in
decimals, rounded to cents) -> net_sales. Lines carry neither the customer nor
the date, so both come from the header through a left join on the order key.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

_PRICE = DecimalType(18, 2)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def raw_orders_from_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = read_table(spark, sf_dir, "orders")
    return o.select(
        F.col("o_orderdate").alias("date_date"),
        F.col("o_custkey").alias("customers_id"),
        F.col("o_orderkey").alias("orders_id"),
        F.col("o_totalprice").alias("net_sales"),
    )


def line_net_sales() -> F.Column:
    price = F.col("l_extendedprice").cast(_PRICE)
    disc = F.col("l_discount").cast(_PRICE)
    return F.round(price * (F.lit(1) - disc), 2).cast("double")


def raw_sales_from_tables(spark: SparkSession, sf_dir: str, headers: bool = True) -> DataFrame:
    """The lines, with the customer and the date of their header. A plain left
    join on the order key (unique in the table by contract), so an order with
    a large share of the lines is split by the skew-join handling.

    ``headers=False``: customer and date are NULL and there is no join, for
    models that use neither."""
    li = read_table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_quantity", "l_extendedprice", "l_discount")
    o = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    if headers:
        li = li.join(o, li.l_orderkey == o.o_orderkey, "left")
    else:
        li = li.select("*", *[F.lit(None).cast(o.schema[c].dataType).alias(c) for c in ("o_custkey", "o_orderdate")])
    return li.select(
        F.col("o_orderdate").alias("date_date"),
        F.col("o_custkey").alias("customer_id"),
        F.col("l_orderkey").alias("order_id"),
        F.col("l_partkey").alias("products_id"),
        line_net_sales().alias("net_sales"),
        F.col("l_quantity").alias("qty"),
    )
