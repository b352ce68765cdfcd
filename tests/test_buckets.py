"""Tables bucketed by order id: the same rows, no exchange, hot ids apart."""

import re

import pytest
from pyspark.sql import functions as F

from basketry.config import DRIVER_CONFIG as CFG
from basketry.operators.checks import relationships, unique
from basketry.plans import faults as ft
from basketry.plans import quality as dq
from basketry.plans.marts import Marts, order_product_summary, per_order
from basketry.sources.buckets import attach, hot_keys, store
from conftest import SF_SMALL

HOT = 7


@pytest.fixture(scope="module")
def frames(spark):
    """Headers with faults; a third of the lines on one order, some without
    an id, some whose id names no header."""
    m = Marts.from_tables(spark, SF_SMALL, CFG)
    pick = F.pmod(F.xxhash64("order_id", "product_id", "qty"), F.lit(30))
    lines = m.stg_lines.withColumn("order_id", F.when(pick < 10, HOT).when(pick == 10, None)
                             .when(pick == 11, -F.col("order_id")).otherwise(F.col("order_id")))
    orders = ft.faulted_headers(m.stg_orders, m.stg_lines)
    return orders, lines


@pytest.fixture(scope="module")
def stored(spark, frames):
    return store(spark, *frames, buckets=8, hot_rows=500)


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


PER_ORDER = {
    "summary": order_product_summary,
    "sums": lambda o, l: per_order(l),
    "sales": dq.order_sales_match,
    "grain": lambda o, l: dq.order_lines_grain(l),
    "headers": lambda o, l: dq.lines_without_header(l, o),
    "lines_of_orders": lambda o, l: l.join(o.select("order_id", "customer_id"), "order_id").select("order_id", "product_id", "qty"),
    "parents": lambda o, l: relationships(l, "order_id", o, "order_id"),
    "unique": lambda o, l: unique(o, "order_id"),
}


@pytest.mark.parametrize("name", PER_ORDER)
def test_same_rows_as_from_plain_tables(frames, stored, name):
    assert rows(stored.apply(PER_ORDER[name])) == rows(PER_ORDER[name](*frames))


@pytest.mark.parametrize("name", PER_ORDER)
def test_no_exchange_over_either_table(spark, stored, name):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = PER_ORDER[name](stored.orders, stored.lines)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert not re.search(r"Exchange (hash|range|Single)", plan), plan
    assert "Bucketed: true" in plan


def test_hot_ids_and_missing_ids_are_kept_apart(frames, stored):
    assert stored.hot_ids == 1
    assert {r["order_id"] for r in stored.hot_lines.select("order_id").distinct().collect()} == {HOT, None}
    assert stored.lines.where(F.col("order_id").isNull() | (F.col("order_id") == HOT)).count() == 0
    assert stored.lines.count() + stored.hot_lines.count() == frames[1].count()
    assert stored.orders.count() + stored.hot_orders.count() == frames[0].count()
    sizes = [r["count"] for r in stored.lines.groupBy(F.pmod(F.hash("order_id"), F.lit(8))).count().collect()]
    assert max(sizes) < 2 * sum(sizes) / 8


def test_a_hot_order_is_split_in_its_part(spark, stored):
    """The part of the hot ids joins by an exchange, which is split."""
    conf = {"spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1",
            "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "512",
            "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
            "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1"}
    old = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        out = PER_ORDER["lines_of_orders"](stored.hot_orders.repartition(4), stored.hot_lines.repartition(8))
        n = len(out.collect())
        plan = out._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    assert n > 1000 and "skewed" in plan


def test_without_hot_ids_and_on_empty_tables(spark, frames):
    orders, lines = frames
    lines = lines.where(F.col("order_id").isNotNull())
    none = store(spark, orders, lines, buckets=4)
    assert none.hot_ids == 0 and none.hot_lines.count() == 0
    assert rows(none.apply(order_product_summary)) == rows(order_product_summary(orders, lines))
    empty = store(spark, orders.limit(0), lines.limit(0), buckets=4)
    assert empty.apply(order_product_summary).count() == 0


def test_attached_again_by_its_folder(spark, stored):
    again = attach(spark, stored.root)
    assert again.buckets == 8 and rows(again.apply(dq.order_sales_match)) == rows(stored.apply(dq.order_sales_match))


def test_hot_keys(frames):
    assert hot_keys(frames[1], "order_id", 500) == [HOT]
    assert hot_keys(frames[1], "order_id", 1_000_000) == []


def test_models_over_buckets(spark, frames):
    """The checks and per-order sums of a model set read the buckets."""
    m = Marts.from_tables(spark, SF_SMALL, CFG)
    m.__dict__["stg_orders"], m.__dict__["stg_lines"] = frames
    b = m.bucketed(spark, buckets=8, hot_rows=500)
    assert rows(b.order_product_summary) == rows(m.order_product_summary)
    want = dq._header_lines_pass(m).first().asDict()
    assert dq._header_lines_pass(b).first().asDict() == want and min(want.values()) > 0
