import datetime as dt

import pytest
from pyspark.sql import functions as F

from basketry.config import REFERENCE_CONFIG as CFG
from basketry.functions.dates import date_at_grain
from basketry.operators.explore import explore
from basketry.plans import semantic as sm


def test_sunday_week(spark):
    df = spark.createDataFrame([(dt.date(2026, 12, 2),), (dt.date(2026, 11, 29),)], "d date")  # Wed, Sun
    got = [r[0] for r in df.select(date_at_grain(F.col("d"), "week")).collect()]
    assert got == [dt.date(2026, 11, 29), dt.date(2026, 11, 29)]
    mon = [r[0] for r in df.select(date_at_grain(F.col("d"), "week", "monday")).collect()]
    assert mon == [dt.date(2026, 11, 30), dt.date(2026, 11, 23)]


def _orders(spark):
    rows = [(1, 10, dt.date(2026, 1, 3), 10.0, 2, "New", "VIP"),
            (2, 10, dt.date(2026, 1, 20), 30.0, 1, "VIP", "VIP"),
            (3, 11, dt.date(2026, 2, 1), None, 4, "Returning", "Returning")]
    return spark.createDataFrame(rows, "order_id bigint, customer_id bigint, order_date date, net_sales double, "
                                       "qty_product bigint, order_segmentation string, customer_profile string")


def test_orders_explore(spark):
    out = explore(sm.orders_view(CFG), _orders(spark), ["order_date_at_selected_grain"],
                  ["order_count", "total_net_sales", "average_order_value", "unique_customers", "vip_revenue",
                   "new_customer_orders"], params={"date_granularity": "month"})
    got = {r.order_date_at_selected_grain: r for r in out.collect()}
    jan = got["2026-01-01"]
    assert (jan.order_count, jan.total_net_sales, jan.average_order_value, jan.unique_customers) == (2, 40.0, 20.0, 1)
    assert jan.vip_revenue == 30.0 and jan.new_customer_orders == 1
    feb = got["2026-02-01"]
    assert feb.average_order_value is None and feb.vip_revenue == 0.0


def test_validation(spark):
    v = sm.orders_view(CFG)
    with pytest.raises(KeyError):
        explore(v, _orders(spark), ["nope"], ["order_count"])
    with pytest.raises(ValueError):
        explore(v, _orders(spark), [], ["order_count"], params={"date_granularity": "hour"})
    with pytest.raises(ValueError):
        sm.segment_filter("Gold")


def test_focus_and_filters(spark):
    df = _orders(spark)
    out = sm.focus_metric(sm.orders_view(CFG), df, [], "orders", "VIP")
    assert out.first().order_count == 1
    f = sm.dashboard_filter(date_from=dt.date(2026, 1, 10), profile="VIP")
    assert sm.drill(df, f).count() == 1


def test_line_measures(spark):
    rows = [(1, 10, 100, dt.date(2026, 1, 1), 2, 10.0, "New"), (1, 10, 101, dt.date(2026, 1, 1), 3, 5.0, "New"),
            (2, 11, 100, dt.date(2026, 1, 2), 5, 20.0, "VIP")]
    df = spark.createDataFrame(rows, "order_id bigint, customer_id bigint, product_id bigint, order_date date, "
                                     "quantity bigint, net_sales double, order_segmentation string")
    r = explore(sm.order_lines_view(CFG), df, [], ["order_count", "average_revenue_per_unit",
                                                   "average_quantity_per_order", "unique_products"]).first()
    assert (r.order_count, r.average_revenue_per_unit, r.average_quantity_per_order, r.unique_products) == \
        (2, 3.5, 5.0, 2)
