"""Counts on the test tables that FIXTURES.md lists (measured there with
DuckDB): segments, orders without lines, same-day groups, repeated lines."""

import pytest
from pyspark.sql import functions as F

from basketry.config import DRIVER_CONFIG
from basketry.plans import quality as dq
from basketry.plans import reports as rp
from basketry.plans.marts import Marts
from conftest import SF_MID, SF_SMALL

GOLDEN = {
    SF_SMALL: {"orders": 1500, "customers": 150, "no_lines": 27, "same_day": (1, 2), "repeated": 57,
               "segments": {"New": 397, "Returning": 1018, "VIP": 85}},
    SF_MID: {"orders": 15000, "customers": 1500, "no_lines": 257, "same_day": (32, 64), "repeated": 55,
             "segments": {"New": 3934, "Returning": 10168, "VIP": 898}},
}


@pytest.mark.parametrize("sf", [SF_SMALL, SF_MID])
def test_golden_counts(spark, sf):
    g = GOLDEN[sf]
    m = Marts.from_tables(spark, sf, DRIVER_CONFIG)
    mo = m.mart_orders
    assert mo.count() == g["orders"]
    assert mo.select(F.countDistinct("customer_id")).first()[0] == g["customers"]
    assert dq.positive_product_qty(mo).count() == g["no_lines"]
    s = rp.same_day_collisions(mo).first()
    assert (s.affected_groups, s.affected_rows) == g["same_day"]
    assert dq.order_lines_grain(m.mart_order_lines).count() == g["repeated"]
    assert {r[0]: r[1] for r in mo.groupBy("order_segmentation").count().collect()} == g["segments"]
    assert rp.orphan_line_count(m.stg_sales, m.stg_orders).first()[0] == 0
