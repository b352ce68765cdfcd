"""Report rules on hand-made order marts."""

import datetime as dt
from decimal import Decimal

import pytest

from basketry.config import REFERENCE_CONFIG as CFG
from basketry.plans import reports as rp

SCHEMA = ("order_id bigint, customer_id bigint, order_date date, order_year bigint, order_month bigint, "
          "net_sales decimal(38,9), qty_product bigint, order_segmentation string, "
          "has_complete_12_month_history boolean")


def _mart(spark, rows):
    data = []
    for i, (d, v, q, seg, cust) in enumerate(rows, 1):
        d = dt.date.fromisoformat(d)
        data.append((i, cust, d, d.year, d.month, Decimal(str(v)), q, seg, d >= dt.date(2026, 7, 9)))
    return spark.createDataFrame(data, SCHEMA)


@pytest.fixture(scope="module")
def mart(spark):
    rows = [("2026-01-05", 10, 1, "New", 1), ("2026-01-06", 20, 2, "VIP", 2),
            ("2026-02-01", 30, 3, "Returning", 1), ("2026-02-02", 40, 4, "VIP", 3),
            ("2026-03-01", 50, 5, "New", 4),
            ("2026-11-01", 60, 6, "VIP", 1), ("2026-11-02", 70, 7, "VIP", 1), ("2026-11-03", 80, 8, "New", 5),
            ("2025-12-31", 5, 1, "New", 6)]
    return _mart(spark, rows)


def test_peak_month_ties_go_to_earlier_month(mart):
    r = rp.peak_month_ratio(mart, CFG).first()
    assert (r.max_month, r.max_orders) == (11, 3)
    assert (r.min_month, r.min_orders) == (3, 1)      # March (1 order) is the only single-order month
    assert r.max_min_ratio == 3.0


def test_tie_on_busiest_month(spark):
    m = _mart(spark, [("2026-01-01", 1, 1, "New", 1), ("2026-01-02", 1, 1, "New", 1),
                      ("2026-05-01", 1, 1, "New", 1), ("2026-05-02", 1, 1, "New", 1)])
    r = rp.peak_month_ratio(m, CFG).first()
    assert (r.max_month, r.min_month) == (1, 1)


def test_quarter_and_segment_shares(mart):
    q = rp.quarter_share(mart, CFG).first()
    assert (q.quarter_orders, q.pct_of_year) == (3, 37.5)
    seg = {r.order_segmentation: r for r in rp.segment_breakdown(mart, CFG).collect()}
    assert seg["VIP"].orders == 4 and seg["VIP"].pct == 50.0
    assert sum(r.pct for r in seg.values()) == pytest.approx(100.0)
    rv = rp.returning_vip_share(mart, CFG).first()
    assert (rv.orders, rv.pct) == (5, 62.5)


def test_month_contribution_levels(mart):
    rows = rp.month_contribution(mart).collect()
    levels = {}
    for r in rows:
        levels.setdefault(r.level, []).append(r)
    assert len(levels["total"]) == 1 and levels["total"][0].orders == 9
    assert {(r.order_year, r.order_half) for r in levels["half"]} == {(2025, 2), (2026, 1), (2026, 2)}
    assert {r.order_year: r.orders for r in levels["year"]} == {2025: 1, 2026: 8}
    assert sum(r.revenue_pct for r in levels["month"]) == pytest.approx(100.0, abs=0.2)


def test_same_day_and_completeness(spark):
    m = _mart(spark, [("2026-08-01", 1, 1, "New", 1), ("2026-08-01", 1, 1, "New", 1),
                      ("2026-08-01", 1, 1, "New", 2), ("2026-08-01", 1, 1, "New", 2),
                      ("2026-08-01", 1, 1, "New", 2), ("2026-01-01", 1, 1, "New", 1)])
    s = rp.same_day_collisions(m).first()
    assert (s.affected_groups, s.affected_customers, s.affected_rows) == (2, 2, 5)
    h = rp.history_completeness(m).first()
    assert (h.full_history, h.partial_history, h.total) == (5, 1, 6)


def test_units_histogram(spark):
    lines = spark.createDataFrame([(1, 3), (1, 8), (2, 10), (3, 25), (4, 0)],
                                  "product_id bigint, units_sold bigint").selectExpr(
        "product_id", "units_sold", "1L AS order_line_count")
    got = {(r.bucket_start, r.bucket_end): r.products for r in rp.units_histogram(lines, 10).collect()}
    assert got == {(10, 20): 2, (20, 30): 1, (0, 10): 1}


def test_quarter_revenue_share(mart):
    r = rp.quarter_revenue_share(mart, 4).first()
    assert r.quarter_revenue == Decimal("215.00")     # Nov 2026 (210) + Dec 2025 (5)
    assert r.revenue_pct == pytest.approx(round(215 * 100 / 365, 1))
