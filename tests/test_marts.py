"""Header/line edge cases and the data checks that must catch them."""

from decimal import Decimal

import pytest

from basketry.config import REFERENCE_CONFIG as CFG
from basketry.plans import quality as dq
from basketry.plans.marts import Marts
from helpers import raw_orders, raw_sales


@pytest.fixture(scope="module")
def marts(spark):
    ro = raw_orders(spark, [
        (1, 10, "2026-01-05", 30.0),     # two lines
        (2, 11, "2026-01-06", 0.0),      # no lines, header 0  -> sales mismatch
        (3, 12, "2026-01-07", -1.0),     # no lines, header -1 -> passes the sales check
        (4, 13, "2026-01-08", 100.00),   # lines sum 99.99 -> passes
        (5, 14, "2026-01-09", 100.00),   # lines sum 99.98 -> fails
        (6, 15, "2026-01-10", 5.0),      # duplicate (order, product) lines, qty 0 line
    ])
    rs = raw_sales(spark, [
        (1, 10, 100, "2026-01-05", 10.0, 1),
        (1, 10, 101, "2026-01-04", 20.0, 3),     # line date differs from header
        (4, 13, 100, "2026-01-08", 99.99, 2),
        (5, 14, 100, "2026-01-09", 99.98, 2),
        (6, 15, 102, "2026-01-10", 2.5, 0),
        (6, 15, 102, "2026-01-10", 2.5, 1),
        (99, 16, 100, "2026-01-11", 47.09, 1),   # orphan line
    ])
    return Marts(ro, rs, CFG)


def test_product_summary(marts):
    got = {r.order_id: r for r in marts.order_product_summary.collect()}
    assert set(got) == {1, 4, 5, 6}                      # orphan 99 dropped
    assert (got[6].product_line_count, got[6].distinct_product_count, got[6].qty_product) == (2, 1, 1)


def test_header_without_lines_has_zeros(marts):
    got = {r.order_id: r for r in marts.mart_orders.collect()}
    assert len(got) == 6
    assert (got[2].qty_product, got[2].product_line_count, got[2].distinct_product_count) == (0, 0, 0)
    assert got[1].order_count == 1


def test_order_lines(marts):
    rows = marts.mart_order_lines.collect()
    assert {r.order_id for r in rows} == {1, 4, 5, 6}
    by = {(r.order_id, r.product_id, r.quantity): r for r in rows}
    assert str(by[(1, 101, 3)].order_date) == "2026-01-04"       # the line's own date
    assert by[(6, 102, 0)].revenue_per_unit is None              # qty 0 -> NULL, no error
    assert by[(1, 101, 3)].revenue_per_unit == Decimal("6.67")


def test_product_mart(marts):
    got = {r.product_id: r for r in marts.mart_product_summary.collect()}
    p = got[100]
    assert p.total_units_sold == 5 and p.orders_containing_product == 3
    assert p.total_product_revenue == Decimal("209.97")
    assert p.active_months == 1


def test_positive_qty_check(marts):
    assert {r.order_id for r in dq.positive_product_qty(marts.mart_orders).collect()} == {2, 3}


def test_orphan_checks(marts):
    assert [r.order_id for r in dq.lines_without_header(marts.stg_sales, marts.stg_orders).collect()] == [99]


def test_grain_check(marts):
    rows = dq.order_lines_grain(marts.mart_order_lines).collect()
    assert [(r.order_id, r.product_id, r.row_count) for r in rows] == [(6, 102, 2)]


def test_sales_match_check(marts):
    bad = {r.order_id for r in dq.order_sales_match(marts.stg_orders, marts.stg_sales).collect()}
    assert bad == {2, 5}


def test_check_summary_all_checks(marts):
    rows = {r.check_name: (r.severity, r.failures) for r in dq.check_summary(marts).collect()}
    assert len(rows) == 64
    assert rows["relationships:stg_sales.order_id"] == ("warn", 1)
    assert rows["lines_have_header"] == ("warn", 1)
    assert rows["positive_product_qty"] == ("error", 2)
    assert rows["invalid_segments"] == ("error", 0)


def test_run_checks_raises_on_error(marts):
    from basketry.operators.checks import run_checks
    checks = [c for c in dq.declared_checks(marts) if c.name in ("positive_product_qty", "lines_have_header")]
    with pytest.raises(AssertionError):
        run_checks(checks)
    res = run_checks(checks, raise_on_error=False)
    assert ("lines_have_header", "warn", 1) in res


def test_presentation_hash(spark, marts):
    import hashlib
    r = marts.mart_orders_presentation.where("order_date = DATE'2026-01-05'").first()
    assert r.customer_ref == hashlib.sha256(b"10").hexdigest()
    assert "customer_id" not in marts.mart_orders_presentation.columns


def test_profile_reconciliation_finds_wrong_rows(spark):
    from pyspark.sql import functions as F
    from basketry.config import DRIVER_CONFIG
    from basketry.plans.marts import Marts as M
    from conftest import SF_SMALL
    mart = M.from_tables(spark, SF_SMALL, DRIVER_CONFIG).mart_orders
    assert dq.profile_reconciliation(mart, DRIVER_CONFIG).count() == 0
    target = mart.agg(F.min("order_id")).first()[0]
    broken = mart.withColumn("customer_profile", F.when(F.col("order_id") == target, F.lit("Unknown"))
                             .otherwise(F.col("customer_profile")))
    rows = dq.profile_reconciliation(broken, DRIVER_CONFIG).collect()
    assert [r.order_id for r in rows] == [target] and rows[0].stored_profile == "Unknown"


def test_frequent_products_are_dealt_out_with_the_same_sums(spark):
    """A product with most lines, nulls, copies and an order of two customers;
    no aggregate over multiplied rows for the others."""
    from basketry.plans.marts import frequent, mart_product_summary
    lines = [(i % 40, i % 7 if i % 9 else None, None if i % 11 == 0 else 5 if i % 3 else i % 13,
              None if i % 17 == 0 else f"2024-{1 + i % 12:02d}-{1 + i % 28:02d}", i % 5, None if i % 19 == 0 else str(i / 4),
              ("New", "Returning", "VIP")[i % 3]) for i in range(600)] * 2
    df = spark.createDataFrame(lines, "order_id long, customer_id long, product_id long, order_date string, quantity long, "
                               "net_sales string, order_segmentation string")
    df = df.selectExpr("* except (order_date, net_sales)", "cast(order_date as date) order_date", "cast(net_sales as decimal(38,9)) net_sales")
    plain = mart_product_summary(df)
    assert "Expand" not in plain._jdf.queryExecution().executedPlan().toString()
    got = {r.product_id: r for r in plain.collect()}
    assert sorted(map(repr, mart_product_summary(df, [5]).collect())) == sorted(map(repr, got.values()))
    assert set(got) == {x[2] for x in lines}
    for p, r in got.items():
        own = [x for x in lines if x[2] == p]
        assert r.orders_containing_product == len({x[0] for x in own})
        assert r.customers_buying_product == len({x[1] for x in own} - {None})
        assert r.active_months == len({x[3][:7] for x in own if x[3]})
        assert r.total_units_sold == sum(x[4] for x in own)
    assert frequent([1, 2, 2, 2, 3, 4, 4]) == [2, 4] and frequent([]) == []
