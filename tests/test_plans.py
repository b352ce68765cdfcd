"""Plan properties that matter at scale."""

import pytest

from basketry.config import DRIVER_CONFIG
from basketry.plans.marts import Marts
from conftest import SF_SMALL


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def _optimized(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


@pytest.fixture(scope="module")
def m(spark):
    return Marts.from_tables(spark, SF_SMALL, DRIVER_CONFIG)


def test_date_range_reaches_scan(m):
    plan = _plan(m.exercise_6)
    assert "PushedFilters" in plan and "GreaterThanOrEqual(o_orderdate" in plan


def test_scan_prunes_columns(m):
    from basketry.plans import reports as rp
    plan = _plan(rp.orders_in_year(m.stg_orders, m.cfg))
    assert "o_totalprice" not in plan.split("ReadSchema")[1].split("\n")[0]


def test_lookback_window_runs_on_daily_rows(m):
    """The range window must sit above an aggregate on (customer, day), never
    directly above the raw order scan."""
    opt = _optimized(m.order_customer_history)
    w = opt.index("Window [sum(day_orders")
    assert "Aggregate [customer_id" in opt[w:]


def test_no_cartesian_products(spark):
    from basketry.registry import QUERIES
    for name, fn in QUERIES.items():
        plan = _plan(fn(spark, SF_SMALL))
        assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan, name


def _final_plan(df):
    """The plan that ran, after adaptive execution."""
    df.write.format("noop").mode("overwrite").save()
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


def _scans(plan, column=""):
    import re
    return [x for x in re.findall(r"FileScan parquet \[([^]]*)\]", plan) if column in x]


def test_product_summary_reads_the_lines_once(spark, m):
    """In the plan that ran, joins broadcast or not."""
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    for threshold in (old, "-1"):
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
        try:
            from basketry.plans.marts import mart_product_summary
            plan = _final_plan(mart_product_summary(m.mart_order_lines.select("*")))
        finally:
            spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
        assert len(_scans(plan, "l_partkey")) == 1


def test_staged_lines_join_plain_headers(m):
    plan = _plan(m.stg_sales)
    assert "SortAggregate" not in plan and "HashAggregate" not in plan
    assert len(_scans(_plan(m.stg_lines))) == 1


def test_check_summary_scans(spark):
    from basketry import registry
    from basketry.plans.quality import check_summary
    plan = _final_plan(check_summary(registry._built(spark, SF_SMALL)))
    assert 0 < len(_scans(plan)) <= 12


def test_lines_aggregated_before_meeting_headers(spark, m):
    """A hot order must be reduced map-side. For large inputs (no broadcast)
    the semi join with the headers stays above the per-order aggregate;
    Catalyst pushes it below only when the headers can be broadcast, where
    the semi join is a map-side filter."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        opt = m.order_product_summary.select("*")._jdf.queryExecution().optimizedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    semi = opt.index("Join LeftSemi")
    assert "Aggregate [order_id" in opt[semi:]     # child of the semi join: runs first
