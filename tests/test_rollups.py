"""Stored aggregates: the same answers as the mart, from small tables."""

import datetime as dt
import itertools

import pytest
from pyspark.sql import functions as F

from basketry.config import DRIVER_CONFIG as CFG
from basketry.operators.explore import explore
from basketry.operators.rollups import Slice, choose
from basketry.plans import semantic as sm
from basketry.plans.marts import Marts
from conftest import SF_SMALL
from helpers import raw_orders, raw_sales


@pytest.fixture(scope="module")
def built(spark):
    m = Marts.from_tables(spark, SF_SMALL, CFG).materialize(spark)
    m.rolled(spark)
    return m


def rows(df):
    return sorted(map(str, df.collect()))


VIEWS = {"mart_orders": sm.orders_view(CFG), "mart_order_lines": sm.order_lines_view(CFG)}
TIME = ["order_date_date", "order_date_week", "order_date_month", "order_date_quarter", "order_date_year"]
PLAIN = ["order_segmentation", "customer_profile", "has_complete_12_month_history"]
SLICES = [None, Slice(segment="VIP"), Slice(dt.date(1997, 2, 1), dt.date(1998, 7, 1), profile="Returning"),
          Slice(date_from=dt.date(1998, 3, 5), complete_only=True), Slice(date_to=dt.date(1900, 1, 1))]


def cases(mart):
    dims = [[], *[[t] for t in TIME], ["order_date_quarter", "order_segmentation"], ["order_segmentation", "customer_profile"], PLAIN]
    if mart == "mart_order_lines":
        dims.append(["product_id"])
    return dims


@pytest.mark.parametrize("mart", list(VIEWS))
def test_every_measure_equals_the_mart(spark, built, mart):
    """All measures at once and one by one, over dimensions and filters."""
    view, df, stored = VIEWS[mart], getattr(built, mart), built.rollups_of(spark, mart)
    used = set()
    for dims, wanted in itertools.product(cases(mart), SLICES):
        fits = [m for m in view.measures if choose(
            stored, [view.dimensions[d] for d in dims], [view.measures[m]], wanted, {})]
        assert fits or "product_id" in dims and wanted is not None
        if not fits:
            continue
        got = explore(view, df, dims, fits, wanted, rollups=stored)
        assert rows(got) == rows(explore(view, df, dims, fits, wanted)), (dims, wanted)
        assert got.schema.simpleString() == explore(view, df, dims, fits, wanted).schema.simpleString()
        used |= {s.rollup.name for s in stored if choose(
            stored, [view.dimensions[d] for d in dims], [view.measures[m] for m in fits], wanted, {}) is s}
    assert used == {s.rollup.name for s in stored}


def scans(df):
    return [x for x in df.inputFiles()]


def test_the_small_table_is_read(spark, built):
    def read(view, mart, *args, **kw):
        return scans(explore(view, getattr(built, mart), *args, rollups=built.rollups_of(spark, mart), **kw))
    files = read(VIEWS["mart_orders"], "mart_orders", ["order_date_quarter"], ["order_count", "unique_customers"])
    assert files and all("/rollups/orders_by_month" in f for f in files)
    files = read(VIEWS["mart_orders"], "mart_orders", ["order_date_week"], ["unique_customers"])
    assert files and all("/rollups/orders_by_day" in f for f in files)
    # outside the lattice: another dimension, a distinct count by product, a filter in mid-month for a month rollup
    files = read(VIEWS["mart_orders"], "mart_orders", ["qty_product"], ["order_count"])
    assert files and all("/mart_orders/" in f for f in files)
    files = read(VIEWS["mart_order_lines"], "mart_order_lines", ["product_id"], ["unique_customers"])
    assert files and all("/mart_order_lines/" in f for f in files)
    files = read(VIEWS["mart_order_lines"], "mart_order_lines", [], ["unique_customers"], Slice(date_to=dt.date(1998, 3, 5)))
    assert files and all("/mart_order_lines/" in f for f in files)
    files = read(VIEWS["mart_orders"], "mart_orders", [], ["order_count"], F.col("order_id") > 5)
    assert files and all("/mart_orders/" in f for f in files)


def test_one_table_for_unique_customers_at_every_grain(spark, built):
    day = next(s for s in built.rolled(spark) if s.rollup.name == "orders_by_day")
    view = VIEWS["mart_orders"]
    for dims in [[], *[[t] for t in TIME]]:
        got = day.answer([view.dimensions[d] for d in dims], [view.measures["unique_customers"]], None, {})
        assert rows(got) == rows(explore(view, built.mart_orders, dims, ["unique_customers"]))


def test_awkward_ids_and_values(spark, tmp_path):
    """Null, negative and very large ids, null dates and amounts, empty marts."""
    ids = [None, 0, -1, 1, 32768, 32769, -32768, 1 << 40, (1 << 62) + 5]
    orders = [(i if i is not None else 77, i, None if k == 3 else f"1998-0{1 + k % 9}-1{k % 9}", None if k == 4 else 10.0 / 3 * k) for k, i in enumerate(ids)]
    sales = [(o, c, c, d, n, k) for k, (o, c, d, n) in enumerate(orders)] * 2
    for o, s in ((orders, sales), ([], [])):
        m = Marts(raw_orders(spark, o), raw_sales(spark, s), CFG).materialize(spark, f"{tmp_path}/b{len(o)}")
        for mart, view in VIEWS.items():
            for dims in ([], ["order_date_month"], ["order_segmentation"]):
                measures = list(view.measures)
                got = explore(view, getattr(m, mart), dims, measures, rollups=m.rollups_of(spark, mart))
                assert rows(got) == rows(explore(view, getattr(m, mart), dims, measures)), (mart, dims)


def test_reports_from_daily_sums_equal_the_mart(spark, built):
    from basketry.plans import reports as rp
    days, mart = built.orders_by_day(spark), built.mart_orders
    for report in (rp.orders_in_year, rp.orders_per_month, rp.avg_qty_per_month, rp.monthly_pattern, rp.quarter_share,
                   rp.peak_month_ratio, rp.segment_breakdown, rp.returning_vip_share, rp.segment_share_in_year):
        assert rows(report(days, CFG)) == rows(report(mart, CFG)), report.__name__
        later = CFG.with_(report_year=2050)   # a year without orders
        assert rows(report(days, later)) == rows(report(mart, later)), report.__name__
    for report in (rp.history_completeness, rp.daily_trends, rp.month_contribution, rp.quarter_summary, rp.segment_table, rp.quarter_revenue_share):
        assert rows(report(days)) == rows(report(mart)), report.__name__
    for dim in PLAIN:
        assert rows(rp.sales_by(days, dim)) == rows(rp.sales_by(mart, dim))
    assert all("/rollups/orders_by_day" in f for f in rp.month_contribution(days).inputFiles())


def test_id_sets_take_no_more_rows_than_ids(spark):
    """Few ids far apart: a long each, summed by hash aggregates."""
    from basketry.operators.rollups import Rollup
    df = spark.createDataFrame([(k, i * 40_000 - 5) for k in (1, 2) for i in range(50)] * 3, "k long, id long")
    sets = Rollup("r", "m", None, ("k",), {}, ("id",)).sets_of(df)
    assert "SortAggregate" not in sets._jdf.queryExecution().executedPlan().toString()
    assert sets.count() == 100 and dict(sets.dtypes)["bits"] == "bigint"
    assert sets.agg(F.sum(F.bit_count("bits"))).first()[0] == 100
