"""Named queries over the test tables: the inventory that the entry module
exposes. Each entry takes (spark, sf_dir) and returns a DataFrame over the
whole tables: model queries lazily from the raw tables, downstream queries
from marts that the first of them builds. Output convention (shared with the SQL oracles): money is
rounded to cents and presented as DOUBLE."""

from __future__ import annotations

import uuid
from typing import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

from basketry.config import DRIVER_CONFIG as CFG
from basketry.functions.numeric import money
from basketry.operators.checks import null_count_summary, unique_ids
from basketry.operators.explore import explore
from basketry.operators.rollups import Slice
from basketry.plans import faults as ft
from basketry.plans import forecast as fc
from basketry.plans import quality as dq
from basketry.plans import reports as rp
from basketry.plans import semantic as sm
from basketry.plans.marts import Marts, exercise_6_orders_segmented, order_product_summary
from basketry.session import input_version
from basketry.sources.buckets import store
from basketry.sources.readers import load_profile, null_counts


def present(df: DataFrame) -> DataFrame:
    """Decimal columns -> cents as DOUBLE; everything else unchanged."""
    return df.select(*[money(F.col(f.name)).alias(f.name) if isinstance(f.dataType, DecimalType)
                       else F.col(f.name) for f in df.schema.fields])


_MARTS: dict = {}
_BUILT: dict = {}
_BUCKETS: dict = {}


def _cached(cache: dict, spark: SparkSession, sf_dir: str, make) -> Marts:
    """The cached value for this session and data folder, made anew when the
    order or line table has been written since."""
    folder = sf_dir.rstrip("/")
    key = (id(spark), spark.sparkContext.applicationId, folder)
    version = input_version(spark, [f"{folder}/orders.parquet", f"{folder}/lineitem.parquet"])
    if key not in cache or cache[key][0] != version:
        cache[key] = (version, make())
    return cache[key][1]


def _marts(spark: SparkSession, sf_dir: str) -> Marts:
    """One lazily built set of model plans per session and data folder: the
    plans (not data) are shared by all queries, like views, so plan
    construction and analysis are paid once. ``refresh()`` drops them."""
    return _cached(_MARTS, spark, sf_dir, lambda: Marts.from_tables(spark, sf_dir, CFG))


def _built(spark: SparkSession, sf_dir: str) -> Marts:
    """The marts materialised once per session and state of the data folder
    (written under the shared folder named by ``spark.checkpoint.dir``).
    Reports, checks, metrics and forecasts read these tables, as dashboards
    read the published marts; the first of them runs the build, and an error
    in it is raised. The model queries themselves compute from raw."""
    return _cached(_BUILT, spark, sf_dir, lambda: _marts(spark, sf_dir).materialize(spark))


def set_built(spark: SparkSession, sf_dir: str, marts: Marts) -> None:
    """Use ``marts``, built by the caller, for the downstream queries."""
    _BUILT.pop((id(spark), spark.sparkContext.applicationId, sf_dir.rstrip("/")), None)
    _cached(_BUILT, spark, sf_dir, lambda: marts)


def refresh() -> None:
    _MARTS.clear()
    _BUILT.clear()
    _BUCKETS.clear()


def _b(frames: Callable[[Marts], tuple], per_order) -> Callable[[SparkSession, str], DataFrame]:
    """A query order by order over (headers, lines) stored by order id, once
    per session and state of the data folder."""
    def run(spark, sf_dir):
        stored = _cached(_BUCKETS.setdefault(frames, {}), spark, sf_dir, lambda: store(spark, *frames(_marts(spark, sf_dir))))
        return present(stored.apply(per_order))
    return run


def _largest_order(m: Marts) -> DataFrame:
    """The lines of the order with the largest net sales."""
    best = m.mart_orders.orderBy(F.desc("net_sales"), "order_id").select("order_id").first()
    return sm.drill(m.lookup("mart_order_lines", [r for r in best or []]), None, sm.LINE_DETAIL)


def _staged(m: Marts) -> tuple:
    return m.stg_orders, m.stg_lines


def _faulted_headers(m: Marts) -> tuple:
    return ft.faulted_headers(m.stg_orders, m.stg_lines), m.stg_lines


def _faulted_lines(m: Marts) -> tuple:
    return m.stg_orders, ft.faulted_lines(m.stg_lines)


def _q(build: Callable[[Marts], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    """A model query: computed from the raw tables."""
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return present(build(_marts(spark, sf_dir)))
    run.__doc__ = build.__doc__
    return run


def _r(build: Callable[[Marts], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    """A downstream query: reads the materialised marts."""
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return present(build(_built(spark, sf_dir)))
    run.__doc__ = build.__doc__
    return run


def _d(build: Callable) -> Callable[[SparkSession, str], DataFrame]:
    """A report over daily sums of orders: ``build(days, cfg)``."""
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        m = _built(spark, sf_dir)
        return present(build(m.orders_by_day(spark), m.cfg))
    return run


def _m(view, mart: str, build: Callable) -> Callable[[SparkSession, str], DataFrame]:
    """A metric query: ``build(view, mart, rollups)``; the smallest stored
    aggregate that covers it is read, else the mart."""
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        m = _built(spark, sf_dir)
        return present(build(view(m.cfg), getattr(m, mart), m.rollups_of(spark, mart)))
    return run


def _mo(dims, measures, grain=None):
    return _m(sm.orders_view, "mart_orders", lambda v, df, r: explore(
        v, df, dims, measures, params={"date_granularity": grain} if grain else None, rollups=r))


def _ml(dims, measures):
    return _m(sm.order_lines_view, "mart_order_lines", lambda v, df, r: explore(v, df, dims, measures, rollups=r))


_ORDERS_MEASURES = ["order_count", "total_net_sales", "average_order_value", "total_products",
                    "average_products_per_order", "unique_customers", "new_customer_orders",
                    "returning_customer_orders", "vip_orders", "new_customer_revenue",
                    "returning_customer_revenue", "vip_revenue"]
_LINE_MEASURES = ["total_net_sales", "total_quantity", "order_count", "unique_customers", "unique_products",
                  "average_revenue_per_unit", "average_quantity_per_order", "new_customer_revenue",
                  "returning_customer_revenue", "vip_revenue"]


def _by_market_segment(m: Marts, spark: SparkSession, sf_dir: str) -> DataFrame:
    from basketry.sources.tpch import read_table
    return fc.with_dimension(m.mart_orders, read_table(spark, sf_dir, "customer"), "customer_id", "c_custkey",
                             "c_mktsegment", "market_segment")


def _by_nation(m: Marts, spark: SparkSession, sf_dir: str) -> DataFrame:
    from basketry.sources.tpch import read_table
    cust = fc.with_dimension(read_table(spark, sf_dir, "customer"), read_table(spark, sf_dir, "nation"),
                             "c_nationkey", "n_nationkey", "n_name", "nation")
    return fc.with_dimension(m.mart_orders, cust, "customer_id", "c_custkey", "nation", "nation")


def _by_customer_group(m: Marts) -> DataFrame:
    group = F.col("customer_id") % 3
    return m.mart_orders.withColumn("customer_group", F.when(group > 0, group.cast("string")))


def _by_brand(m: Marts, spark: SparkSession, sf_dir: str) -> DataFrame:
    from basketry.sources.tpch import read_table
    return fc.with_dimension(m.mart_order_lines, read_table(spark, sf_dir, "part"), "product_id", "p_partkey",
                             "p_brand", "brand")


def _rs(build: Callable[[Marts, SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    """A downstream query that also reads dimension tables."""
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return present(build(_built(spark, sf_dir), spark, sf_dir))
    return run


def _round_cols(df: DataFrame, cols, digits: int) -> DataFrame:
    return df.select(*[F.round(c, digits).alias(c) if c in cols else F.col(c) for c in df.columns])


def _loaded(kind: str):
    """A raw table as the load reads it: written as CSV with a header from the
    test tables, read with the declared schema and required columns."""
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        from basketry.session import shared_table_root
        from basketry.sources import readers
        path = f"{shared_table_root(spark)}/load-{uuid.uuid4().hex}"
        getattr(_marts(spark, sf_dir), kind).write.option("header", "true").csv(path)
        load = readers.load_orders if kind == "raw_orders" else readers.load_sales
        return present(load_profile(load(spark, path, fmt="csv"), "date_date"))
    return run


def _in_namespace(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raw headers loaded into a table of a namespace, read by its name."""
    from basketry.session import shared_table_root
    from basketry.sources import sinks
    path = f"{shared_table_root(spark)}/load-{uuid.uuid4().hex}"
    sinks.write_table(_marts(spark, sf_dir).raw_orders, path)
    name = f"raw_orders_{uuid.uuid4().hex[:8]}"
    sinks.ensure_namespace(spark, "basketry_raw", f"{shared_table_root(spark)}/basketry_raw")
    sinks.register_table(spark, "basketry_raw", name, path)
    return present(load_profile(spark.table(f"basketry_raw.{name}"), "date_date"))


def _by_sql_function(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The segment rule as a SQL function over the order mart."""
    from basketry.functions.segments import register_sql_functions
    m = _built(spark, sf_dir)
    register_sql_functions(spark, m.cfg)
    return m.mart_orders.groupBy(F.expr("order_segment(prior_orders_last_12_months)").alias("segment")).agg(
        F.count(F.lit(1)).alias("orders"))


def _table_function(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = _built(spark, sf_dir)
    fc.register_table_function(spark, m.orders_by_day(spark))
    return _round_cols(spark.sql("SELECT * FROM v_sales_forecast_h(14)"), _FC, 2)


_FC = ["daily_net_sales", "forecast_value", "confidence_lower", "confidence_upper"]

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    # sources
    "raw_orders_profile": _q(lambda m: load_profile(m.raw_orders, "date_date")),
    "raw_orders_null_counts": _q(lambda m: null_counts(m.raw_orders)),
    "raw_sales_profile": _q(lambda m: load_profile(m.raw_sales, "date_date")),
    "load_csv_orders": _loaded("raw_orders"),
    "load_csv_sales": _loaded("raw_sales"),
    "load_into_namespace": _in_namespace,
    # staging / intermediate / marts
    "stg_orders": _q(lambda m: m.stg_orders),
    "stg_sales": _q(lambda m: m.stg_sales),
    "int_order_product_summary": _q(lambda m: m.order_product_summary),
    "int_order_customer_history": _q(lambda m: m.order_customer_history),
    "mart_orders": _q(lambda m: m.mart_orders),
    "mart_order_lines": _q(lambda m: m.mart_order_lines),
    "mart_product_summary": _q(lambda m: m.product_summary_dealt()),
    "mart_orders_presentation": _r(lambda m: m.mart_orders_presentation),
    "mart_order_lines_presentation": _r(lambda m: m.mart_order_lines_presentation),
    "exercise_4_orders_with_qty": _r(lambda m: m.exercise_4),
    "exercise_6_orders_segmented": _r(lambda m: m.exercise_6),
    # exercises
    "ex1_orders_in_year": _d(lambda days, cfg: rp.orders_in_year(days, cfg)),
    "ex2_orders_per_month": _d(lambda days, cfg: rp.orders_per_month(days, cfg)),
    "ex3_avg_qty_per_month": _d(lambda days, cfg: rp.avg_qty_per_month(days, cfg)),
    # insights
    "monthly_pattern": _d(lambda days, cfg: rp.monthly_pattern(days, cfg)),
    "quarter_share": _d(lambda days, cfg: rp.quarter_share(days, cfg)),
    "peak_month_ratio": _d(lambda days, cfg: rp.peak_month_ratio(days, cfg)),
    "segment_breakdown": _d(lambda days, cfg: rp.segment_breakdown(days, cfg)),
    "returning_vip_share": _d(lambda days, cfg: rp.returning_vip_share(days, cfg)),
    "overall_stats": _r(lambda m: rp.overall_stats(m.mart_orders, m.cfg)),
    "orphan_line_count": _r(lambda m: rp.orphan_line_count(m.stg_lines, m.stg_orders)),
    "same_day_collisions": _r(lambda m: rp.same_day_collisions(m.mart_orders)),
    "history_completeness": _d(lambda days, cfg: rp.history_completeness(days)),
    "revenue_reconciliation": _r(lambda m: rp.revenue_reconciliation(m.mart_orders, m.mart_order_lines)),
    "data_summary": _r(lambda m: rp.data_summary(m.stg_orders, m.stg_lines, m.mart_orders, m.mart_order_lines)),
    "freshness": _r(lambda m: rp.freshness(m.mart_orders)),
    # dashboard
    "kpi_tiles": _r(lambda m: rp.kpi_tiles(m.mart_orders_presentation)),
    "daily_trends": _d(lambda days, cfg: rp.daily_trends(days)),
    "month_contribution": _d(lambda days, cfg: rp.month_contribution(days)),
    "quarter_summary": _d(lambda days, cfg: rp.quarter_summary(days)),
    "sales_by_order_segment": _d(lambda days, cfg: rp.sales_by(days, "order_segmentation")),
    "sales_by_customer_profile": _d(lambda days, cfg: rp.sales_by(days, "customer_profile")),
    "segment_table": _d(lambda days, cfg: rp.segment_table(days)),
    "top_products_by_revenue": _r(lambda m: rp.top_products(m.mart_product_summary, "revenue", m.cfg.top_n)),
    "top_products_by_units": _r(lambda m: rp.top_products(m.mart_product_summary, "units", m.cfg.top_n)),
    "revenue_by_product": _r(lambda m: rp.revenue_by_product(m.mart_order_lines_presentation)),
    "units_histogram": _r(lambda m: rp.units_histogram(m.mart_order_lines_presentation,
                                                       m.cfg.histogram_bucket_width)),
    "segment_share_in_year": _d(lambda days, cfg: rp.segment_share_in_year(days, cfg)),
    "q4_revenue_share": _d(lambda days, cfg: rp.quarter_revenue_share(days, 4)),
    # data quality
    "dq_check_summary": _r(lambda m: dq.check_summary(m)),
    "dq_mart_orders_null_profile": _r(lambda m: null_count_summary(m.mart_orders, m.mart_orders.columns,
                                                                   "mart_orders")),
    "dq_invalid_segments": _r(lambda m: dq.invalid_segments(m.mart_orders)),
    "dq_order_lines_grain": _r(lambda m: dq.order_lines_grain(m.mart_order_lines)),
    "dq_order_sales_match": _r(lambda m: dq.order_sales_match(m.stg_orders, m.stg_lines)),
    "dq_positive_product_qty": _r(lambda m: dq.positive_product_qty(m.mart_orders)),
    "dq_lines_without_header": _r(lambda m: dq.lines_without_header(m.stg_lines, m.stg_orders)),
    "dq_segmentation_reconciliation": _r(lambda m: dq.segmentation_reconciliation(m.mart_orders, m.cfg)),
    "dq_profile_reconciliation": _r(lambda m: dq.profile_reconciliation(m.mart_orders, m.cfg)),
    "dq_year_count_match": _r(lambda m: dq.year_count_match(m.mart_orders, m.stg_orders, m.cfg)),
    "dq_segmented_year_count_match": _r(lambda m: dq.segmented_year_count_match(m.exercise_6, m.stg_orders, m.cfg)),
    "dq_monthly_count_match": _r(lambda m: dq.monthly_count_match(m.mart_orders, m.stg_orders, m.cfg)),
    "dq_order_grain_in_year": _r(lambda m: dq.order_grain_in_year(m.mart_orders, m.cfg)),
    "dq_prior_count_reconciliation": _r(lambda m: dq.prior_count_reconciliation(m.mart_orders, m.stg_orders, m.cfg)),
    # the same checks over the whole tables with faults put in
    "faults_invalid_segments": _r(lambda m: dq.invalid_segments(ft.faulted_mart(m.mart_orders)).select(
        "order_id", "order_segmentation")),
    "faults_lines_without_header": _r(lambda m: dq.lines_without_header(ft.faulted_lines(m.stg_lines), m.stg_orders)),
    "faults_orphan_line_count": _r(lambda m: rp.orphan_line_count(ft.faulted_lines(m.stg_lines), m.stg_orders)),
    "faults_segmentation_reconciliation": _r(lambda m: dq.segmentation_reconciliation(
        ft.faulted_mart(m.mart_orders), m.cfg)),
    "faults_profile_reconciliation": _r(lambda m: dq.profile_reconciliation(ft.faulted_mart(m.mart_orders), m.cfg)),
    "faults_prior_count_reconciliation": _r(lambda m: dq.prior_count_reconciliation(
        ft.faulted_mart(m.mart_orders), m.stg_orders, m.cfg)),
    "faults_year_count_match": _r(lambda m: dq.year_count_match(ft.faulted_mart(m.mart_orders), m.stg_orders, m.cfg)),
    "faults_segmented_year_count_match": _r(lambda m: dq.segmented_year_count_match(
        exercise_6_orders_segmented(ft.faulted_mart(m.mart_orders), m.cfg), m.stg_orders, m.cfg)),
    "faults_monthly_count_match": _r(lambda m: dq.monthly_count_match(
        ft.faulted_mart(m.mart_orders), m.stg_orders, m.cfg)),
    "faults_order_grain_in_year": _r(lambda m: dq.order_grain_in_year(ft.faulted_mart(m.mart_orders), m.cfg)),
    "faults_order_sales_match": _r(lambda m: dq.order_sales_match(
        ft.faulted_headers(m.stg_orders, m.stg_lines), m.stg_lines)),
    # over headers and lines stored by order id: no exchange over either
    "bucketed_order_product_summary": _b(_staged, order_product_summary),
    "bucketed_order_sales_match": _b(_faulted_headers, dq.order_sales_match),
    "bucketed_lines_without_header": _b(_faulted_lines, lambda o, l: dq.lines_without_header(l, o)),
    "faults_unique_order_ids": _r(lambda m: unique_ids(ft.doubled_headers(m.stg_orders), "order_id")),
    "lookup_largest_order": _r(_largest_order),
    # metric layer
    "metrics_orders_by_month": _mo(["order_date_at_selected_grain"], _ORDERS_MEASURES, "month"),
    "metrics_orders_by_week": _mo(["order_date_at_selected_grain"], ["order_count", "total_net_sales", "unique_customers"], "week"),
    "metrics_orders_by_day": _mo(["order_date_at_selected_grain"], [
        "order_count", "total_net_sales", "average_order_value", "total_products"], "day"),
    "metrics_orders_by_quarter_segment": _mo(["order_date_at_selected_grain", "order_segmentation"], [
        "order_count", "total_net_sales", "unique_customers", "average_products_per_order"], "quarter"),
    "metrics_lines_by_month_profile": _ml(["order_date_month", "customer_profile"], [
        "total_net_sales", "total_quantity", "order_count", "unique_customers", "average_revenue_per_unit",
        "average_quantity_per_order"]),
    "metrics_segmentation_reconciliation": _mo(
        ["segmentation_reconciliation", "derived_order_segmentation"], ["order_count"]),
    "metrics_orders_by_segment_profile": _mo(["order_segmentation", "customer_profile"], [
        "order_count", "total_net_sales", "average_order_value", "average_products_per_order", "unique_customers"]),
    "metrics_lines_by_product": _ml(["product_id"], _LINE_MEASURES),
    "metrics_lines_by_quarter_segment": _ml(["order_date_quarter", "order_segmentation"], [
        "total_net_sales", "total_quantity", "order_count", "unique_products"]),
    "metrics_vip_revenue_by_quarter": _m(sm.orders_view, "mart_orders", lambda v, df, r: sm.focus_metric(
        v, df, ["order_date_at_selected_grain"], "revenue", "VIP", {"date_granularity": "quarter"}, r)),
    "metrics_orders_by_raw_date": _mo(["order_date_raw"], ["order_count", "total_products"]),
    "metrics_orders_by_date": _mo(["order_date_date"], ["order_count", "vip_orders"]),
    "metrics_orders_by_week_start": _mo(["order_date_week"], ["order_count", "total_net_sales"]),
    "metrics_lines_by_year": _ml(["order_date_year"], ["total_net_sales", "unique_products"]),
    "metrics_orders_by_net_sales": _mo(["net_sales"], ["order_count", "unique_customers"]),
    "metrics_lines_by_net_sales": _ml(["net_sales"], ["total_quantity", "order_count"]),
    **{f"metrics_focus_{focus}": _m(sm.orders_view, "mart_orders", lambda v, df, r, focus=focus: sm.focus_metric(
        v, df, ["order_segmentation", "customer_profile"], focus, rollups=r)) for focus in sm.METRIC_FOCUS},
    **{f"metrics_product_focus_{focus}": _m(sm.order_lines_view, "mart_order_lines", lambda v, df, r, focus=focus: sm.focus_metric(
        v, df, ["product_id"], focus, "Returning", rollups=r)) for focus in sm.PRODUCT_METRIC_FOCUS},
    "dashboard_filtered_kpis": _r(lambda m: rp.kpi_tiles(Slice(
        m.cfg.two_year_start, m.cfg.year_end, profile="VIP", complete_only=True).over(m.mart_orders_presentation))),
    "drill_vip_orders_in_year": _r(lambda m: sm.drill(m.mart_orders, Slice(
        m.cfg.year_start, m.cfg.year_end, segment="VIP"), sm.ORDER_DETAIL)),
    "drill_new_customer_lines_in_year": _r(lambda m: sm.drill(m.mart_order_lines, Slice(
        m.cfg.year_start, m.cfg.year_end, segment="New"), sm.LINE_DETAIL)),
    # time series and forecast
    "daily_sales_zero_filled": _d(lambda days, cfg: fc.daily_series(days)),
    "daily_sales_actuals": _d(lambda days, cfg: fc.daily_actuals(days)),
    "days_without_orders": _r(lambda m: fc.days_without_orders(m.mart_orders)),
    "forecast_row_counts": _d(lambda days, cfg: fc.row_counts(fc.sales_forecast_all(days))),
    "sales_forecast": _d(lambda days, cfg: _round_cols(fc.sales_forecast(days), _FC, 2)),
    "sales_forecast_all": _d(lambda days, cfg: _round_cols(fc.sales_forecast_all(days), _FC, 2)),
    "sales_forecast_by_segment": _r(lambda m: _round_cols(
        fc.sales_forecast(m.mart_orders, ["order_segmentation"]), _FC, 2)),
    # sse is presented unrounded: it is bit-identical across engines, while a
    # two-digit round of a value above 2**53 / 100 is not exact in every engine.
    "forecast_models_by_segment": _r(lambda m: _round_cols(
        fc.fitted_models(m.mart_orders, ["order_segmentation"]), ["level", "sigma"], 2)),
    "sales_forecast_by_market_segment": _rs(lambda m, s, d: _round_cols(
        fc.sales_forecast(_by_market_segment(m, s, d), ["market_segment"]), _FC, 2)),
    "forecast_models_by_nation": _rs(lambda m, s, d: _round_cols(
        fc.fitted_models(_by_nation(m, s, d), ["nation"]), ["level", "sigma"], 2)),
    "forecast_backtest_by_brand": _rs(lambda m, s, d: _round_cols(
        fc.backtest(_by_brand(m, s, d), ["brand"]), ["mae", "rmse", "mape", "me", "actual_sum", "forecast_sum"], 4)),
    "forecast_backtest": _d(lambda days, cfg: _round_cols(
        fc.backtest(days), ["mae", "rmse", "mape", "me", "actual_sum", "forecast_sum"], 4)),
    # a series key that is NULL for a third of the customers, and series that
    # are no longer than a hold-out
    "sales_forecast_by_customer_group": _r(lambda m: _round_cols(
        fc.sales_forecast(_by_customer_group(m), ["customer_group"]), _FC, 2)),
    "forecast_backtest_by_month": _r(lambda m: _round_cols(
        fc.backtest(m.mart_orders, ["order_month_start"]),
        ["mae", "rmse", "mape", "me", "actual_sum", "forecast_sum"], 4)),
    "forecast_latest_days": _d(lambda days, cfg: _round_cols(fc.latest_days(fc.sales_forecast(days), 5), _FC, 2)),
    "order_segment_sql_function": _by_sql_function,
    "sales_forecast_table_function": _table_function,
    "sales_forecast_horizon_14": _d(lambda days, cfg: _round_cols(
        fc.horizon_view(fc.sales_forecast_all(days), 14), _FC, 2)),
}
