"""The two metric views (orders, order lines) for grouped business metrics.

Each view is a catalogue of dimensions and measures over one mart; grains
are never mixed (no join between the views). Distinct counts are non-additive:
they come from the mart at the requested grain, or from the merged bitmaps of
a stored rollup. :data:`ROLLUPS` is the lattice of stored aggregates.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketry.config import Config
from basketry.functions.dates import date_at_grain
from basketry.functions.numeric import safe_divide
from basketry.functions.segments import NEW, RETURNING, VIP, order_segment
from basketry.operators.explore import Dimension, Measure, View, explore
from basketry.operators.rollups import Rollup, Slice

# Fixed parameter choices of the views.
GRAINS = ("day", "week", "month", "quarter")
METRIC_FOCUS = {"revenue": "total_net_sales", "orders": "order_count",
                "aov": "average_order_value", "basket": "average_products_per_order"}
SEGMENT_FOCUS = ("All", NEW, RETURNING, VIP)
PRODUCT_METRIC_FOCUS = {"revenue": "total_net_sales", "units": "total_quantity", "orders": "order_count"}


def _col(name):
    return Dimension(name, lambda params=None: F.col(name), columns=(name,))


def _selected_grain(params):
    return date_at_grain(F.col("order_date"), _granularity(params)).cast("string")


def _granularity(params):
    return (params or {}).get("date_granularity", "month")


def _timeframes():
    def at(name, grain, expr):
        return Dimension(name, lambda p=None: expr(F.col("order_date")), columns=("order_date",), grain=lambda p: grain)
    return {d.name: d for d in (
        at("order_date_raw", "day", lambda d: d), at("order_date_date", "day", lambda d: d),
        at("order_date_week", "week", lambda d: date_at_grain(d, "week")),
        at("order_date_month", "month", lambda d: date_at_grain(d, "month")),
        at("order_date_quarter", "quarter", lambda d: date_at_grain(d, "quarter")),
        at("order_date_year", "year", lambda d: F.year(d).cast("bigint")))}


SEGMENT = "order_segmentation"


def _seg_count(name, seg):
    return Measure(name, lambda: F.count_if(F.col(SEGMENT) == seg), stored=(SEGMENT, "order_count"),
                   rolled=lambda: F.coalesce(F.sum(F.when(F.col(SEGMENT) == seg, F.col("order_count"))), F.lit(0)).cast("bigint"))


def _seg_sum(name, seg):
    total = lambda: F.sum(F.when(F.col(SEGMENT) == seg, F.col("net_sales")).otherwise(F.lit(0)))
    return Measure(name, total, stored=(SEGMENT, "net_sales"), rolled=total)


def _sum(name, column):
    return Measure(name, lambda: F.sum(column), stored=(column,), rolled=lambda: F.sum(column))


def _distinct(name, column):
    return Measure(name, lambda: F.countDistinct(column), additive=False, ids=column)


def _average(name, column, average):
    """An average from the sum and the number of the values that are there."""
    n = f"{column}_count"
    return Measure(name, lambda: F.avg(column), stored=(column, n),
                   rolled=lambda: average(F.sum(column), F.nullif(F.sum(n), F.lit(0))))


def _numeric_quotient(total, n):
    """With the digits that ``avg`` keeps of a NUMERIC(38,9)."""
    exact = total.try_cast("decimal(30,9)") / n.cast("decimal(13,0)")
    return F.coalesce(exact.cast("decimal(38,13)"), (total / n).cast("decimal(38,13)"))


def _whole_quotient(total, n):
    return total.cast("double") / n.cast("double")


def orders_view(cfg: Config) -> View:
    derived = lambda: order_segment("prior_orders_last_12_months", cfg)
    dims = {
        "order_date_at_selected_grain": Dimension("order_date_at_selected_grain", _selected_grain,
                                                  columns=("order_date",), grain=_granularity),
        **_timeframes(),
        **{c: _col(c) for c in (
            "net_sales", "qty_product", "product_line_count", "distinct_product_count", "order_segmentation",
            "customer_profile", "has_complete_12_month_history", "order_id", "customer_id",
            "prior_orders_last_12_months")},
        # Hidden validation dimensions.
        "derived_order_segmentation": Dimension("derived_order_segmentation", lambda p=None: derived()),
        "segmentation_reconciliation": Dimension(
            "segmentation_reconciliation", lambda p=None: F.col(SEGMENT) == derived()),
    }
    # the stored sums of net_sales and qty_product are measures, not dimensions
    for c in ("net_sales", "qty_product"):
        dims[c] = Dimension(c, lambda p=None, c=c: F.col(c))
    measures = {m.name: m for m in (
        Measure("order_count", lambda: F.count(F.lit(1)), stored=("order_count",),
                rolled=lambda: F.coalesce(F.sum("order_count"), F.lit(0)).cast("bigint")),
        _sum("total_net_sales", "net_sales"),
        _average("average_order_value", "net_sales", _numeric_quotient),
        _sum("total_products", "qty_product"),
        _average("average_products_per_order", "qty_product", _whole_quotient),
        _distinct("unique_customers", "customer_id"),
        _seg_count("new_customer_orders", NEW), _seg_count("returning_customer_orders", RETURNING),
        _seg_count("vip_orders", VIP),
        _seg_sum("new_customer_revenue", NEW), _seg_sum("returning_customer_revenue", RETURNING),
        _seg_sum("vip_revenue", VIP))}
    params = {"date_granularity": (GRAINS, "month"),
              "metric_focus": (tuple(METRIC_FOCUS), "revenue"),
              "segment_focus": (SEGMENT_FOCUS, "All")}
    return View("orders", dims, measures, {}, params)


def order_lines_view(cfg: Config) -> View:
    dims = {
        **_timeframes(),
        **{c: _col(c) for c in (
            "product_id", "order_segmentation", "customer_profile",
            "has_complete_12_month_history", "revenue_per_unit", "order_id", "customer_id")},
        **{c: Dimension(c, lambda p=None, c=c: F.col(c)) for c in ("quantity", "net_sales")},
    }
    measures = {m.name: m for m in (
        _sum("total_net_sales", "net_sales"), _sum("total_quantity", "quantity"),
        _distinct("order_count", "order_id"), _distinct("unique_customers", "customer_id"),
        _distinct("unique_products", "product_id"),
        _seg_sum("new_customer_revenue", NEW), _seg_sum("returning_customer_revenue", RETURNING),
        _seg_sum("vip_revenue", VIP))}
    derived = {
        "average_revenue_per_unit": (["total_net_sales", "total_quantity"],
                                     lambda: safe_divide("total_net_sales", "total_quantity")),
        "average_quantity_per_order": (["total_quantity", "order_count"],
                                       lambda: safe_divide(F.col("total_quantity").cast("double"), "order_count")),
    }
    params = {"product_metric_focus": (tuple(PRODUCT_METRIC_FOCUS), "revenue"),
              "product_segment_focus": (SEGMENT_FOCUS, "All")}
    return View("order_lines", dims, measures, derived, params)


def segment_filter(segment: str):
    """The segment choice as a filter; 'All' means no filter."""
    return focus_slice(segment).column()


def focus_slice(segment: str) -> Slice:
    if segment not in SEGMENT_FOCUS:
        raise ValueError(f"segment must be one of {SEGMENT_FOCUS}")
    return Slice(segment=None if segment == "All" else segment)


def dashboard_filter(date_from=None, date_to=None, segment=None, profile=None, complete_only=None):
    """The dashboard's filter bar as one predicate over a mart (``None`` = not
    set)."""
    return Slice(date_from, date_to, segment, profile, complete_only).column()


def focus_metric(view: View, df: DataFrame, dimensions, focus: str, segment: str = "All",
                 params: dict | None = None, rollups=()) -> DataFrame:
    """Metric choice -> measure, segment choice -> filter."""
    mapping = METRIC_FOCUS if view.name == "orders" else PRODUCT_METRIC_FOCUS
    if focus not in mapping:
        raise ValueError(f"focus must be one of {tuple(mapping)}")
    return explore(view, df, dimensions, [mapping[focus]], focus_slice(segment), params, rollups)


_PLAIN = ("order_segmentation", "customer_profile", "has_complete_12_month_history")
_ORDER_SUMS = {"order_count": lambda: F.count(F.lit(1)), "net_sales": lambda: F.sum("net_sales"),
               "net_sales_count": lambda: F.count("net_sales"), "qty_product": lambda: F.sum("qty_product"),
               "qty_product_count": lambda: F.count("qty_product")}
_LINE_SUMS = {"net_sales": lambda: F.sum("net_sales"), "quantity": lambda: F.sum("quantity"),
              "order_line_count": lambda: F.count(F.lit(1))}
#: The stored aggregates, parents before children. Days keep the customers'
#: words, at most one an order; the line mart's three id sets are
#: kept by month.
ROLLUPS = [
    Rollup("orders_by_day", "mart_orders", "day", _PLAIN, _ORDER_SUMS, ("customer_id",)),
    Rollup("orders_by_month", "mart_orders", "month", _PLAIN, _ORDER_SUMS, ("customer_id",), "orders_by_day"),
    Rollup("lines_by_day", "mart_order_lines", "day", _PLAIN, _LINE_SUMS),
    Rollup("lines_by_month", "mart_order_lines", "month", _PLAIN, _LINE_SUMS, ("order_id", "customer_id", "product_id"),
           "lines_by_day"),
    Rollup("lines_by_product", "mart_order_lines", None, ("product_id", "order_segmentation"), _LINE_SUMS),
]


# Fixed drill-down column sets.
ORDER_DETAIL = ("order_id", "customer_id", "order_date", "net_sales", "qty_product",
                "order_segmentation", "customer_profile")
LINE_DETAIL = ("order_id", "product_id", "order_date", "quantity", "net_sales", "revenue_per_unit",
               "order_segmentation", "customer_profile")


def drill(df: DataFrame, predicate, columns=ORDER_DETAIL) -> DataFrame:
    """Rows behind a measure value: the group's predicate (a Column, or a
    Slice), detail columns."""
    if isinstance(predicate, Slice):
        return predicate.over(df).select(*columns)
    return (df.where(predicate) if predicate is not None else df).select(*columns)
