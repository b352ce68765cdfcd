"""Report and insight queries over the marts.

Every report is one aggregation pass over a mart, or, where it asks for sums
only, over the stored aggregate by day that has the mart's column names (plus at most a tiny
post-aggregation over a frame whose size is bounded by the calendar or by the
number of segment labels). Shares of a total use a window over that small
aggregated frame, never over raw rows; combining totals of two different
tables is done by a union of one-row aggregates, not by a cross join.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from basketry.config import Config
from basketry.functions.dates import in_range, month_abbrev, month_start, within
from basketry.functions.numeric import safe_divide
from basketry.functions.segments import RETURNING, VIP


def _year(mart: DataFrame, cfg: Config) -> DataFrame:
    return within(mart, cfg.year_start, cfg.year_end)


def n_orders(df: DataFrame, where=None):
    """Number of orders (that pass ``where``): of rows of the mart, or of the
    orders that a stored aggregate's rows stand for."""
    if "net_sales_count" not in df.columns:
        return F.count(F.lit(1)) if where is None else F.count_if(where)
    orders = F.col("order_count") if where is None else F.when(where, F.col("order_count"))
    return F.coalesce(F.sum(orders), F.lit(0)).cast("bigint")


def _mean_quantity(df: DataFrame):
    if "qty_product_count" not in df.columns:
        return F.avg("qty_product")
    return F.sum("qty_product").cast("double") / F.nullif(F.sum("qty_product_count"), F.lit(0)).cast("double")


def _share_of_total(df: DataFrame, col: str, out: str, digits: int = 1) -> DataFrame:
    """Share of the column total; ``df`` is an already aggregated frame with a
    bounded number of rows, so the global window is cheap."""
    total = F.sum(col).over(Window.partitionBy())
    return df.withColumn(out, F.round(safe_divide(F.col(col) * F.lit(100.0), total), digits))


def union_all(frames) -> DataFrame:
    """Union of many frames by name, built as a balanced tree: each union
    step analyses only its two inputs, so building n branches costs
    O(n log n) analysis instead of O(n^2) for a left-deep chain. Catalyst
    flattens the tree into one n-ary Union."""
    frames = list(frames)
    while len(frames) > 1:
        nxt = [frames[i].unionByName(frames[i + 1], allowMissingColumns=True)
               for i in range(0, len(frames) - 1, 2)]
        if len(frames) % 2:
            nxt.append(frames[-1])
        frames = nxt
    return frames[0]


def combine_rows(*frames: DataFrame) -> DataFrame:
    """Merge one-row frames with disjoint columns into one row (union of
    the rows, then a global aggregate)."""
    cols = [c for f in frames for c in f.columns]
    merged = union_all(frames)
    return merged.agg(*[F.max(c).alias(c) for c in cols])


# -- exercises ------------------------------------------------------------

def orders_in_year(mart: DataFrame, cfg: Config) -> DataFrame:
    return _year(mart, cfg).agg(n_orders(mart).alias("nb_orders"))


def orders_per_month(mart: DataFrame, cfg: Config) -> DataFrame:
    return (_year(mart, cfg).groupBy(month_start("order_date").alias("order_month"))
            .agg(n_orders(mart).alias("nb_orders")).orderBy("order_month"))


def avg_qty_per_month(mart: DataFrame, cfg: Config) -> DataFrame:
    return (_year(mart, cfg).groupBy(month_start("order_date").alias("order_month"))
            .agg(F.round(_mean_quantity(mart), 2).alias("avg_qty_products_per_order"))
            .orderBy("order_month"))


# -- insights -------------------------------------------------------------

def monthly_pattern(mart: DataFrame, cfg: Config) -> DataFrame:
    return (_year(mart, cfg)
            .groupBy(month_abbrev("order_date").alias("month_name"),
                     F.month("order_date").cast("bigint").alias("month_num"))
            .agg(n_orders(mart).alias("orders"),
                 F.sum("qty_product").alias("total_qty"),
                 F.round(safe_divide(F.sum("qty_product").cast("double"), n_orders(mart)), 2)
                 .alias("avg_products_per_order"),
                 F.round(F.sum("net_sales"), 2).alias("total_revenue"))
            .orderBy("month_num"))


def quarter_share(mart: DataFrame, cfg: Config, quarter: int = 4) -> DataFrame:
    """Orders of one quarter of the report year and their share of the year
    (one pass with a conditional count instead of a scalar subquery)."""
    in_q = F.quarter("order_date") == quarter
    return _year(mart, cfg).agg(
        n_orders(mart, in_q).alias("quarter_orders"),
        F.round(safe_divide(n_orders(mart, in_q) * F.lit(100.0), n_orders(mart)), 1).alias("pct_of_year"),
    )


def peak_month_ratio(mart: DataFrame, cfg: Config) -> DataFrame:
    """Busiest and quietest month of the report year and their ratio; ties go
    to the earlier month."""
    monthly = _year(mart, cfg).groupBy(F.month("order_date").cast("bigint").alias("m")).agg(
        n_orders(mart).alias("cnt"))
    top = F.max_by(F.struct("cnt", "m"), F.struct(F.col("cnt"), -F.col("m")))
    low = F.min_by(F.struct("cnt", "m"), F.struct(F.col("cnt"), F.col("m")))
    return monthly.agg(top.alias("hi"), low.alias("lo")).select(
        F.col("hi.cnt").alias("max_orders"), F.col("lo.cnt").alias("min_orders"),
        F.col("hi.m").alias("max_month"), F.col("lo.m").alias("min_month"),
        F.round(safe_divide(F.col("hi.cnt").cast("double"), F.col("lo.cnt")), 2).alias("max_min_ratio"),
    )


def segment_breakdown(mart: DataFrame, cfg: Config, dim: str = "order_segmentation") -> DataFrame:
    agg = _year(mart, cfg).groupBy(dim).agg(
        n_orders(mart).alias("orders"), F.round(F.sum("net_sales"), 2).alias("revenue"))
    return _share_of_total(agg, "orders", "pct").select(dim, "orders", "pct", "revenue").orderBy(F.desc("orders"))


def returning_vip_share(mart: DataFrame, cfg: Config) -> DataFrame:
    hit = F.col("order_segmentation").isin(RETURNING, VIP)
    return _year(mart, cfg).agg(
        n_orders(mart, hit).alias("orders"),
        F.round(safe_divide(n_orders(mart, hit) * F.lit(100.0), n_orders(mart)), 1).alias("pct"),
    )


def overall_stats(mart: DataFrame, cfg: Config) -> DataFrame:
    return mart.agg(
        F.count(F.lit(1)).alias("total_orders"),
        F.count_if(in_range("order_date", cfg.year_start, cfg.year_end)).alias("orders_report_year"),
        F.count_if(in_range("order_date", cfg.two_year_start, cfg.year_start)).alias("orders_previous_year"),
        F.round(F.sum("net_sales"), 2).alias("total_revenue"),
        F.round(safe_divide(F.sum("net_sales"), F.count(F.lit(1))), 2).alias("aov"),
        F.countDistinct("customer_id").alias("unique_customers"),
    )


def orphan_lines(stg_sales: DataFrame, stg_orders: DataFrame) -> DataFrame:
    """Lines without a header; a NULL order id counts as an orphan."""
    hdr = stg_orders.select(F.col("order_id").alias("__hdr"))
    return stg_sales.join(hdr, F.col("order_id") == F.col("__hdr"), "left_anti")


def orphan_line_count(stg_sales: DataFrame, stg_orders: DataFrame) -> DataFrame:
    return orphan_lines(stg_sales, stg_orders).agg(F.count(F.lit(1)).alias("orphan_lines"))


def same_day_groups(mart: DataFrame) -> DataFrame:
    return (mart.groupBy("customer_id", "order_date").agg(F.count(F.lit(1)).alias("cnt"))
            .where("cnt > 1"))


def same_day_collisions(mart: DataFrame) -> DataFrame:
    """Customer/day groups with several orders: number of groups, distinct
    customers and order rows involved."""
    return same_day_groups(mart).agg(
        F.count(F.lit(1)).alias("affected_groups"),
        F.countDistinct("customer_id").alias("affected_customers"),
        F.coalesce(F.sum("cnt"), F.lit(0).cast("bigint")).alias("affected_rows"),
    )


def history_completeness(mart: DataFrame) -> DataFrame:
    f = F.col("has_complete_12_month_history")
    return mart.agg(n_orders(mart, f).alias("full_history"), n_orders(mart, ~f).alias("partial_history"),
                    n_orders(mart).alias("total"))


def revenue_reconciliation(mart: DataFrame, lines: DataFrame) -> DataFrame:
    row = combine_rows(mart.agg(F.sum("net_sales").alias("order_total")),
                       lines.agg(F.sum("net_sales").alias("sales_total")))
    return row.select("order_total", "sales_total",
                      F.abs(F.col("order_total") - F.col("sales_total")).alias("difference"))


def data_summary(stg_orders: DataFrame, stg_sales: DataFrame, mart: DataFrame, lines: DataFrame) -> DataFrame:
    """The data-quality headline numbers in one row."""
    hdr = stg_orders.agg(F.count(F.lit(1)).alias("orders"),
                         F.countDistinct("customer_id").alias("unique_customers"))
    # additive totals and distinct counts as separate aggregates: the decimal
    # sum buffers stay out of the rows expanded for the distinct counts
    raw = stg_sales.agg(F.count(F.lit(1)).alias("sales_lines"),
                        F.sum("qty").alias("units_raw"),
                        F.sum("line_net_sales").alias("revenue_raw"))
    raw_distinct = stg_sales.agg(F.countDistinct("product_id").alias("unique_products"),
                                 F.countDistinct("order_id").alias("orders_with_lines_raw"))
    mrt = lines.agg(F.count(F.lit(1)).alias("mart_lines"),
                    F.sum("quantity").alias("units_mart"),
                    F.sum("net_sales").alias("revenue_mart"))
    orph = orphan_line_count(stg_sales, stg_orders)
    same = same_day_collisions(mart)
    row = combine_rows(hdr, raw, raw_distinct, mrt, orph, same)
    return row.withColumn("revenue_excluded", F.col("revenue_raw") - F.col("revenue_mart"))


def freshness(mart: DataFrame) -> DataFrame:
    return mart.agg(F.max("order_date").alias("max_order_date"))


# -- dashboard --------------------------------------------------------------

def kpi_tiles(presentation: DataFrame) -> DataFrame:
    return presentation.agg(
        F.round(F.sum("net_sales"), 2).alias("net_sales"),
        F.sum("order_count").alias("orders"),
        F.round(safe_divide(F.sum("net_sales"), F.sum("order_count")), 2).alias("average_order_value"),
        F.sum("qty_product").alias("products_sold"),
        F.round(safe_divide(F.sum("qty_product").cast("double"), F.sum("order_count")), 2)
        .alias("products_per_order"),
        F.countDistinct("customer_ref").alias("unique_customers"),
    )


def daily_trends(mart: DataFrame) -> DataFrame:
    return mart.groupBy("order_date").agg(
        F.round(F.sum("net_sales"), 2).alias("net_sales"),
        n_orders(mart).alias("orders"),
        F.round(safe_divide(F.sum("net_sales"), n_orders(mart)), 2).alias("average_order_value"),
    )


def month_contribution(mart: DataFrame) -> DataFrame:
    """Revenue and orders per month with half-year and year subtotals and the
    grand total (rollup), each with its share of the grand total. Orders are
    aggregated to months first, so the rollup expands at most 13 rows per year
    and the total is a window over at most 19."""
    half = F.when(F.col("order_month") <= 6, F.lit(1)).otherwise(F.lit(2)).cast("bigint")
    months = mart.groupBy("order_year", "order_month").agg(
        F.sum("net_sales").alias("revenue"), n_orders(mart).alias("orders"))
    r = months.withColumn("order_half", half).rollup("order_year", "order_half", "order_month").agg(
        F.sum("revenue").alias("revenue"), F.sum("orders").alias("orders"),
        F.grouping_id().alias("gid"))
    grand = Window.partitionBy()
    tot_rev = F.max(F.when(F.col("gid") == 7, F.col("revenue"))).over(grand)
    tot_ord = F.max(F.when(F.col("gid") == 7, F.col("orders"))).over(grand)
    level = (F.when(F.col("gid") == 0, "month").when(F.col("gid") == 1, "half")
             .when(F.col("gid") == 3, "year").otherwise("total"))
    return r.select(
        level.alias("level"), "order_year", "order_half", "order_month",
        F.round("revenue", 2).alias("revenue"),
        F.round(safe_divide(F.col("revenue") * F.lit(100.0), tot_rev), 1).alias("revenue_pct"),
        "orders",
        F.round(safe_divide(F.col("orders") * F.lit(100.0), tot_ord), 1).alias("orders_pct"),
    )


def quarter_summary(mart: DataFrame) -> DataFrame:
    q = mart.groupBy("order_year", F.quarter("order_date").cast("bigint").alias("order_quarter")).agg(
        F.sum("net_sales").alias("revenue"), n_orders(mart).alias("orders"))
    grand = Window.partitionBy()
    return q.select(
        "order_year", "order_quarter", F.round("revenue", 2).alias("revenue"),
        F.round(safe_divide(F.col("revenue") * F.lit(100.0), F.sum("revenue").over(grand)), 1).alias("revenue_pct"),
        "orders",
        F.round(safe_divide(F.col("orders") * F.lit(100.0), F.sum("orders").over(grand)), 1).alias("orders_pct"),
    )


def sales_by(mart: DataFrame, dim: str) -> DataFrame:
    """Net sales and orders per value of ``dim`` (order segment or customer
    profile)."""
    return mart.groupBy(dim).agg(F.round(F.sum("net_sales"), 2).alias("net_sales"),
                                 n_orders(mart).alias("orders"))


def segment_table(mart: DataFrame, dim: str = "order_segmentation") -> DataFrame:
    return mart.groupBy(dim).agg(
        n_orders(mart).alias("orders"),
        F.round(F.sum("net_sales"), 2).alias("net_sales"),
        F.round(safe_divide(F.sum("net_sales"), n_orders(mart)), 2).alias("average_order_value"),
        F.round(safe_divide(F.sum("qty_product").cast("double"), n_orders(mart)), 2)
        .alias("avg_products_per_order"),
    )


def top_products(summary: DataFrame, by: str = "revenue", n: int = 10) -> DataFrame:
    """Top-n report (the limit is the feature); ties broken by product id.
    Planned as a per-partition top-n followed by a merge of n rows each."""
    key = {"revenue": "total_product_revenue", "units": "total_units_sold"}[by]
    return (summary.select(
        "product_id", F.col("total_product_revenue").alias("revenue"),
        F.col("total_units_sold").alias("units"), F.col("orders_containing_product").alias("orders"),
        F.col("customers_buying_product").alias("customers"))
        .orderBy(F.col({"total_product_revenue": "revenue", "total_units_sold": "units"}[key]).desc(),
                 F.col("product_id").asc())
        .limit(n))


def revenue_by_product(line_presentation: DataFrame) -> DataFrame:
    return line_presentation.groupBy("product_id").agg(
        F.round(F.sum("net_sales"), 2).alias("revenue"),
        F.sum("units_sold").alias("units"),
        F.sum("order_line_count").alias("order_lines"))


def units_histogram(line_presentation: DataFrame, width: int = 10) -> DataFrame:
    """Number of products per bucket of units sold (fixed bucket width)."""
    per_product = line_presentation.groupBy("product_id").agg(F.sum("units_sold").alias("units"))
    bucket = (F.floor(F.col("units") / F.lit(width)) * F.lit(width)).cast("bigint")
    return per_product.groupBy(bucket.alias("bucket_start")).agg(
        F.count(F.lit(1)).alias("products")).select(
        "bucket_start", (F.col("bucket_start") + F.lit(width)).alias("bucket_end"), "products")


def segment_share_in_year(mart: DataFrame, cfg: Config) -> DataFrame:
    """Share of orders and of revenue per segment in the report year."""
    agg = _year(mart, cfg).groupBy("order_segmentation").agg(
        n_orders(mart).alias("orders"), F.sum("net_sales").alias("revenue"))
    grand = Window.partitionBy()
    return agg.select(
        "order_segmentation", "orders",
        F.round(safe_divide(F.col("orders") * F.lit(100.0), F.sum("orders").over(grand)), 1).alias("orders_pct"),
        F.round("revenue", 2).alias("revenue"),
        F.round(safe_divide(F.col("revenue") * F.lit(100.0), F.sum("revenue").over(grand)), 1).alias("revenue_pct"))


def quarter_revenue_share(mart: DataFrame, quarter: int = 4) -> DataFrame:
    """Share of all revenue earned in the given quarter of every year."""
    in_q = F.quarter("order_date") == quarter
    return mart.agg(
        F.round(F.sum(F.when(in_q, F.col("net_sales")).otherwise(F.lit(0))), 2).alias("quarter_revenue"),
        F.round(F.sum("net_sales"), 2).alias("total_revenue"),
        F.round(safe_divide(F.sum(F.when(in_q, F.col("net_sales")).otherwise(F.lit(0))) * F.lit(100.0),
                            F.sum("net_sales")), 1).alias("revenue_pct"))
