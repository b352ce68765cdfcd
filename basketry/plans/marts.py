"""Intermediate models and marts.

Shuffle plan (per build, at any scale):

* order product summary: lines are aggregated to one row per order
  *before* meeting the headers (no fan-out), exchange on ``order_id``;
* customer history: orders -> (customer, day) partial aggregate -> range
  window per customer over days -> join back on (customer, day); see
  :mod:`basketry.operators.lookback` for why this survives a hot customer;
* mart_orders: history joined 1:1 with the lines' per-order sums on ``order_id``;
* order lines: one inner join of lines with order attributes on
  ``order_id`` (existence test and attribute lookup in one join);
* product summary: one exchange of the lines by product, sorts inside it for
  the distinct counts; products with a large share of the lines, known from
  the quantiles of the profile, are dealt out by order, customer and month.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from basketry.config import Config
from basketry.functions.dates import calendar_columns, month_start, within
from basketry.functions.numeric import safe_divide
from basketry.functions.segments import NEW, RETURNING, SEGMENTS, VIP, complete_history_flag, order_segment
from basketry.operators.lookback import with_prior_orders
from basketry.plans.staging import stg_orders as _stg_orders, stg_sales as _stg_sales


#: Orders of one point look-up; each is a test of every row group's filter.
MAX_LOOKUP = 100


def _zero():
    return F.lit(0).cast("bigint")


def per_order(stg_sales: DataFrame) -> DataFrame:
    """Quantity, lines and distinct products of every order id of the lines."""
    return stg_sales.groupBy("order_id").agg(
        F.sum("qty").alias("qty_product"),
        F.count(F.lit(1)).alias("product_line_count"),
        F.countDistinct("product_id").alias("distinct_product_count"),
    )


def order_product_summary(stg_orders: DataFrame, stg_sales: DataFrame) -> DataFrame:
    """One row per order that has a header: quantity, lines, distinct products.

    Lines are aggregated first and the per-order result is then semi-joined
    to the headers (the existence test depends only on ``order_id``, so the
    order of the two steps does not change the result). Aggregating first
    lets map-side partial aggregation reduce an order holding a large share
    of all lines inside every task; a semi join first would put all of that
    order's lines into one task, because the aggregate above it needs the
    same partitioning and the skew split would be skipped."""
    return per_order(stg_sales).join(stg_orders.select("order_id"), "order_id", "left_semi")


def _history(stg_orders: DataFrame, cfg: Config, with_profile: bool) -> DataFrame:
    orders = stg_orders.select("order_id", "customer_id", "order_date", "net_sales")
    h = with_prior_orders(
        orders, cfg.segmentation_lookback_months,
        prior_col="prior_orders_last_12_months",
        current_col="__current_prior" if with_profile else None,
    )
    cols = [
        "order_id", "customer_id", "order_date", "net_sales", "prior_orders_last_12_months",
        complete_history_flag("order_date", cfg).alias("has_complete_12_month_history"),
    ]
    if with_profile:
        cols.append("__current_prior")
    return h.select(*cols)


def order_customer_history(stg_orders: DataFrame, cfg: Config) -> DataFrame:
    """One row per order with its look-back count and completeness flag."""
    return _history(stg_orders, cfg, with_profile=False)


def mart_orders(stg_orders: DataFrame, stg_sales: DataFrame, cfg: Config) -> DataFrame:
    """The order mart from staging. The join to the headers keeps the lines'
    sums of known orders only, so they need no existence test of their own."""
    return orders_from_history(_history(stg_orders, cfg, with_profile=True), per_order(stg_sales), cfg)


def orders_from_history(h: DataFrame, p: DataFrame, cfg: Config) -> DataFrame:
    """The order mart from the history with ``__current_prior`` and the
    per-order sums."""
    seg = order_segment("prior_orders_last_12_months", cfg)
    # The customer's current state is the segment of the prior count on the
    # customer's latest order day; a NULL customer has no such state and
    # falls back to the order's own segment.
    profile = F.when(F.col("__current_prior").isNotNull(),
                     order_segment("__current_prior", cfg)).otherwise(seg)
    return h.join(p, "order_id", "left").select(
        "order_id", "customer_id", "order_date",
        *calendar_columns("order_date"),
        "net_sales",
        F.coalesce("qty_product", _zero()).alias("qty_product"),
        F.coalesce("product_line_count", _zero()).alias("product_line_count"),
        F.coalesce("distinct_product_count", _zero()).alias("distinct_product_count"),
        "prior_orders_last_12_months",
        "has_complete_12_month_history",
        seg.alias("order_segmentation"),
        profile.alias("customer_profile"),
        F.lit(1).cast("bigint").alias("order_count"),
    )


def mart_order_lines(stg_sales: DataFrame, mart_orders_df: DataFrame) -> DataFrame:
    """Lines with a header, enriched with the order's segments. Customer and
    date are the line's own."""
    attrs = mart_orders_df.select(
        F.col("order_id").alias("__oid"), "order_segmentation", "customer_profile",
        "has_complete_12_month_history")
    joined = stg_sales.join(attrs, F.col("order_id") == F.col("__oid"), "inner")
    return joined.select(
        "order_id", "customer_id", "product_id", "order_date",
        *calendar_columns("order_date"),
        F.col("qty").alias("quantity"),
        F.col("line_net_sales").alias("net_sales"),
        "order_segmentation", "customer_profile",
        F.coalesce("has_complete_12_month_history", F.lit(False)).alias("has_complete_12_month_history"),
        F.round(safe_divide("line_net_sales", "qty"), 2).alias("revenue_per_unit"),
    )


def frequent(quantiles) -> list:
    """The values that fill two or more neighbouring quantiles: each of them
    may be a share of the rows that is too large for a task."""
    return sorted({a for a, b in zip(quantiles, quantiles[1:]) if a == b})


def _product_sums(lines: DataFrame) -> list[Column]:
    revenue_of = lambda segment: F.round(F.sum(F.when(F.col("order_segmentation") == segment, F.col("net_sales"))
                                               .otherwise(F.lit(0))), 2)
    return [F.sum("quantity").alias("total_units_sold"), F.sum("net_sales").alias("__revenue"),
            revenue_of(NEW).alias("new_customer_revenue"), revenue_of(RETURNING).alias("returning_customer_revenue"),
            revenue_of(VIP).alias("vip_revenue"),
            F.min("order_date").alias("first_order_date"), F.max("order_date").alias("last_order_date")]


_PRODUCT_COUNTS = {"order_id": "orders_containing_product", "customer_id": "customers_buying_product",
                   "__month": "active_months"}


def _per_product(lines: DataFrame) -> DataFrame:
    """Sums and distinct counts by product from one exchange by product: the
    first line of each order, customer and month of a product is marked, and
    the marks are counted. Sorted, not hashed: memory is bounded by the sort's."""
    dealt = lines.repartition("product_id")
    for c in _PRODUCT_COUNTS:
        by = Window.partitionBy("product_id", c).orderBy("product_id", c)
        dealt = dealt.withColumn(f"__first_{c}", (F.row_number().over(by) == 1) & F.col(c).isNotNull())
    return dealt.groupBy("product_id").agg(
        *_product_sums(lines), *[F.count_if(f"__first_{c}").alias(n) for c, n in _PRODUCT_COUNTS.items()])


def _per_frequent_product(lines: DataFrame) -> DataFrame:
    """The same for a few products with many lines: dealt out by order,
    customer and month and pre-aggregated by product."""
    return lines.groupBy("product_id").agg(
        *_product_sums(lines), *[F.countDistinct(c).alias(n) for c, n in _PRODUCT_COUNTS.items()])


def mart_product_summary(order_lines: DataFrame, hot=()) -> DataFrame:
    """One row per product. ``avg_monthly_revenue`` divides the already
    rounded revenue (kept as specified). ``hot``: products with a large share
    of the lines (:func:`frequent`), which are dealt out over the tasks; the
    lines of all others go to their product's task, once."""
    lines = order_lines.select("product_id", "order_id", "customer_id", "order_date", "quantity", "net_sales",
                               "order_segmentation", month_start("order_date").alias("__month"))
    if hot:
        often = F.coalesce(F.col("product_id").isin(*hot), F.lit(False))
        j = _per_product(lines.where(~often)).unionByName(_per_frequent_product(lines.where(often)))
    else:
        j = _per_product(lines)
    revenue = F.round(F.col("__revenue"), 2)
    return j.select(
        "product_id", "total_units_sold",
        revenue.alias("total_product_revenue"),
        "orders_containing_product", "customers_buying_product",
        F.round(safe_divide("__revenue", "total_units_sold"), 2).alias("avg_revenue_per_unit"),
        F.round(safe_divide("__revenue", "orders_containing_product"), 2).alias("avg_revenue_per_order"),
        "new_customer_revenue", "returning_customer_revenue", "vip_revenue",
        "first_order_date", "last_order_date", "active_months",
        F.round(safe_divide(revenue, "active_months"), 2).alias("avg_monthly_revenue"),
        F.round(safe_divide(F.col("orders_containing_product").cast("double"), "active_months"), 2)
        .alias("avg_monthly_orders"),
    )


def mart_orders_presentation(mart: DataFrame) -> DataFrame:
    """No raw ids; a pseudonymous customer reference for distinct counts."""
    return mart.select(
        "order_date", "order_year", "order_month", "order_month_start", "net_sales",
        "qty_product", "product_line_count", "distinct_product_count",
        "order_segmentation", "customer_profile", "has_complete_12_month_history", "order_count",
        F.sha2(F.col("customer_id").cast("string"), 256).alias("customer_ref"),
    )


def mart_order_lines_presentation(lines: DataFrame) -> DataFrame:
    return lines.select(
        "product_id", "order_date", "order_year", "order_month", "order_month_start",
        "order_segmentation", "customer_profile", "has_complete_12_month_history",
        F.col("quantity").alias("units_sold"), "net_sales", "revenue_per_unit",
        F.lit(1).cast("bigint").alias("order_line_count"),
    )


def exercise_4_orders_with_qty(mart: DataFrame, cfg: Config) -> DataFrame:
    """Orders of the two years ending with the report year, with quantity."""
    return within(mart, cfg.two_year_start, cfg.year_end).select(
        "order_id", "customer_id", "order_date", "net_sales", "qty_product")


def exercise_6_orders_segmented(mart: DataFrame, cfg: Config) -> DataFrame:
    return within(mart, cfg.year_start, cfg.year_end).select(
        "order_id", "customer_id", "order_date", "net_sales", "qty_product", "order_segmentation")


class Marts:
    """All models over one pair of raw sources, built lazily and shared, so
    every consumer of a model reuses the same plan (and, within one query,
    the same exchanges)."""

    def __init__(self, raw_orders: DataFrame, raw_sales: DataFrame, cfg: Config,
                 raw_lines: DataFrame | None = None):
        """raw_lines: the lines for models that use neither their customer nor
        their date, where those take a join (default: ``raw_sales``)."""
        cfg.validate()
        self.raw_orders, self.raw_sales, self.cfg = raw_orders, raw_sales, cfg
        self.raw_lines = raw_sales if raw_lines is None else raw_lines
        self.root = None  # folder of the materialised tables, if any
        self.row_counts: dict = {}  # rows written per table (write-time metrics)
        self.layouts: dict = {}  # table -> Layout of its folders
        self._rollups = None
        self.buckets = None  # the staged tables by order id, if stored
        self.checks: dict = {}  # results of the row checks, from the passes of the build

    @classmethod
    def from_tables(cls, spark: SparkSession, sf_dir: str, cfg: Config) -> "Marts":
        from basketry.sources.tpch import raw_orders_from_tables, raw_sales_from_tables
        return cls(raw_orders_from_tables(spark, sf_dir), raw_sales_from_tables(spark, sf_dir), cfg,
                   raw_sales_from_tables(spark, sf_dir, headers=False))

    @cached_property
    def stg_orders(self) -> DataFrame:
        return _stg_orders(self.raw_orders)

    @cached_property
    def stg_sales(self) -> DataFrame:
        return _stg_sales(self.raw_sales)

    @cached_property
    def stg_lines(self) -> DataFrame:
        """The staged lines, for models that use neither customer nor date."""
        return _stg_sales(self.raw_lines)

    @cached_property
    def order_product_summary(self) -> DataFrame:
        return order_product_summary(self.stg_orders, self.stg_lines)

    @cached_property
    def order_customer_history(self) -> DataFrame:
        return order_customer_history(self.stg_orders, self.cfg)

    @cached_property
    def mart_orders(self) -> DataFrame:
        return mart_orders(self.stg_orders, self.stg_lines, self.cfg)

    @cached_property
    def mart_order_lines(self) -> DataFrame:
        return mart_order_lines(self.stg_sales, self.mart_orders)

    @cached_property
    def mart_product_summary(self) -> DataFrame:
        return mart_product_summary(self.mart_order_lines)

    def product_summary_dealt(self) -> DataFrame:
        """The product summary with frequent products dealt out: one pass over
        the raw lines finds them."""
        from basketry.plans.quality import lines_profile
        hot = frequent(lines_profile(self)[1])
        return mart_product_summary(self.mart_order_lines, hot) if hot else self.mart_product_summary

    @cached_property
    def mart_orders_presentation(self) -> DataFrame:
        return mart_orders_presentation(self.mart_orders)

    @cached_property
    def mart_order_lines_presentation(self) -> DataFrame:
        return mart_order_lines_presentation(self.mart_order_lines)

    @cached_property
    def exercise_4(self) -> DataFrame:
        return exercise_4_orders_with_qty(self.mart_orders, self.cfg)

    @cached_property
    def exercise_6(self) -> DataFrame:
        return exercise_6_orders_segmented(self.mart_orders, self.cfg)

    # ------------------------------------------------------------------
    #: The models that are written as tables.
    TABLES = {"order_product_summary": "int_order_product_summary", "order_customer_history": "int_order_customer_history",
              "mart_orders": "mart_orders", "mart_order_lines": "mart_order_lines",
              "mart_product_summary": "mart_product_summary"}

    def published(self, spark: SparkSession, root: str) -> "Marts":
        """A ``Marts`` that reads the tables of an earlier build; nothing is
        built. ``root``: the folder of one build, or a destination of
        snapshots, of which the current one is resolved now, once."""
        from basketry.sources.layout import Layout
        from basketry.sources.sinks import read_table
        from basketry.sources.snapshots import current
        out = Marts(self.raw_orders, self.raw_sales, self.cfg, self.raw_lines)
        manifest = current(spark, root)
        out.root = root if manifest is None else f"{root.rstrip('/')}/builds/{manifest['build']}"
        if manifest is not None:
            out.row_counts, out.checks = manifest["rows"], manifest["checks"]
            out.layouts = {k: Layout.from_json(v) for k, v in manifest["layouts"].items()}
        for attribute, name in self.TABLES.items():
            schema = StructType.fromJson(manifest["tables"][name]["schema"]) if manifest else None
            folder = manifest["tables"][name]["folder"] if manifest else name
            out.__dict__[attribute] = read_table(spark, f"{out.root.rstrip('/')}/{folder}", schema=schema)
        return out

    def manifest(self) -> dict:
        """What a snapshot says of this build (see ``sources.snapshots``)."""
        return {"tables": {name: {"folder": name, "schema": getattr(self, attribute).schema.jsonValue()}
                           for attribute, name in self.TABLES.items()},
                "rows": self.row_counts, "checks": self.checks,
                "layouts": {k: v.to_json() for k, v in self.layouts.items()}}

    def publish(self, spark: SparkSession, dest: str, gate: str = "none") -> "Marts":
        """Build into a folder of its own under ``dest`` and publish it as the
        current snapshot. ``gate='error'``: a build whose row checks of
        severity error find anything is not published
        (:class:`basketry.operators.checks.BuildHeld`); its folder stays for
        inspection and no reader sees it."""
        from basketry.operators.checks import BuildHeld
        from basketry.plans.quality import failing_row_checks
        from basketry.sources import snapshots
        if gate not in ("none", "error"):
            raise ValueError("gate must be 'none' or 'error'")
        build, root = snapshots.new_build(dest)
        out = self.materialize(spark, root)
        failing = failing_row_checks(out.checks) if gate == "error" else {}
        if failing:
            raise BuildHeld(root, failing)
        snapshots.publish(spark, dest, build, out.manifest())
        return out

    def rolled(self, spark: SparkSession) -> list:
        """The stored aggregates of this build (``semantic.ROLLUPS``), written
        beside its tables the first time they are asked for."""
        from basketry.operators.rollups import store
        from basketry.plans.semantic import ROLLUPS
        if self._rollups is None:
            self._rollups = store(spark, ROLLUPS, self, f"{self.root.rstrip('/')}/rollups")
        return self._rollups

    def bucketed(self, spark: SparkSession, **how) -> "Marts":
        """These models with the staged headers and lines stored by order id
        (:mod:`basketry.sources.buckets`): the per-order sums and the checks
        between the two read them without an exchange."""
        from basketry.sources.buckets import store
        out = Marts(self.raw_orders, self.raw_sales, self.cfg, self.raw_lines)
        out.__dict__.update(self.__dict__)
        out.buckets = store(spark, self.stg_orders, self.stg_lines, **how)
        out.__dict__["order_product_summary"] = out.buckets.apply(order_product_summary)
        return out

    def rollups_of(self, spark: SparkSession, mart: str) -> list:
        return [s for s in self.rolled(spark) if s.rollup.mart == mart]

    def orders_by_day(self, spark: SparkSession) -> DataFrame:
        """The stored daily sums of the order mart under the mart's column
        names, for reports that need no single order."""
        day = next(s for s in self.rolled(spark) if s.rollup.name == "orders_by_day").sums
        year, month, start = calendar_columns("order_date")
        return day.select("*", year, month, start)

    def slice(self, spark: SparkSession, table: str, **wanted) -> DataFrame:
        """Rows of a clustered table by its clustering keys (a value, or a
        (low, high) pair with both ends): only the zones that can hold them
        are read, whichever of the keys is given."""
        rows = spark.read.schema(StructType([*getattr(self, table).schema.fields, StructField("zone", IntegerType())])).parquet(
            f"{self.root.rstrip('/')}/{self.TABLES[table]}")
        return rows.where(self.layouts[table].slice(**wanted)).select(*getattr(self, table).columns)

    def lookup(self, table: str, order_ids) -> DataFrame:
        """Rows of a few orders of a written mart, which are not clustered by
        their id: row groups are skipped by the Bloom filters of the id."""
        return self.among(getattr(self, table), [order_ids] if isinstance(order_ids, int) else order_ids)

    @staticmethod
    def among(rows: DataFrame, order_ids) -> DataFrame:
        """``rows`` of a few orders."""
        ids = sorted(set(order_ids))
        if len(ids) > MAX_LOOKUP:
            raise ValueError(f"at most {MAX_LOOKUP} ids; join the table for more")
        same = F.lit(False)
        for i in ids:
            same |= F.col("order_id") == F.lit(i)
        return rows.where(same)

    def materialize(self, spark: SparkSession, root: str | None = None, clustered: bool = True,
                    rows_per_zone: int | None = None) -> "Marts":
        """Write the table-materialised models (intermediate models and
        marts) under ``root`` (default: the shared table folder named by
        ``spark.checkpoint.dir``) in their clustered layout, and return a
        ``Marts`` whose models read those tables. Views stay lazy. Writing
        cuts the lineage: a lost executor later costs a re-read, not a
        rebuild.

        Every join and aggregate runs once: the bounds of the layouts come
        from one pass over each raw source, which counts the sources' NULLs
        as well; the row checks of a table are counted while it is written
        (``checks``), above its last exchange."""
        import uuid
        from concurrent.futures import ThreadPoolExecutor
        from basketry.plans import quality as dq
        from basketry.session import shared_table_root
        from basketry.sources.layout import ROWS_PER_ZONE, Layout, rank_of
        from basketry.sources.sinks import materialize
        if root is None:
            # a fresh folder per build: readers of an earlier build are never
            # disturbed by a rewrite in place
            root = f"{shared_table_root(spark).rstrip('/')}/build-{uuid.uuid4().hex[:12]}"
        out = Marts(self.raw_orders, self.raw_sales, self.cfg, self.raw_lines)
        out.root = root
        out.__dict__["stg_orders"] = self.stg_orders
        out.__dict__["stg_sales"], out.__dict__["stg_lines"] = self.stg_sales, self.stg_lines
        counts, checks, metrics = out.row_counts, out.checks, dq.row_metrics(self.cfg)

        def written(df, attribute, **how):
            name = self.TABLES[attribute]
            found: dict = {}
            table = materialize(spark, df, name, "table", root, counts=counts, checks=found,
                                metrics=metrics[attribute], **how)
            out.__dict__[attribute] = table
            checks.update(found)
            if how.get("layout"):
                out.layouts[attribute] = how["layout"]
            return table

        def history_of(bounds):
            h = _history(self.stg_orders, self.cfg, with_profile=True)
            if clustered:
                h = h.withColumn("__rank", rank_of(bounds, F.col("customer_id"))).hint("rebalance", F.col("__rank"))
                h = h.drop("__rank").sortWithinPartitions("customer_id")
            return written(h, "order_customer_history")

        nth = lambda key: F.row_number().over(Window.partitionBy(key).orderBy(key)).alias("__nth")
        with ThreadPoolExecutor(max_workers=3) as pool:
            lines_profile = pool.submit(dq.lines_profile, self)
            # rows are dealt by the key already: numbering them takes no exchange
            summary = pool.submit(written, self.order_product_summary.select("*", nth("order_id")),
                                  "order_product_summary", hidden=["__nth"])
            orders, quantiles, years = dq.orders_profile(self)
            checks.update(orders)
            customers = Layout.of({"customer_id": quantiles}, 0, 1).keys[0][1]
            history = history_of(customers)
            summary = summary.result()
            found, products = lines_profile.result()
            checks.update(found)
            hot_products = frequent(products)
        out.__dict__["order_customer_history"] = history.drop("__current_prior")
        layout = lambda keys, rows: Layout.of(keys, rows, years, rows_per_zone or ROWS_PER_ZONE) if clustered else None
        written(orders_from_history(history, summary, self.cfg), "mart_orders", layout=layout(
            {"customer_id": customers, "order_segmentation": sorted(SEGMENTS)}, checks["rows:raw_orders"]), lookup=["order_id"])
        written(mart_order_lines(self.stg_sales, out.mart_orders), "mart_order_lines", layout=layout(
            {"product_id": products, "customer_id": customers}, checks["rows:raw_sales"]), lookup=["order_id"])
        # One row per product, hash-partitioned on product_id (but for frequent
        # ones): a local sort orders every file by product.
        summed = mart_product_summary(out.mart_order_lines, hot_products).select("*", nth("product_id"))
        written(summed.sortWithinPartitions("product_id") if clustered else summed, "mart_product_summary", hidden=["__nth"])
        return out
