"""Data-quality checks: the declared column checks and the singular checks.
Every check is a query returning the violating rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from basketry.config import Config
from basketry.functions.dates import in_range, within
from basketry.functions.segments import SEGMENTS, segment_sql
from basketry.operators.checks import Check, accepted_values, not_null, relationships, unique, unique_ids
from basketry.plans.marts import Marts
from basketry.plans.reports import combine_rows, orphan_lines, union_all
from basketry.plans.staging import staged_orders, staged_sales
from basketry.sources.layout import quantile_columns

# Declared column checks (fixed list of the documented contracts):
# NOT NULL columns per relation, UNIQUE and accepted-value (relation, column).
NOT_NULL = {
    "raw_orders": ["orders_id", "customers_id", "date_date"],
    "raw_sales": ["order_id", "products_id", "qty"],
    "stg_orders": ["order_id", "customer_id", "order_date"],
    "stg_sales": ["order_id", "product_id", "qty"],
    "order_product_summary": ["order_id", "qty_product"],
    "order_customer_history": ["order_id", "customer_id", "order_date", "prior_orders_last_12_months"],
    "mart_orders": ["order_id", "customer_id", "order_date", "net_sales", "order_segmentation",
                    "customer_profile"],
    "mart_orders_presentation": ["order_date", "net_sales"],
    "exercise_6": ["order_segmentation"],
    "mart_order_lines": ["order_id", "customer_id", "product_id", "order_date", "quantity", "net_sales",
                         "order_segmentation", "customer_profile"],
    "mart_order_lines_presentation": ["product_id", "order_date", "units_sold", "net_sales",
                                      "order_segmentation", "customer_profile"],
    "mart_product_summary": ["product_id"],
}
UNIQUE = [("raw_orders", "orders_id"), ("stg_orders", "order_id"), ("order_product_summary", "order_id"),
          ("order_customer_history", "order_id"), ("mart_orders", "order_id"),
          ("mart_product_summary", "product_id")]
ACCEPTED = [("mart_orders", "order_segmentation"), ("mart_orders", "customer_profile"),
            ("exercise_6", "order_segmentation"), ("mart_order_lines", "order_segmentation"),
            ("mart_order_lines", "customer_profile")]


def _rel(m: Marts, name: str) -> DataFrame:
    return getattr(m, name)


def _repeated(df: DataFrame, column: str) -> DataFrame:
    """Repeated values; integers by words of ids, others by themselves."""
    whole = df.schema[column].dataType.typeName() in ("byte", "short", "integer", "long")
    return unique_ids(df, column) if whole else unique(df, column)


# -- singular checks -----------------------------------------------------------
# Row-level checks are predicates, so the summary can evaluate all of them for
# one relation in a single aggregate pass.

def invalid_segment_pred():
    seg = F.col("order_segmentation")
    return ~seg.isin(*SEGMENTS) | seg.isNull()


def non_positive_qty_pred():
    return (F.col("qty_product") <= 0) | F.col("qty_product").isNull()


def segment_mismatch_pred(cfg: Config):
    derived = F.expr(segment_sql("prior_orders_last_12_months", cfg))
    return ~derived.eqNullSafe(F.col("order_segmentation"))


def invalid_segments(mart: DataFrame) -> DataFrame:
    return mart.where(invalid_segment_pred())


def order_lines_grain(lines: DataFrame) -> DataFrame:
    return (lines.groupBy("order_id", "product_id").agg(F.count(F.lit(1)).alias("row_count"))
            .where("row_count > 1"))


def order_sales_match(stg_orders: DataFrame, stg_sales: DataFrame, tolerance: float = 0.01) -> DataFrame:
    """Headers whose total differs from the sum of their lines. Lines are
    summed per order before the join. A header without lines compares with
    -1, so a 0 header fails and a -1 header passes."""
    line_sums = stg_sales.groupBy("order_id").agg(F.sum("line_net_sales").alias("line_net_sales"))
    j = stg_orders.select("order_id", "net_sales").join(line_sums, "order_id", "left")
    diff = F.abs(F.coalesce("net_sales", F.lit(0)) - F.coalesce("line_net_sales", F.lit(-1)))
    return j.where(diff > F.lit(tolerance)).select("order_id", "net_sales", "line_net_sales")


def positive_product_qty(mart: DataFrame) -> DataFrame:
    return mart.where(non_positive_qty_pred())


def lines_without_header(stg_sales: DataFrame, stg_orders: DataFrame) -> DataFrame:
    return orphan_lines(stg_sales, stg_orders).select("order_id")


def segmentation_reconciliation(mart: DataFrame, cfg: Config) -> DataFrame:
    """The segment re-derived from the stored count by an independently
    written SQL rule; rows where the two differ, NULLs included."""
    derived = F.expr(segment_sql("prior_orders_last_12_months", cfg))
    return mart.select("order_id", derived.alias("derived_segment"),
                       F.col("order_segmentation").alias("stored_segment")).where(
        ~F.col("derived_segment").eqNullSafe(F.col("stored_segment")))


def prior_count_reconciliation(mart: DataFrame, stg_orders: DataFrame, cfg: Config) -> DataFrame:
    """Orders whose stored look-back count differs from a second derivation
    from staging: the orders before the day less the orders before the start
    of the look-back, both read off one running count per customer.

    Each (customer, day) asks twice, at the day and at the look-back's start;
    questions stand before the orders of their day, so neither counts it. A
    customer has three rows a day of orders at most."""
    daily = (stg_orders.where(F.col("customer_id").isNotNull() & F.col("order_date").isNotNull())
             .groupBy("customer_id", "order_date").agg(F.count("order_id").alias("n")))
    start = F.add_months("order_date", -cfg.segmentation_lookback_months)
    ask = lambda at, sign: F.struct(at.alias("at"), F.lit(0).alias("kind"), F.lit(sign).alias("sign"),
                                    F.lit(0).cast("bigint").alias("add"))
    add = F.struct(F.col("order_date").alias("at"), F.lit(1).alias("kind"), F.lit(0).alias("sign"), F.col("n").alias("add"))
    events = daily.select("customer_id", "order_date", F.inline(F.array(ask(F.col("order_date"), 1), ask(start, -1), add)))
    running = Window.partitionBy("customer_id").orderBy("at", "kind").rowsBetween(Window.unboundedPreceding, 0)
    derived = (events.withColumn("before", F.sum("add").over(running)).where("kind = 0")
               .groupBy(F.col("customer_id").alias("__c"), F.col("order_date").alias("__d"))
               .agg(F.sum(F.col("sign") * F.col("before")).alias("derived_count")))
    j = mart.join(derived, (F.col("customer_id") == F.col("__c")) & (F.col("order_date") == F.col("__d")), "left")
    return j.select("order_id", F.col("prior_orders_last_12_months").alias("stored_count"),
                    F.coalesce("derived_count", F.lit(0).cast("bigint")).alias("derived_count")).where(
        ~F.col("stored_count").eqNullSafe(F.col("derived_count")))


def profile_reconciliation(mart: DataFrame, cfg: Config) -> DataFrame:
    """The customer profile re-derived as the segment of each customer's
    latest order (latest by date, then id); orders whose stored profile
    differs.

    One aggregate per customer (partial aggregation: a customer holding a
    large share of the orders is reduced inside every map task) yields the
    derived profile and whether any stored profile disagrees. Only orders of
    such customers are joined back; that side is normally empty or tiny and
    broadcast at runtime, so no task ever holds all orders of one customer.
    NULL customers compare with their own segment, row by row."""
    seg, prof = F.col("order_segmentation"), F.col("customer_profile")
    keyed = mart.where(F.col("customer_id").isNotNull())
    per_customer = keyed.groupBy(F.col("customer_id").alias("__c")).agg(
        F.max_by(seg, F.struct("order_date", "order_id")).alias("derived_profile"),
        F.min(prof).alias("__lo"), F.max(prof).alias("__hi"),
        F.count_if(prof.isNull()).alias("__nulls"))
    disagree = per_customer.where(
        ~F.col("__lo").eqNullSafe(F.col("derived_profile"))
        | ~F.col("__hi").eqNullSafe(F.col("derived_profile"))
        | (F.col("__nulls") > 0)).select("__c", "derived_profile")
    out_cols = ["order_id", "customer_id", F.col("customer_profile").alias("stored_profile"), "derived_profile"]
    known = (keyed.join(disagree, F.col("customer_id") == F.col("__c"), "inner")
             .where(~prof.eqNullSafe(F.col("derived_profile"))).select(*out_cols))
    unknown = (mart.where(F.col("customer_id").isNull() & ~prof.eqNullSafe(seg))
               .withColumn("derived_profile", seg).select(*out_cols))
    return union_all([known, unknown])


def year_count_match(mart: DataFrame, stg_orders: DataFrame, cfg: Config) -> DataFrame:
    """One row when the report-year order count of the mart differs from the
    staging count."""
    row = combine_rows(
        within(mart, cfg.year_start, cfg.year_end).agg(F.count(F.lit(1)).alias("mart_count")),
        stg_orders.where(in_range("order_date", cfg.year_start, cfg.year_end)).agg(
            F.count(F.lit(1)).alias("source_count")))
    return row.where(F.col("mart_count") != F.col("source_count"))


def segmented_year_count_match(exercise_6: DataFrame, stg_orders: DataFrame, cfg: Config) -> DataFrame:
    row = combine_rows(
        exercise_6.agg(F.count(F.lit(1)).alias("segmented_count")),
        stg_orders.where(F.year("order_date") == cfg.report_year).agg(F.count(F.lit(1)).alias("source_count")))
    return row.where(F.col("segmented_count") != F.col("source_count"))


def monthly_count_match(mart: DataFrame, stg_orders: DataFrame, cfg: Config) -> DataFrame:
    """Months of the report year whose order counts differ; a full outer join,
    so a month present on one side only is reported too."""
    def monthly(df, name):
        return (within(df, cfg.year_start, cfg.year_end)
                .groupBy(F.month("order_date").cast("bigint").alias("month_num"))
                .agg(F.count(F.lit(1)).alias(name)))
    j = monthly(mart, "mart_count").join(monthly(stg_orders, "source_count"), "month_num", "full_outer")
    return j.where(~F.col("mart_count").eqNullSafe(F.col("source_count")))


def order_grain_in_year(mart: DataFrame, cfg: Config) -> DataFrame:
    return (within(mart, cfg.year_start, cfg.year_end)
            .groupBy("order_id").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("order_id"))


# -- catalogue ---------------------------------------------------------------

def declared_checks(m: Marts) -> list[Check]:
    """All checks with their severities: declared column checks first, then
    the singular checks."""
    cfg = m.cfg
    checks: list[Check] = []
    for rel, cols in NOT_NULL.items():
        for c in cols:
            checks.append(Check(f"not_null:{rel}.{c}", lambda rel=rel, c=c: not_null(_rel(m, rel), c)))
    for rel, c in UNIQUE:
        checks.append(Check(f"unique:{rel}.{c}", lambda rel=rel, c=c: _repeated(_rel(m, rel), c)))
    for rel, c in ACCEPTED:
        checks.append(Check(f"accepted_values:{rel}.{c}",
                            lambda rel=rel, c=c: accepted_values(_rel(m, rel), c, SEGMENTS)))
    checks.append(Check("relationships:stg_sales.order_id", lambda: relationships(
        m.stg_lines, "order_id", m.stg_orders, "order_id"), severity="warn"))
    singular = [
        ("invalid_segments", lambda: invalid_segments(m.mart_orders), "error"),
        ("order_lines_grain", lambda: order_lines_grain(m.mart_order_lines), "error"),
        ("order_sales_match", lambda: order_sales_match(m.stg_orders, m.stg_lines), "error"),
        ("positive_product_qty", lambda: positive_product_qty(m.mart_orders), "error"),
        ("lines_have_header", lambda: lines_without_header(m.stg_lines, m.stg_orders), "warn"),
        ("segmentation_reconciliation", lambda: segmentation_reconciliation(m.mart_orders, cfg), "error"),
        ("year_count_match", lambda: year_count_match(m.mart_orders, m.stg_orders, cfg), "error"),
        ("segmented_year_count_match", lambda: segmented_year_count_match(m.exercise_6, m.stg_orders, cfg), "error"),
        ("monthly_count_match", lambda: monthly_count_match(m.mart_orders, m.stg_orders, cfg), "error"),
        ("order_grain_in_year", lambda: order_grain_in_year(m.mart_orders, cfg), "error"),
    ]
    checks += [Check(n, b, s) for n, b, s in singular]
    return checks


def _null_counts(rel: str, column=lambda c: F.col(c)) -> list:
    return [F.count_if(column(c).isNull()).alias(f"null:{rel}/{c}") for c in NOT_NULL[rel]]


def _accepted_counts(rel: str, within=None) -> list:
    outside = lambda c: ~F.col(c).isin(*SEGMENTS) if within is None else within & ~F.col(c).isin(*SEGMENTS)
    return [F.count_if(outside(c)).alias(f"accepted:{rel}/{c}") for r, c in ACCEPTED if r == rel]


def _orders_pass(m: Marts, *more) -> DataFrame:
    """One pass over the raw headers for the raw and the staged columns."""
    raw = m.raw_orders
    both = raw.select("*", *[c.alias(f"s_{n}") for n, c in staged_orders(raw).items()])
    in_year = in_range("s_order_date", m.cfg.year_start, m.cfg.year_end)
    counts = _null_counts("raw_orders") + _null_counts("stg_orders", lambda c: F.col(f"s_{c}"))
    counts += [F.count(F.lit(1)).alias("rows:raw_orders"), F.count_if(in_year).alias("source_count"),
               F.count_if(F.year("s_order_date") == m.cfg.report_year).alias("source_year_count")]
    counts += [F.count_if(in_year & (F.month("s_order_date") == k)).alias(f"source_{k}") for k in range(1, 13)]
    return both.agg(*counts, *more)


def _lines_pass(m: Marts, *more) -> DataFrame:
    raw = m.raw_lines
    both = raw.select("*", *[c.alias(f"s_{n}") for n, c in staged_sales(raw).items()])
    counts = _null_counts("raw_sales") + _null_counts("stg_sales", lambda c: F.col(f"s_{c}"))
    return both.agg(F.count(F.lit(1)).alias("rows:raw_sales"), *counts, *more)


def orders_profile(m: Marts) -> tuple[dict, list, int]:
    """The counts of the raw and staged headers, the customers' quantiles and
    the number of years: one pass, one row."""
    row = _orders_pass(m, *quantile_columns("customer_id", F.col("s_customer_id")),
                       F.year(F.min("s_order_date")).alias("first"), F.year(F.max("s_order_date")).alias("last")).first().asDict()
    first, last, quantiles = row.pop("first"), row.pop("last"), row.pop("quantiles:customer_id")
    return row, quantiles or [], 1 if first is None else last - first + 1


def lines_profile(m: Marts) -> tuple[dict, list]:
    """The counts of the raw and staged lines and the products' quantiles."""
    row = _lines_pass(m, *quantile_columns("product_id", F.col("s_product_id"))).first().asDict()
    quantiles = row.pop("quantiles:product_id")
    return row, quantiles or []


def row_metrics(cfg: Config) -> dict[str, list]:
    """The row checks of every written table as aggregates over its rows, to
    be counted while it is written (views of a table with the table)."""
    in_year = in_range("order_date", cfg.year_start, cfg.year_end)
    mart = _null_counts("mart_orders") + _null_counts("mart_orders_presentation")
    mart += [F.count_if(in_year & F.col(c).isNull()).alias(f"null:exercise_6/{c}") for c in NOT_NULL["exercise_6"]]
    mart += _accepted_counts("mart_orders") + _accepted_counts("exercise_6", in_year)
    mart += [F.count_if(invalid_segment_pred()).alias("invalid_segments"),
             F.count_if(non_positive_qty_pred()).alias("positive_product_qty"),
             F.count_if(segment_mismatch_pred(cfg)).alias("segmentation_reconciliation"),
             F.count_if(in_year).alias("mart_count")]
    mart += [F.count_if(in_year & (F.month("order_date") == k)).alias(f"mart_{k}") for k in range(1, 13)]
    base = {"units_sold": "quantity"}  # the presentation's only renamed column
    lines = _null_counts("mart_order_lines") + _null_counts("mart_order_lines_presentation", lambda c: F.col(base.get(c, c)))
    lines += _accepted_counts("mart_order_lines")
    second = lambda rel, c: F.count_if(F.col(c).isNotNull() & (F.col("__nth") == 2)).alias(f"unique:{rel}/{c}")
    return {"order_product_summary": _null_counts("order_product_summary") + [second("order_product_summary", "order_id")],
            "order_customer_history": _null_counts("order_customer_history"),
            "mart_orders": mart, "mart_order_lines": lines,
            "mart_product_summary": _null_counts("mart_product_summary") + [second("mart_product_summary", "product_id")]}


def failing_row_checks(checks: dict) -> dict:
    """Of the results that a build has, those of declared checks that found
    something (all of them are of severity error)."""
    found = {k: v for k, v in checks.items() if v and k.split(":")[0] in ("null", "accepted", "unique")}
    return found | {k: checks[k] for k in ("invalid_segments", "positive_product_qty", "segmentation_reconciliation") if checks.get(k)}


def _mart_pass(m: Marts) -> DataFrame:
    """The order mart with its presentation and the report-year slice."""
    return m.mart_orders.agg(*row_metrics(m.cfg)["mart_orders"])


def _mart_lines_pass(m: Marts) -> DataFrame:
    return m.mart_order_lines.agg(*row_metrics(m.cfg)["mart_order_lines"])


def _stored_per_order_pass(m: Marts) -> DataFrame:
    """What is left to count by order id once the row checks are stored:
    uniqueness in the history and the mart, the grain of the report year. The
    history has the staging's rows; should their numbers differ, the staged
    headers are counted as well."""
    in_year = in_range("order_date", m.cfg.year_start, m.cfg.year_end)
    frames = [m.order_customer_history.select("order_id", F.lit(2).alias("rel")),
              m.mart_orders.select("order_id", F.lit(3).alias("rel"), in_year.cast("int").alias("in_year"))]
    apart = m.checks["rows:raw_orders"] != m.row_counts["int_order_customer_history"]
    if apart:
        frames.append(m.stg_orders.select("order_id", F.lit(0).alias("rel")))
    per = union_all(frames).groupBy("order_id").agg(
        *[F.count_if(F.col("rel") == k).alias(f"rows_{k}") for k in (0, 2, 3)], F.sum("in_year").alias("year_rows"))
    twice = lambda k: F.count_if(F.col("order_id").isNotNull() & (F.col(f"rows_{k}") > 1))
    return per.agg(twice(0 if apart else 2).alias("unique:stg_orders/order_id"),
                   twice(2).alias("unique:order_customer_history/order_id"),
                   twice(3).alias("unique:mart_orders/order_id"),
                   F.count_if(F.col("year_rows") > 1).alias("order_grain_in_year"))


def _per_order_pass(m: Marts) -> DataFrame:
    """Uniqueness of the order id in four relations and the grain of the
    report year: one aggregate per order over slim rows of all of them."""
    in_year = in_range("order_date", m.cfg.year_start, m.cfg.year_end)
    summary, history = m.order_product_summary, m.order_customer_history
    frames = [
        m.stg_orders.select("order_id", F.lit(0).alias("rel")),
        summary.select("order_id", F.lit(1).alias("rel"), *[
            F.col(c).isNull().cast("int").alias(f"n1_{c}") for c in NOT_NULL["order_product_summary"]]),
        history.select("order_id", F.lit(2).alias("rel"), *[
            F.col(c).isNull().cast("int").alias(f"n2_{c}") for c in NOT_NULL["order_customer_history"]]),
        m.mart_orders.select("order_id", F.lit(3).alias("rel"), in_year.cast("int").alias("in_year")),
    ]
    flags = [(f"n1_{c}", f"null:order_product_summary/{c}") for c in NOT_NULL["order_product_summary"]]
    flags += [(f"n2_{c}", f"null:order_customer_history/{c}") for c in NOT_NULL["order_customer_history"]]
    per = union_all(frames).groupBy("order_id").agg(
        *[F.count_if(F.col("rel") == k).alias(f"rows_{k}") for k in range(4)],
        F.sum("in_year").alias("year_rows"), *[F.sum(f).alias(f) for f, _ in flags])
    known = F.col("order_id").isNotNull()
    return per.agg(
        F.count_if(known & (F.col("rows_0") > 1)).alias("unique:stg_orders/order_id"),
        F.count_if(known & (F.col("rows_1") > 1)).alias("unique:order_product_summary/order_id"),
        F.count_if(known & (F.col("rows_2") > 1)).alias("unique:order_customer_history/order_id"),
        F.count_if(known & (F.col("rows_3") > 1)).alias("unique:mart_orders/order_id"),
        F.count_if(F.col("year_rows") > 1).alias("order_grain_in_year"),
        *[F.coalesce(F.sum(f), F.lit(0)).alias(name) for f, name in flags])


def _header_lines_pass(m: Marts, tolerance: float = 0.01) -> DataFrame:
    """Header totals against line sums and lines without a header, from one
    full join of the headers with one row per order of the lines. With tables
    bucketed by order id (``m.buckets``) neither is shuffled."""
    def part(orders, lines):
        sums = lines.groupBy(F.col("order_id").alias("__id")).agg(
            F.sum("line_net_sales").alias("__sum"), F.count(F.lit(1)).alias("__lines"))
        return (orders.select("order_id", "net_sales", F.lit(True).alias("__header"))
                .join(sums, F.col("order_id") == F.col("__id"), "full_outer"))

    j = m.buckets.apply(part) if m.buckets else part(m.stg_orders, m.stg_lines)
    diff = F.abs(F.coalesce("net_sales", F.lit(0)) - F.coalesce("__sum", F.lit(-1)))
    orphan = F.col("__header").isNull()
    count = lambda pred: F.coalesce(F.sum(F.when(pred, F.col("__lines"))), F.lit(0))
    return j.agg(F.count_if(F.col("__header") & (diff > F.lit(tolerance))).alias("order_sales_match"),
                 count(orphan).alias("lines_have_header"),
                 count(orphan & F.col("__id").isNotNull()).alias("relationships:stg_sales/order_id"))


def _product_pass(m: Marts) -> DataFrame:
    per = m.mart_product_summary.groupBy("product_id").agg(F.count(F.lit(1)).alias("n"))
    known = F.col("product_id").isNotNull()
    return per.agg(F.coalesce(F.sum(F.when(~known, F.col("n"))), F.lit(0)).alias("null:mart_product_summary/product_id"),
                   F.count_if(known & (F.col("n") > 1)).alias("unique:mart_product_summary/product_id"))


def check_summary(m: Marts) -> DataFrame:
    """One row per check: (check_name, severity, failures).

    Of a build, the row checks are there already (``m.checks``, counted while
    its tables were written); three one-row aggregates over five scans are
    left: order ids of history and mart, header totals against line sums, the
    grain of the lines. Of models that are not built, eight aggregates over
    twelve scans: a relation and the views of it are judged in one pass."""
    grain = order_lines_grain(m.mart_order_lines).agg(F.count(F.lit(1)).alias("order_lines_grain"))
    if m.checks:
        row = combine_rows(_stored_per_order_pass(m), _header_lines_pass(m), grain).withColumns(
            {k: F.lit(v) for k, v in m.checks.items()})
    else:
        row = combine_rows(_orders_pass(m), _lines_pass(m), _mart_pass(m), _mart_lines_pass(m), _per_order_pass(m),
                           _header_lines_pass(m), _product_pass(m), grain)
    apart = lambda a, b: f"CAST(`{a}` <> `{b}` AS BIGINT)"
    value = {f"not_null:{rel}.{c}": f"`null:{rel}/{c}`" for rel, cols in NOT_NULL.items() for c in cols}
    value |= {f"accepted_values:{rel}.{c}": f"`accepted:{rel}/{c}`" for rel, c in ACCEPTED}
    value |= {"unique:raw_orders.orders_id": "`unique:stg_orders/order_id`",  # staging keeps rows and ids
              "year_count_match": apart("mart_count", "source_count"),
              "segmented_year_count_match": apart("mart_count", "source_year_count"),
              "monthly_count_match": " + ".join(apart(f"mart_{k}", f"source_{k}") for k in range(1, 13))}
    checks = [(c.name, c.severity) for c in declared_checks(m)]
    rows = ", ".join(f"'{name}', '{severity}', CAST({value.get(name, '`' + name.replace('.', '/') + '`')} AS BIGINT)" for name, severity in checks)
    return row.select(F.expr(f"stack({len(checks)}, {rows}) AS (check_name, severity, failures)"))
