"""Rolling look-back count of a customer's earlier orders.

Definition: for an order of customer ``c`` on day ``d`` count the orders of
``c`` with ``d - N months <= day < d`` (lower bound inclusive, same-day orders
excluded, NULL customer or NULL date count 0, NULL order ids are not counted).

Plan, chosen for skew: the count depends only on (customer, day), so orders
are first reduced to one row per (customer, day) with a map-side partial
aggregate. A customer holding a third of all orders then contributes at most
one row per calendar day, and the range window over days runs on a table
whose per-customer size is bounded by the calendar, not by order volume.
The result is joined back on (customer, day); a hot (customer, day) key on
the order side is split by adaptive skew-join handling, and the day side is
broadcast at runtime only when its measured size is small.

A join of orders with orders on customer and a date range (the textbook
form) would emit every pair of orders of a customer inside the window; it is
used only as a brute-force check on small fixtures in the tests.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def day_history(orders: DataFrame, months: int, customer: str = "customer_id",
                date: str = "order_date", order_id: str = "order_id") -> DataFrame:
    """One row per (customer, day) with ``day_orders`` and ``prior_orders``,
    plus ``last_day_prior_orders``: the prior count on the customer's latest
    order day (the customer's current state)."""
    daily = (
        orders.where(F.col(customer).isNotNull() & F.col(date).isNotNull())
        .groupBy(customer, date)
        .agg(F.count(order_id).alias("day_orders"))
    )
    window = (f"PARTITION BY `{customer}` ORDER BY `{date}` "
              f"RANGE BETWEEN INTERVAL {int(months)} MONTHS PRECEDING AND CURRENT ROW")
    # Frame includes the current day; subtract it so same-day orders never
    # see each other. (A frame ending "1 day preceding" cannot be combined
    # with a month-interval start in one frame.)
    with_prior = daily.withColumn(
        "prior_orders", F.expr(f"sum(day_orders) OVER ({window})") - F.col("day_orders"))
    per_customer = Window.partitionBy(customer)
    return with_prior.withColumn(
        "last_day_prior_orders", F.max_by("prior_orders", F.col(date)).over(per_customer)
    ).withColumn("is_last_day", F.col(date) == F.max(date).over(per_customer))


def with_prior_orders(orders: DataFrame, months: int, customer: str = "customer_id",
                      date: str = "order_date", order_id: str = "order_id",
                      prior_col: str = "prior_orders", current_col: str | None = None) -> DataFrame:
    """Add ``prior_col`` (look-back count) to every order and, when
    ``current_col`` is given, the customer's latest-day count (``NULL`` for a
    NULL customer).

    One left equi-join on (customer, day key, day-is-NULL): every customer's
    latest day is emitted a second time under the NULL-day key with a prior
    count of 0, so an order with a NULL date still receives its customer's
    current state. The lookup side is grouped on its key (a no-op: keys are
    already unique) so that Catalyst knows it holds one row per key and
    removes the join from queries that use none of its columns."""
    days = day_history(orders, months, customer, date, order_id)
    null_day = F.lit("1970-01-01").cast("date")
    entry = lambda d, is_null, prior: F.struct(
        d.alias("__k_day"), is_null.alias("__k_day_null"), prior.alias("__k_prior"))
    own = entry(F.col(date), F.lit(False), F.col("prior_orders"))
    undated = entry(null_day, F.lit(True), F.lit(0).cast("bigint"))
    pairs = F.when(F.col("is_last_day"), F.array(own, undated)).otherwise(F.array(own))
    keyed = (days.select(F.col(customer).alias("__k_customer"),
                         F.col("last_day_prior_orders").alias("__k_cur"), F.inline(pairs))
             .groupBy("__k_customer", "__k_day", "__k_day_null")
             .agg(F.max("__k_prior").alias("__k_prior"), F.max("__k_cur").alias("__k_current")))
    cond = ((F.col(customer) == F.col("__k_customer"))
            & (F.coalesce(F.col(date), null_day) == F.col("__k_day"))
            & (F.col(date).isNull() == F.col("__k_day_null")))
    joined = orders.join(keyed, cond, "left")
    out_cols = [F.col(c) for c in orders.columns]
    out_cols.append(F.coalesce(F.col("__k_prior"), F.lit(0).cast("bigint")).alias(prior_col))
    if current_col:
        out_cols.append(F.col("__k_current").alias(current_col))
    return joined.select(*out_cols)
