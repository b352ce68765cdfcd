"""The segment rule and the history-completeness flag."""

from __future__ import annotations

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from basketry.config import Config

# Fixed segment labels.
NEW, RETURNING, VIP, UNKNOWN = "New", "Returning", "VIP", "Unknown"
SEGMENTS = (NEW, RETURNING, VIP)


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def order_segment(prior_orders, cfg: Config) -> Column:
    """First matching band wins; NULL or a count between bands -> 'Unknown'."""
    n = _c(prior_orders)
    return (
        F.when(n <= cfg.new_customer_max_prior_orders, F.lit(NEW))
        .when(n.between(cfg.returning_min_prior_orders, cfg.returning_max_prior_orders), F.lit(RETURNING))
        .when(n >= cfg.vip_min_prior_orders, F.lit(VIP))
        .otherwise(F.lit(UNKNOWN))
    )


def complete_history_flag(order_date, cfg: Config) -> Column:
    """True when the whole look-back window lies after the dataset start.
    A NULL date gives False, never NULL."""
    d = _c(order_date)
    return F.coalesce(d >= F.lit(cfg.complete_history_from), F.lit(False))


def segment_sql(expr: str, cfg: Config) -> str:
    """The same rule as SQL text (used by the reconciliation check, which
    must derive the segment independently of the Column builder)."""
    return (
        f"CASE WHEN {expr} <= {cfg.new_customer_max_prior_orders} THEN '{NEW}' "
        f"WHEN {expr} BETWEEN {cfg.returning_min_prior_orders} AND {cfg.returning_max_prior_orders} THEN '{RETURNING}' "
        f"WHEN {expr} >= {cfg.vip_min_prior_orders} THEN '{VIP}' ELSE '{UNKNOWN}' END"
    )


def register_sql_functions(spark: SparkSession, cfg: Config) -> None:
    """Expose the rule to Spark SQL as ``order_segment(n)``. It is a SQL
    function, so Catalyst inlines it; no Python runs per row."""
    spark.sql(
        "CREATE OR REPLACE TEMPORARY FUNCTION order_segment(n BIGINT) RETURNS STRING "
        f"RETURN {segment_sql('n', cfg)}"
    )
