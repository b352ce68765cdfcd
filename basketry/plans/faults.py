"""Relations with faults put in by fixed rules over the whole tables, so that
each data check can be seen to find something. A fault hits the ids divisible
by its prime number."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Fixed rules: the prime of each fault.
HEADERLESS, ODD_SEGMENT, NO_SEGMENT, ODD_PROFILE, PRIOR_PLUS_1, DROPPED, DOUBLED = 97, 101, 103, 107, 109, 113, 127
LABEL = "Other"


def _hit(prime: int):
    return F.col("order_id") % prime == 0


def faulted_lines(stg_lines: DataFrame) -> DataFrame:
    """Lines whose order id names no header."""
    return stg_lines.withColumn("order_id", F.when(_hit(HEADERLESS), -F.col("order_id")).otherwise(F.col("order_id")))


def faulted_mart(mart: DataFrame) -> DataFrame:
    """Unknown and missing segments, unknown profiles, wrong look-back counts,
    dropped and doubled orders."""
    out = (mart
           .withColumn("order_segmentation", F.when(_hit(ODD_SEGMENT), LABEL).when(~_hit(NO_SEGMENT), F.col("order_segmentation")))
           .withColumn("customer_profile", F.when(_hit(ODD_PROFILE), LABEL).otherwise(F.col("customer_profile")))
           .withColumn("prior_orders_last_12_months",
                       F.col("prior_orders_last_12_months") + F.when(_hit(PRIOR_PLUS_1), 1).otherwise(0)))
    copies = F.when(_hit(DROPPED), 0).when(_hit(DOUBLED), 2).otherwise(1)
    return out.withColumn("__copy", F.explode(F.array_repeat(F.lit(1), copies))).drop("__copy")


def faulted_headers(stg_orders: DataFrame, stg_lines: DataFrame) -> DataFrame:
    """Header totals that are the sum of the lines, 0.01 or 0.011 above it, by
    the remainder of the id by three; headers without lines as they are."""
    sums = stg_lines.groupBy(F.col("order_id").alias("__id")).agg(F.sum("line_net_sales").alias("__sum"))
    off = F.element_at(F.array(*[F.lit(x).cast("decimal(4,3)") for x in ("0.000", "0.010", "0.011")]),
                       (F.col("order_id") % 3 + 1).cast("int"))
    total = F.coalesce(F.col("__sum") + off, F.col("net_sales"))
    return (stg_orders.join(sums, F.col("order_id") == F.col("__id"), "left")
            .withColumn("net_sales", total.cast(stg_orders.schema["net_sales"].dataType)).drop("__id", "__sum"))


def doubled_headers(stg_orders: DataFrame) -> DataFrame:
    """Headers of which some stand twice, and some of those three times."""
    return (stg_orders.unionByName(stg_orders.where(_hit(HEADERLESS)))
            .unionByName(stg_orders.where(_hit(2 * HEADERLESS))))
