"""Dense daily series: date spine, zero fill, missing days.

The spine is built per key from that key's first and last day with
``sequence`` + ``explode``; its size is bounded by calendar days per key.
Values are aggregated to (key, day) before the join, so the join never fans
out raw rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def join_on_keys(left: DataFrame, right: DataFrame, keys=(), plain=(), how: str = "left") -> DataFrame:
    """Equi-join on columns of one name. A NULL in ``keys`` (the series keys)
    equals a NULL; ``plain`` columns (days) are compared as usual. The result
    has the left columns and the other right ones."""
    keys, plain = list(keys), list(plain)
    own = [c for c in right.columns if c not in keys + plain]
    other = right.select(*[F.col(c).alias(f"__right_{c}") for c in keys + plain], *own)
    conditions = [F.col(c).eqNullSafe(F.col(f"__right_{c}")) for c in keys]
    conditions += [F.col(c) == F.col(f"__right_{c}") for c in plain]
    return left.join(other, conditions, how).drop(*[f"__right_{c}" for c in keys + plain])


def date_spine(df: DataFrame, date_col: str, keys=()) -> DataFrame:
    keys = list(keys)
    bounds = df.where(F.col(date_col).isNotNull()).groupBy(*keys).agg(
        F.min(date_col).alias("__lo"), F.max(date_col).alias("__hi"))
    return bounds.select(
        *keys, F.explode(F.sequence("__lo", "__hi", F.expr("INTERVAL 1 DAY"))).alias(date_col))


def daily_sums(df: DataFrame, date_col: str, value_col: str, keys=(), out: str = "daily_value") -> DataFrame:
    keys = list(keys)
    return df.where(F.col(date_col).isNotNull()).groupBy(*keys, date_col).agg(F.sum(value_col).alias(out))


def zero_filled_daily(df: DataFrame, date_col: str, value_col: str, keys=(),
                      out: str = "daily_value") -> DataFrame:
    keys = list(keys)
    daily = daily_sums(df, date_col, value_col, keys, out)
    spine = date_spine(daily, date_col, keys)
    filled = join_on_keys(spine, daily, keys, [date_col])
    zero = F.lit(0).cast(daily.schema[out].dataType)
    return filled.select(*keys, date_col, F.coalesce(F.col(out), zero).alias(out))


def missing_days(df: DataFrame, date_col: str, keys=()) -> DataFrame:
    """Days inside [first, last] without any row."""
    keys = list(keys)
    present = df.where(F.col(date_col).isNotNull()).select(*keys, date_col).distinct()
    return join_on_keys(date_spine(present, date_col, keys), present, keys, [date_col], "left_anti")
