"""Money and ratio helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

# Warehouse NUMERIC: 38 digits, 9 after the point.
MONEY = DecimalType(38, 9)
# Rounded money: cents with the full 38-digit range, so grand totals of very
# large inputs cannot overflow (ANSI mode raises on overflow). Below 2**53
# cents the conversion to DOUBLE is exact-to-nearest in every engine.
CENTS = DecimalType(38, 2)


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def safe_divide(num, den) -> Column:
    """NULL instead of an error or infinity when the denominator is 0/NULL."""
    return F.try_divide(_c(num), F.nullif(_c(den), F.lit(0)))


def money(x, digits: int = 2) -> Column:
    """Round half away from zero to ``digits`` and present as DOUBLE."""
    return F.round(_c(x), digits).cast(CENTS).cast("double")


def floor_at_zero(x) -> Column:
    """``x`` below 0 becomes 0; NULL stays NULL. (``greatest`` would turn a
    NULL into 0 because it skips NULL arguments.)"""
    x = _c(x)
    return F.when(x < 0, F.lit(0.0)).otherwise(x)
