"""Calendar helpers on DATE columns."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F

GRAINS = ("day", "week", "month", "quarter", "year")


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def month_start(d) -> Column:
    """First day of the month, still a DATE (``date_trunc`` would give a
    timestamp)."""
    return F.trunc(_c(d), "month")


def quarter_start(d) -> Column:
    return F.trunc(_c(d), "quarter")


def week_start_sunday(d) -> Column:
    """Sunday-based week start. ``trunc(d, 'week')`` is Monday-based."""
    d = _c(d)
    return F.date_sub(d, F.dayofweek(d) - 1)


def week_start_monday(d) -> Column:
    return F.trunc(_c(d), "week")


def date_at_grain(d, grain: str, week_start: str = "sunday") -> Column:
    """Date truncated to ``grain`` (day/week/month/quarter/year), as DATE."""
    d = _c(d)
    if grain == "day":
        return d
    if grain == "week":
        return week_start_sunday(d) if week_start == "sunday" else week_start_monday(d)
    if grain in ("month", "quarter", "year"):
        return F.trunc(d, grain)
    raise ValueError(f"unknown grain {grain!r}; expected one of {GRAINS}")


def calendar_columns(d, prefix: str = "order") -> list[Column]:
    """year and month as BIGINT and the month start as DATE."""
    d = _c(d)
    return [
        F.year(d).cast("bigint").alias(f"{prefix}_year"),
        F.month(d).cast("bigint").alias(f"{prefix}_month"),
        month_start(d).alias(f"{prefix}_month_start"),
    ]


def month_abbrev(d) -> Column:
    return F.date_format(_c(d), "MMM")


def in_range(d, start: _dt.date, end: _dt.date) -> Column:
    """Half-open range ``start <= d < end``. Unlike ``year(d) = y`` this is
    pushed down to the parquet scan."""
    d = _c(d)
    return (d >= F.lit(start)) & (d < F.lit(end))


def in_year_folders(start: _dt.date | None, end: _dt.date | None, year: str = "order_year") -> Column | None:
    """The years of a half-open range as a predicate on the calendar year,
    which the marts keep in folders: files of other years are not listed."""
    out = None
    if start is not None:
        out = F.col(year) >= start.year
    if end is not None:
        last = F.col(year) <= (end - _dt.timedelta(days=1)).year
        out = last if out is None else out & last
    return out


def within(df, start: _dt.date, end: _dt.date, d: str = "order_date", year: str = "order_year"):
    """The rows of a half-open date range; of a mart in year folders, only
    those years are read."""
    keep = in_range(d, start, end)
    return df.where(in_year_folders(start, end, year) & keep if year in df.columns else keep)
