"""One frozen configuration object shared by every model.

The segment thresholds, the look-back length and the dataset start date are
business constants; keeping them in one place removes the need for a separate
consistency check between the models and the metric layer.
"""

from __future__ import annotations

import datetime as _dt
from dataclasses import dataclass, replace


@dataclass(frozen=True)
class Config:
    # Fixed values of the business rule (must equal the documented rule):
    #   New = at most 0 prior orders, Returning = 1 to 3, VIP = 4 or more,
    #   prior orders are counted over the preceding 12 months.
    new_customer_max_prior_orders: int = 0
    returning_min_prior_orders: int = 1
    returning_max_prior_orders: int = 3
    vip_min_prior_orders: int = 4
    segmentation_lookback_months: int = 12
    # Earliest order date of the data set; orders before
    # dataset_start_date + lookback have an incomplete history.
    dataset_start_date: _dt.date = _dt.date(2025, 7, 9)
    # Calendar year used by the year-sliced reports and checks.
    report_year: int = 2026
    # Width of the units-per-product histogram buckets.
    histogram_bucket_width: int = 10
    # Number of rows in the top-product reports.
    top_n: int = 10

    # ------------------------------------------------------------------
    def with_(self, **kw) -> "Config":
        return replace(self, **kw)

    @property
    def complete_history_from(self) -> _dt.date:
        """First date whose full look-back window lies inside the data."""
        return add_months(self.dataset_start_date, self.segmentation_lookback_months)

    @property
    def year_start(self) -> _dt.date:
        return _dt.date(self.report_year, 1, 1)

    @property
    def year_end(self) -> _dt.date:
        """Exclusive end of the report year."""
        return _dt.date(self.report_year + 1, 1, 1)

    @property
    def two_year_start(self) -> _dt.date:
        """Start of the two-year slice that ends with the report year."""
        return _dt.date(self.report_year - 1, 1, 1)

    def validate(self) -> None:
        if not (
            self.new_customer_max_prior_orders
            < self.returning_min_prior_orders
            <= self.returning_max_prior_orders
            < self.vip_min_prior_orders
        ):
            raise ValueError("segment thresholds must be increasing and disjoint")
        if self.segmentation_lookback_months <= 0:
            raise ValueError("lookback must be positive")


def add_months(d: _dt.date, months: int) -> _dt.date:
    """Calendar month arithmetic that clamps to the month end (like SQL)."""
    m = d.month - 1 + months
    y = d.year + m // 12
    m = m % 12 + 1
    last = [31, 29 if (y % 4 == 0 and (y % 100 != 0 or y % 400 == 0)) else 28,
            31, 30, 31, 30, 31, 31, 30, 31, 30, 31][m - 1]
    return _dt.date(y, m, min(d.day, last))


# Defaults of the original data set.
REFERENCE_CONFIG = Config()

# The generated test tables span 1995-01-01 .. 2001-08-01; 1998 is a full
# year with complete histories, so it plays the role of the report year.
DRIVER_CONFIG = Config(dataset_start_date=_dt.date(1995, 1, 1), report_year=1998)
