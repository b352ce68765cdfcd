"""Reusable relational operators built from DataFrame/SQL primitives."""

from basketry.operators.lookback import day_history, with_prior_orders
from basketry.operators.spine import date_spine, zero_filled_daily, missing_days
from basketry.operators.checks import (
    Check, not_null, unique, accepted_values, relationships, null_count_summary, run_checks,
)
from basketry.operators.explore import Measure, Dimension, View, explore

__all__ = [
    "day_history", "with_prior_orders",
    "date_spine", "zero_filled_daily", "missing_days",
    "Check", "not_null", "unique", "accepted_values", "relationships", "null_count_summary", "run_checks",
    "Measure", "Dimension", "View", "explore",
]
