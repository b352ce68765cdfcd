"""Column -> Column helpers. All of them are built-in Spark expressions, so
they stay inside whole-stage code generation; none is a Python UDF."""

from basketry.functions.segments import order_segment, complete_history_flag, register_sql_functions
from basketry.functions.dates import (
    month_start, quarter_start, week_start_sunday, date_at_grain, calendar_columns,
    month_abbrev, in_range,
)
from basketry.functions.numeric import safe_divide, money, floor_at_zero, MONEY

__all__ = [
    "order_segment", "complete_history_flag", "register_sql_functions",
    "month_start", "quarter_start", "week_start_sunday", "date_at_grain", "calendar_columns",
    "month_abbrev", "in_range", "safe_divide", "money", "floor_at_zero", "MONEY",
]
