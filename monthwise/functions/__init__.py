from monthwise.functions.formatting import bar_height, group_digits, kilo_label, round_int, zebra
from monthwise.functions.periods import (
    DEFAULT_RUN_DAYS,
    MONTH_ABBREV_ES,
    WEEKDAY_NAMES_ES,
    as_of_col,
    bound_month_start,
    dd_mm_yyyy,
    local_date,
    period_bound,
    period_bound_value,
    period_key,
    previous_month_label,
    weekday_name,
    yyyymmdd,
)

__all__ = [
    "DEFAULT_RUN_DAYS", "MONTH_ABBREV_ES", "WEEKDAY_NAMES_ES", "as_of_col", "bar_height",
    "bound_month_start", "dd_mm_yyyy", "group_digits", "kilo_label", "local_date",
    "period_bound", "period_bound_value", "period_key", "previous_month_label", "round_int",
    "weekday_name", "yyyymmdd", "zebra",
]
