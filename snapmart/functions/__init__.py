from snapmart.functions.scalars import (
    as_flag,
    cut_text,
    day_of,
    day_text,
    escape_markup,
    hours_between,
    interval_hours,
    micros_between,
    minutes_between,
    moment,
    money,
    percent_of,
    ratio,
    within_days,
)

__all__ = [
    "as_flag",
    "cut_text",
    "day_of",
    "day_text",
    "escape_markup",
    "hours_between",
    "interval_hours",
    "micros_between",
    "minutes_between",
    "moment",
    "money",
    "percent_of",
    "ratio",
    "within_days",
]
