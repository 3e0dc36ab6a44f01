"""Column expressions: times, locations, user agents and page flags."""

from lapsewise.functions.text import browser, city, device, page_column, state
from lapsewise.functions.times import (
    MS_PER_DAY,
    MS_PER_HOUR,
    MS_PER_MINUTE,
    date_text,
    day_of_month,
    hour_of_day,
    time_text,
    weekday,
    whole_days_between,
)

__all__ = [
    "MS_PER_DAY",
    "MS_PER_HOUR",
    "MS_PER_MINUTE",
    "browser",
    "city",
    "date_text",
    "day_of_month",
    "device",
    "hour_of_day",
    "page_column",
    "state",
    "time_text",
    "weekday",
    "whole_days_between",
]
