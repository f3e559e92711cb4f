"""Calendar columns of a date."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def calendar_columns(date: Column) -> dict[str, Column]:
    """The eight calendar features; weeks are ISO, Monday is 0, month edges are calendar days."""
    return {
        "day_of_week": F.weekday(date),
        "day_of_month": F.dayofmonth(date),
        "week_of_year": F.weekofyear(date),
        "month": F.month(date),
        "quarter": F.quarter(date),
        "year": F.year(date),
        "is_month_start": (F.dayofmonth(date) == 1).cast("int"),
        "is_month_end": (date == F.last_day(date)).cast("int"),
    }


def date_labels(date: Column) -> dict[str, Column]:
    """ISO text, short month and short weekday."""
    return {
        "iso_date": F.date_format(date, "yyyy-MM-dd"),
        "month_label": F.date_format(date, "MMM"),
        "weekday_label": F.date_format(date, "EEE"),
    }
