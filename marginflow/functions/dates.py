"""Integer YYYYMMDD date keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def date_key(c: Column) -> Column:
    return (F.year(c) * 10000 + F.month(c) * 100 + F.dayofmonth(c)).cast("int")


def key_date(c: Column) -> Column:
    return F.to_date(c.cast("string"), "yyyyMMdd")


def month_key(c: Column) -> Column:
    """YYYYMM of a date key."""
    return F.floor(c / 100).cast("int")


def calendar_fields(day: Column, weekend_days: tuple[str, ...]) -> dict[str, Column]:
    """The derived calendar columns of a day, ISO week numbering."""
    weekday = F.date_format(day, "EEEE")
    return {
        "date_key": date_key(day),
        "full_date": day,
        "day_of_week": weekday,
        "week_of_year": F.weekofyear(day),
        "month": F.month(day),
        "quarter": F.quarter(day),
        "year": F.year(day),
        "is_weekend": weekday.isin(*weekend_days),
    }
