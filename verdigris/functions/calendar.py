"""Calendar attributes of a timestamp."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from verdigris.schemas import TIMESTAMP_FORMAT


def calendar(ts: Column) -> dict[str, Column]:
    """Attributes of the time dimension. Sunday is day 1, weeks are ISO weeks."""
    weekday = F.dayofweek(ts)
    return {
        "timestamp_full": F.date_format(ts, TIMESTAMP_FORMAT),
        "date": F.date_format(ts, "yyyy-MM-dd"),
        "time": F.date_format(ts, "HH:mm:ss"),
        "year": F.year(ts),
        "quarter": F.quarter(ts),
        "month": F.month(ts),
        "week_of_year": F.weekofyear(ts),
        "day_of_month": F.dayofmonth(ts),
        "day_of_week": weekday,
        "hour": F.hour(ts),
        "minute": F.minute(ts),
        "day_name": F.date_format(ts, "EEEE"),
        "month_name": F.date_format(ts, "MMMM"),
        "day_type": F.when(weekday.isin(1, 7), "Weekend").otherwise("Weekday"),
    }
