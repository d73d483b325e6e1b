"""Timestamps, date parts and tenure."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

from tierline import settings
from tierline.functions.labels import flag


def parse_timestamp(value: Column, pattern: str | None = None) -> Column:
    """Text to timestamp; unparsable text gives null. Timestamps pass through."""
    return F.try_to_timestamp(value, F.lit(pattern)) if pattern else F.try_to_timestamp(value)


def is_weekend(weekday: Column) -> Column:
    return flag(weekday.isin(settings.WEEKEND_DAYS))


def date_parts(date: Column, prefix: str = "") -> dict[str, Column]:
    """year, month, day, weekday (1 = Sunday) under ``prefix``, and is_weekend."""
    return {
        f"{prefix}year": F.year(date),
        f"{prefix}month": F.month(date),
        f"{prefix}day": F.dayofmonth(date),
        f"{prefix}weekday": F.dayofweek(date),
        "is_weekend": is_weekend(F.dayofweek(date)),
    }


def tenure_days(since: Column, as_of: dt.date | None = None) -> Column:
    today = F.current_date() if as_of is None else F.lit(as_of)
    return F.datediff(today, since)
