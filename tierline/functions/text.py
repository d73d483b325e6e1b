"""Text normalisation and names."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tierline import settings
from tierline.functions.labels import flag


def trimmed(value: Column) -> Column:
    return F.trim(value)


def lowered(value: Column) -> Column:
    return F.lower(F.trim(value))


def raised(value: Column) -> Column:
    return F.upper(F.trim(value))


def is_valid_email(value: Column) -> Column:
    return flag(value.rlike(settings.EMAIL_PATTERN))


def full_name(*parts: Column) -> Column:
    """Parts joined by a space; null if any part is null."""
    spaced = [item for part in parts for item in (F.lit(" "), part)][1:]
    return F.concat(*spaced)


def display_name(*parts: Column) -> Column:
    """Parts joined by a space; null parts are skipped."""
    return F.concat_ws(" ", *parts)
