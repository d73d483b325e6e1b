"""Numbers and codes to labels. A null input always takes the fallback label."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from tierline import settings


def bucket(value: Column, bounds: list[tuple[float, str]], otherwise: str) -> Column:
    """Label of the first bound that ``value`` lies below; bounds ascend."""
    first, *rest = [(value < bound, F.lit(label)) for bound, label in bounds]
    return reduce(lambda chain, branch: chain.when(*branch), rest, F.when(*first)).otherwise(F.lit(otherwise))


def map_values(value: Column, groups: dict[str, list], otherwise: str) -> Column:
    """Label of the group that lists ``value``. For long lists use ``operators.lookup``."""
    first, *rest = [(value.isin(members), F.lit(label)) for label, members in groups.items()]
    return reduce(lambda chain, branch: chain.when(*branch), rest, F.when(*first)).otherwise(F.lit(otherwise))


def flag(predicate: Column) -> Column:
    """The predicate as a plain boolean: unknown counts as false."""
    return F.coalesce(predicate, F.lit(False))


def price_bucket(price: Column) -> Column:
    return bucket(price, *settings.PRICE_BUCKETS)


def price_tier(price: Column) -> Column:
    return bucket(price, *settings.PRICE_TIERS)


def tenure_bucket(days: Column) -> Column:
    return bucket(days, *settings.TENURE_BUCKETS)


def stock_status(quantity: Column) -> Column:
    empty, low, full = settings.STOCK_LABELS
    return F.when(quantity == 0, empty).when(quantity < settings.LOW_STOCK, low).otherwise(full)


def category_group(category: Column) -> Column:
    return map_values(category, settings.CATEGORY_GROUPS, settings.OTHER)


def region(country: Column) -> Column:
    return map_values(country, settings.REGIONS, settings.OTHER)


def season(month: Column) -> Column:
    return map_values(month, settings.SEASONS, settings.LAST_SEASON)


def is_highly_rated(rating: Column) -> Column:
    return flag(rating >= settings.HIGH_RATING)


def is_domestic(country: Column) -> Column:
    return flag(country == settings.HOME_COUNTRY)


def is_active(value: Column) -> Column:
    return flag(value == 1)


def clamp_low(value: Column, low: int | float = 0) -> Column:
    """``value``, or ``low`` where it lies below; null stays null (``greatest`` would hide it)."""
    return F.when(value < low, F.lit(low)).otherwise(value)
