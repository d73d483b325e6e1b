"""Exact money arithmetic over double columns.

Binary floating point makes ``round(price * 1.18, 2)`` depend on the engine, and sums depend on row
order. Amounts of up to six decimals are taken as millionths in a bigint, which keeps the work in
primitive codegen, or as DECIMAL where they are too large for that; both give the same, exactly rounded
result. Each operand is tested by itself. What neither can hold, more decimals or 1e13 and beyond, is
computed in double and rounded, never cut or dropped. NaN and infinite amounts count as null.

Sums and means add millionths, and what an amount has beyond its nearest millionth as an integer of its
own, in parts of 1e-15: the same result whatever the order of rows, rounded once.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

from tierline import settings

MILLION = 10**6
SAFE = 2**53  # integers up to here are exact as double too
LONG = 2**62  # products up to here fit a bigint with room for rounding
SMALL = SAFE // MILLION  # amounts up to here have exact millionths
LARGE = 1e13  # decimal(19,6) holds amounts below
SUMMED = 1e6  # amounts whose whole units are summed as bigint, whatever the number of rows
WHOLE = 1e16  # beyond, a double has no fraction; decimal(22,6) holds amounts below
FINE = 1e15  # parts of a unit in which the distance from the nearest millionth is summed


def finite(value: Column) -> Column:
    value = value.cast("double")
    return F.when(F.abs(value) < float("inf"), value)


def millionths(value: Column) -> Column:
    return F.rint(value * float(MILLION)).try_cast("bigint")


def _as_decimal(value: Column, digits: int = 19) -> Column:
    return value.try_cast(f"decimal({digits},6)")


def _six(value: Column) -> Column:
    """Whether a number has at most six decimals and fits decimal(19,6)."""
    small = (F.abs(value) < SMALL) & (F.rint(value * float(MILLION)) / float(MILLION) == value)
    return small | ((F.abs(value) < LARGE) & (_as_decimal(value).cast("double") == value))


def _divided(amount: Column, unit: Column | int) -> Column:
    """Bigint division, rounded half-up away from zero."""
    unit = F.lit(unit).cast("bigint") if isinstance(unit, int) else unit
    half_unit = F.call_function("div", unit, F.lit(2).cast("bigint"))
    quotient = F.call_function("div", F.abs(amount) + half_unit, unit)
    return F.when(amount < 0, -quotient).otherwise(quotient)


def _cents(amount: Column, unit: int) -> Column:
    """``amount`` in 1/unit parts as a double of two places."""
    return _divided(amount, unit // 100) / F.lit(100.0)


def _decimal_cents(amount: Column) -> Column:
    return F.round(amount, 2).cast("double")


def _factor_parts(factor: Decimal) -> tuple[int, int]:
    """The factor as an integer over a power of ten."""
    scale = 10 ** max(0, -factor.as_tuple().exponent)
    return int(factor * scale), scale


def revenue(price: Column, factor: Decimal = Decimal(1)) -> Column:
    """``price`` times ``factor``, rounded to two places."""
    numerator, scale = _factor_parts(factor)
    raw, price = price.cast("double"), finite(price)
    parts = F.rint(raw * float(MILLION))
    return (
        F.when(
            (F.abs(raw) < SMALL // max(1, numerator)) & (parts / float(MILLION) == raw),  # the usual case, cheaply
            _cents(parts.cast("bigint") * F.lit(numerator), MILLION * scale),
        )
        .when(_six(price), _decimal_cents(_as_decimal(price) * F.lit(factor)))
        .otherwise(F.round(price * float(factor), 2))
    )


def revenue_with_tax(price: Column, rate: Decimal = settings.TAX_RATE) -> Column:
    return revenue(price, 1 + rate)


def price_with_tax(price: Column, rate: Decimal = settings.TAX_RATE) -> Column:
    """Unrounded."""
    numerator, scale = _factor_parts(1 + rate)
    price = finite(price)
    exact = (F.abs(price) < SMALL // numerator) & _six(price)
    product = millionths(price) * F.lit(numerator)
    return F.when(exact, product / F.lit(float(MILLION * scale))).otherwise(price * float(1 + rate))


def net_revenue(price: Column, discount: Column | None = None) -> Column:
    """Revenue after a fractional discount; without one it equals ``revenue``."""
    if discount is None:
        return revenue(price)
    discount = finite(discount)
    kept = F.when(_six(discount), F.round(F.lit(1.0) - discount, 6)).otherwise(F.lit(1.0) - discount)
    return _product(price, kept)


def inventory_value(price: Column, quantity: Column) -> Column:
    """``price`` times a whole quantity, rounded to two places."""
    return _product(price, quantity)


def _product(left: Column, right: Column) -> Column:
    left, right = finite(left), finite(right)
    exact = _six(left) & _six(right)
    inside = (F.abs(left) < SMALL) & (F.abs(right) < SMALL) & (F.abs(left * right) < LONG // MILLION**2)
    return (
        F.when(exact & inside, _cents(millionths(left) * millionths(right), MILLION**2))
        .when(exact & (F.abs(right) < LARGE / 10), _decimal_cents(_as_decimal(left) * _as_decimal(right, 18)))
        .otherwise(F.round(left * right, 2))
    )


def price_change(price: Column, previous: Column) -> Column:
    """Difference to the previous price; 0 where there is none."""
    price = finite(price)
    previous = F.coalesce(finite(previous), price)
    exact = _six(price) & _six(previous)
    change = millionths(price) - millionths(previous)
    return (
        F.when(exact & (F.greatest(F.abs(price), F.abs(previous)) < SMALL), _cents(change, MILLION))
        .when(exact, _decimal_cents(_as_decimal(price) - _as_decimal(previous)))
        .otherwise(F.round(price - previous, 2))
    )


def _sums(value: Column) -> tuple[Column, Column, Column]:
    """Aggregates: the exact sum as a decimal, the sum of what has no cents as a double, and the count.

    Small amounts are summed as bigint, whole units and millionths apart. Their millionths are rounded
    from the amount itself, so a large whole part does not blur them; larger amounts are decimals. What
    either leaves of the amount is summed in parts of 1e-15; the sum is cut towards zero to six places.
    """
    value = finite(value)
    size = F.abs(value)
    parts = F.when(size < SUMMED, millionths(value))
    whole = F.sum(F.call_function("div", parts, F.lit(MILLION)))
    fraction = F.sum(parts % MILLION)
    large = F.sum(F.when((size >= SUMMED) & (size < WHOLE), _as_decimal(value, 22)))
    zero = F.lit(0).cast("decimal(38,6)")
    amount = (
        F.coalesce(whole.cast("decimal(30,6)"), zero)
        + F.coalesce(fraction.cast("decimal(20,0)") * F.lit(Decimal("0.000001")), zero)
        + F.coalesce(large.cast("decimal(37,6)"), zero)
    )
    left = (value - F.rint(value * float(MILLION)) / float(MILLION)) * FINE
    left = F.coalesce(F.sum(F.when(size < SMALL, F.rint(left).cast("bigint"))), F.lit(0)).cast("double") * (MILLION / FINE)
    below = amount.cast("double") + left / MILLION < 0
    cut = F.when(below, F.ceil(left)).otherwise(F.floor(left)).cast("decimal(20,0)") * F.lit(Decimal("0.000001"))
    return (amount + cut).cast("decimal(38,6)"), F.sum(F.when(size >= WHOLE, value)), F.count(value)


def total(value: Column) -> Column:
    """Aggregate: exact sum, rounded to two places; null without amounts."""
    amount, huge, rows = _sums(value)
    whole = _decimal_cents(amount)
    return F.when(rows > 0, F.when(huge.isNull(), whole).otherwise(F.round(huge + whole, 2)))


def mean(value: Column) -> Column:
    """Aggregate: average rounded half-up to two places.

    ``round(avg(x), 2)`` rounds twice, first to the scale of the quotient. Integer division of the
    exact sum rounds once.
    """
    amount, huge, rows = _sums(value)
    twice = F.nullif(rows * 2, F.lit(0))
    hundredths = F.call_function("div", F.abs(amount).cast("decimal(34,6)") * 200 + rows, twice)
    exact = F.when(amount < 0, -hundredths).otherwise(hundredths) / F.lit(100.0)
    return F.when(huge.isNull(), exact).otherwise(F.round((huge + amount.cast("double")) / twice * 2, 2))
