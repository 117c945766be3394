"""Exact money arithmetic: decimals inside, half-up rounding, doubles only in final output."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F


def as_double(value: Column, name: str) -> Column:
    return value.cast("double").alias(name)


def _rounded_quotient(top: Column, bottom: Column, digits: int) -> Column:
    """``top / bottom`` rounded once: a decimal division would round to its own scale first.

    The whole part divides exactly; what remains is below the divisor, so its digits are a whole-number division.
    """
    # an ANSI session raises on division by zero, SQL reports want NULL
    top, bottom = top.cast("decimal(26,2)"), F.nullif(bottom.cast("decimal(22,2)"), F.lit(0))
    above, below = F.abs(top), F.abs(bottom)
    rest = above % below
    whole = ((above - rest) / below).cast("decimal(26,0)")
    twice = (rest * F.lit(Decimal(2 * 10**digits)) + below).cast("decimal(32,2)")
    parts = F.call_function("div", twice, (below * 2).cast("decimal(32,2)"))
    exact = whole + parts.cast("decimal(9,0)") * F.lit(Decimal(1).scaleb(-digits))
    return F.when((top < 0) != (bottom < 0), -exact).otherwise(exact)


def mean(total: Column, count: Column, digits: int = 6) -> Column:
    return _rounded_quotient(total, count, digits)


def mean_as_double(total: Column, count: Column, name: str, digits: int = 6) -> Column:
    """``as_double`` of a ``mean``, in 64-bit whole numbers, which take a fraction of the time, wherever these are exact.

    Totals have two decimals. With at most 2^53 units of the last digit the quotient is one exact division away from the nearest double.
    """
    unit, scale = 10 ** (digits - 2), 10**digits
    cents = (total.cast("decimal(26,2)") * 100).try_cast("bigint")
    rounded = F.call_function("div", cents * (2 * unit) + count, count * 2)
    few = cents.between(0, 2**53 // unit) & count.between(1, 2**53)
    return F.when(few, rounded.cast("double") / F.lit(float(scale))).otherwise(mean(total, count, digits).cast("double")).alias(name)


def ratio(top: Column, bottom: Column, digits: int = 2) -> Column:
    return _rounded_quotient(top, bottom, digits)


def percent(part: Column, whole: Column, digits: int = 2) -> Column:
    """Share of ``whole`` in percent, NULL when ``whole`` is zero."""
    return _rounded_quotient(part * 100, whole, digits)


def growth(current: Column, previous: Column, digits: int = 2) -> Column:
    """Change against ``previous`` in percent, NULL without a previous value or when it is zero."""
    return percent(current - previous, previous, digits)
