"""Exact arithmetic for the published 2-decimal figures.

A reading enters sums as the decimal that it prints as (16 decimals kept),
so nothing is rounded before it is added: sums are exact and independent
of summation order and partitioning.  Only the published figure is
rounded, once, half away from zero.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

PUBLISHED_DECIMAL = "decimal(10,2)"
READING_DECIMAL = "decimal(26,16)"
TOTAL_DECIMAL = "decimal(36,16)"
# Any exact total, rounded to cents.
STORED_TOTAL_DECIMAL = "decimal(24,2)"
# A larger figure does not fit the published decimal.
PUBLISHABLE = 1e8
# Text of a plain decimal number: no NaN, infinity or type suffix.
NUMBER = r"^\s*[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]{1,3})?\s*$"


def _col(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def measure(col) -> Column:
    """Text (or number) -> double; NULL unless a plain number that can be published."""
    c = _col(col)
    value = F.when(c.cast("string").rlike(NUMBER), c.try_cast("double"))
    return F.when(F.abs(value) < PUBLISHABLE, value)


def over_limit(col) -> Column:
    """Is it a plain number that is too large to publish?"""
    c = _col(col)
    return c.cast("string").rlike(NUMBER) & (F.abs(c.try_cast("double")) >= PUBLISHABLE)


def exact(col) -> Column:
    """A reading as the decimal it prints as (overflow raises under ANSI)."""
    return _col(col).cast(READING_DECIMAL)


def exact_total(col) -> Column:
    """Aggregate: exact sum of a measure, ``decimal(36,16)``."""
    return F.sum(exact(col)).cast(TOTAL_DECIMAL)


def half_up_mean(total: Column, count: Column) -> Column:
    """``total / count`` rounded half away from zero to 2 decimals, as a
    double; NULL when ``count`` is 0.

    The double quotient gives a candidate that is at most one cent off; the
    exact remainder ``total - candidate * count`` then decides, so ties such
    as 2.01 / 2 are decided exactly.
    """
    t, n = total.cast(TOTAL_DECIMAL), count.cast("decimal(15,0)")
    near = F.round(t.cast("double") / count, 2).cast("decimal(20,2)")
    rest = t - (near * n).cast(TOTAL_DECIMAL)
    half = n * F.lit(Decimal("0.005"))
    up = F.when(t < 0, rest > half).otherwise(rest >= half)
    down = F.when(t < 0, rest <= -half).otherwise(rest < -half)
    cent = F.lit(Decimal("0.01"))
    return F.when(count > 0, F.when(up, near + cent).when(down, near - cent).otherwise(near).cast("double"))


def half_up_mean_of(col: str) -> Column:
    """Aggregate: 2-decimal mean of a measure (NULL for an empty group)."""
    return half_up_mean(exact_total(col), F.count(col))


def dec2(col) -> Column:
    """Cast to the published ``decimal(10,2)`` (overflow raises under ANSI)."""
    return _col(col).cast(PUBLISHED_DECIMAL)


def exact_sum(col: str) -> Column:
    """Aggregate: exact sum published as ``decimal(10,2)``."""
    return dec2(exact_total(col))


def mean_and_sd_from_sums(n: Column, s: Column, ss: Column) -> tuple[Column, Column]:
    """Mean and sample standard deviation from exact moments.

    ``n`` = count, ``s`` = exact sum, ``ss`` = exact sum of squares.
    ``sd`` is NULL for a single value, like ``stddev_samp``.
    """
    mean = s.cast("double") / n
    numerator = (n.cast("decimal(20,0)") * ss - s * s).cast("double")
    sd = F.when(n > 1, F.sqrt(numerator / (n.cast("double") * (n - 1))))
    return mean, sd
