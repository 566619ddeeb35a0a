"""Null-safe arithmetic and the rounding rules of the published tables."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def ratio(a: Column, b: Column) -> Column:
    """Double quotient; null when the divisor is zero."""
    return F.try_divide(a.cast("double"), b.cast("double"))


def ratio_or_zero(a: Column, b: Column, cap: float | None = None) -> Column:
    quotient = F.coalesce(F.nanvl(ratio(a, b), F.lit(None).cast("double")), F.lit(0.0))
    return quotient if cap is None else F.least(quotient, F.lit(float(cap)))


def percent(part: Column, whole: Column, places: int = 2) -> Column:
    return F.round(ratio(F.lit(100.0) * part, whole), places)


def whole_units(c: Column) -> Column:
    """Cut toward zero. The value is rounded to nine places first, so a sum that is
    one last bit below an integer does not lose a whole unit."""
    return F.round(c, 9).cast("bigint")


def half_even(c: Column) -> Column:
    """Round to the nearest integer, ties to the even neighbour."""
    return F.bround(c, 0).cast("bigint")


def nan_to_null(c: Column) -> Column:
    return F.when(~F.isnan(c), c)


def to_number(c: Column) -> Column:
    """Numeric value of a text, null when it is not a number."""
    return c.try_cast("double")
