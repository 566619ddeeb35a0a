"""Sample skewness and excess kurtosis from power sums.

Zeros add nothing to a power sum, so the moments of a zero-filled daily series follow
from the days with sales and the length of the calendar alone: the dense series is
never built.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def power_sums(x: Column, prefix: str = "s") -> list[Column]:
    """Aggregates s1..s4 = sum of x, x^2, x^3, x^4."""
    x = x.cast("double")
    powers = [x, x * x, x * x * x, x * x * x * x]
    return [F.sum(p).alias(f"{prefix}{i}") for i, p in enumerate(powers, start=1)]


def _central(n: Column, prefix: str) -> tuple[Column, Column, Column]:
    m = [F.col(f"{prefix}{i}") / n for i in range(1, 5)]
    mean = m[0]
    second = m[1] - mean * mean
    third = m[2] - 3 * mean * m[1] + 2 * mean * mean * mean
    fourth = m[3] - 4 * mean * m[2] + 6 * mean * mean * m[1] - 3 * F.pow(mean, F.lit(4))
    return second, third, fourth


def _is_constant(n: Column, second: Column, prefix: str) -> Column:
    # Relative test: the subtraction above leaves rounding noise for a constant series.
    return second <= F.lit(1e-12) * (F.col(f"{prefix}2") / n)


def sample_skewness(n: Column, prefix: str = "s") -> Column:
    """Bias-corrected skewness: null below 3 values, 0 for a constant series."""
    n = n.cast("double")
    second, third, _ = _central(n, prefix)
    biased = F.try_divide(third, F.pow(second, F.lit(1.5)))
    corrected = F.try_divide(F.sqrt(n * (n - 1)), n - 2) * biased
    return F.when(n < 3, F.lit(None)).when(_is_constant(n, second, prefix), 0.0).otherwise(corrected)


def sample_excess_kurtosis(n: Column, prefix: str = "s") -> Column:
    """Bias-corrected excess kurtosis: null below 4 values, 0 for a constant series."""
    n = n.cast("double")
    second, _, fourth = _central(n, prefix)
    biased = F.try_divide(fourth, second * second) - 3
    corrected = F.try_divide(n - 1, (n - 2) * (n - 3)) * ((n + 1) * biased + 6)
    return F.when(n < 4, F.lit(None)).when(_is_constant(n, second, prefix), 0.0).otherwise(corrected)
