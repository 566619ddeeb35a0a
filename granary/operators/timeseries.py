"""Daily demand series.

The zero-filled series is only materialised where it is the result
(``zero_fill``, ``ewm_series``). Last-value statistics use closed forms over the days
that have sales, because a day with quantity 0 changes only the length of the series.
"""

from __future__ import annotations

import datetime as dt
import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from granary.functions import dates, moments

# Largest exponent (base e) of a weight that is anchored at the end of its block of days.
_EXPONENT = 300.0


def _block_days(alpha: float) -> int:
    """Days over which the weights of a smoothing factor stay far from the ends of a double."""
    return max(1, int(_EXPONENT / -math.log1p(-alpha)))


def daily_totals(
    df: DataFrame, keys: list[str], date_column: str, quantity: str, out: str = "qty_sold"
) -> DataFrame:
    """Quantity per key and day. Partial sums are taken before the shuffle, so a hot key
    sends at most one row per day and task."""
    return _whole(df.groupBy(*keys, date_column).agg(F.sum(F.coalesce(quantity, F.lit(0))).alias(out)), out)


def _whole(sums: DataFrame, *columns: str) -> DataFrame:
    """Keep these columns of an aggregate even where only others are used.

    They are never null; the test makes a subquery over ``sums`` compute the aggregate that
    the main query computes, so Spark runs it, and the scan below it, once.
    """
    for c in columns:
        sums = sums.filter(F.col(c).isNotNull())
    return sums


def date_bounds(df: DataFrame, first: str, last: str | None = None) -> tuple[Column, Column]:
    """First and last date as scalar subqueries. Pass sums that the query needs anyway
    (``daily_totals``), not raw lines: then no line is read a second time."""
    return df.agg(F.min(first)).scalar(), df.agg(F.max(last or first)).scalar()


def zero_fill(
    daily: DataFrame,
    keys: list[str],
    date_column: str,
    value: str,
    bounds: tuple[Column, Column] | None = None,
) -> DataFrame:
    """Dense daily series per key; days without a row get 0.

    ``daily`` has one row per key and day. With ``bounds`` every key spans the same
    calendar, otherwise each key spans its own first to last day. Each row is expanded
    to the days up to its successor: no calendar x key product and no join.
    """
    series = Window.partitionBy(*keys).orderBy(date_column)
    day = F.col(date_column)
    is_first = F.lag(day).over(series).isNull()
    following = F.lead(day).over(series)
    if bounds is None:
        start, end = day, F.coalesce(F.date_sub(following, 1), day)
    else:
        start = F.when(is_first, bounds[0]).otherwise(day)
        end = F.coalesce(F.date_sub(following, 1), bounds[1])
    return (
        daily.select(*keys, date_column, value, start.alias("_from"), end.alias("_to"))
        .select(*keys, date_column, value, F.explode(F.sequence("_from", "_to")).alias("_day"))
        .select(
            *keys,
            F.col("_day").alias(date_column),
            F.when(F.col("_day") == day, F.col(value)).otherwise(F.lit(0)).alias(value),
        )
    )


def ewm_normaliser(days: Column, alpha: float = 0.5) -> Column:
    """Sum of the weights (1-alpha)^k for k = 0 .. days-1."""
    return (F.lit(1.0) - F.pow(F.lit(1.0 - alpha), days)) / F.lit(alpha)


def decayed_quantity(quantity: Column, day: Column, pivot: Column, alpha: float = 0.5) -> Column:
    """Quantity weighted by its age in days at ``pivot``."""
    return quantity.cast("double") * F.pow(F.lit(1.0 - alpha), dates.days_between(day, pivot))


def ewm_from_decayed(total: Column, first: Column, last: Column, alpha: float = 0.5) -> Column:
    """Exponentially weighted mean at ``last`` of the zero-filled series [first, last],
    from the total decayed to ``last``."""
    return total / ewm_normaliser(dates.days_between(first, last) + 1, alpha)


def ewm_last(
    df: DataFrame,
    keys: list[str],
    date_column: str,
    quantity: str,
    alpha: float = 0.5,
    out: str = "run_rate",
) -> DataFrame:
    """Last value of the exponentially weighted mean per key.

    All keys span the first to the last date of ``df``. One aggregate takes each key's
    quantities, decayed to the end of a block of days, and its first and last day; the
    overall dates and the last values follow from these few rows. Blocks are so long (432
    days for a factor of 0.5) that a usual window is one or two, and so short that no weight
    leaves the range of a double.
    """
    length = _block_days(alpha)
    number = F.datediff(F.col(date_column), F.lit(dt.date(1970, 1, 1)))
    block = F.floor(number / length)
    age = (block + 1) * length - 1 - number
    decayed = F.coalesce(quantity, F.lit(0)).cast("double") * F.pow(F.lit(1.0 - alpha), age)
    sums = _whole(
        df.groupBy(*keys, block.alias("_block")).agg(
            F.sum(decayed).alias("_decayed"), F.min(date_column).alias("_first"), F.max(date_column).alias("_last")
        ),
        "_decayed", "_first", "_last",
    )
    first, last = date_bounds(sums, "_first", "_last")
    since = F.datediff(last, F.lit(dt.date(1970, 1, 1))) - ((F.col("_block") + 1) * length - 1)
    return (
        sums.groupBy(*keys)
        .agg(F.sum(F.col("_decayed") * F.pow(F.lit(1.0 - alpha), since)).alias("_total"))
        .select(*keys, ewm_from_decayed(F.col("_total"), first, last, alpha).alias(out))
    )


def ewm_series(
    dense: DataFrame,
    keys: list[str],
    date_column: str,
    value: str,
    start: dt.date | str,
    alpha: float = 0.5,
    out: str = "ewm",
) -> DataFrame:
    """Exponentially weighted mean on every day of a zero-filled series from ``start`` on.

    Days are weighted inside blocks, so a series of any length and any factor in (0, 1) keeps
    finite weights. A block takes over the last value of the one before it; what is older
    weighs less than e^-300.
    """
    length = _block_days(alpha)
    place = dates.days_between(dates.day_lit(start), F.col(date_column))
    inner = F.pmod(place, F.lit(length))
    growth = F.pow(F.lit(1.0 / (1.0 - alpha)), inner)
    by_key = Window.partitionBy(*keys)
    running = Window.unboundedPreceding, Window.currentRow
    in_block = by_key.partitionBy(*keys, "_block").orderBy(date_column).rowsBetween(*running)
    before = by_key.orderBy("_block").rangeBetween(-1, -1)
    taken = F.coalesce(F.max_by("_own", date_column).over(before), F.lit(0.0))
    weights = ewm_normaliser(F.count("*").over(by_key.orderBy(date_column).rowsBetween(*running)), alpha)
    return (
        dense.withColumn("_block", F.floor(place / length))
        .withColumn("_own", F.sum(F.col(value).cast("double") * growth).over(in_block) / growth)
        .withColumn("_total", F.col("_own") + taken * F.pow(F.lit(1.0 - alpha), inner + 1))
        .withColumn(out, F.col("_total") / weights)
        .drop("_block", "_own", "_total")
    )


def demand_shape(daily: DataFrame, keys: list[str], date_column: str, value: str) -> DataFrame:
    """Sample skewness and excess kurtosis of each key's zero-filled series, where all
    keys span the first to the last date of ``daily`` (one row per key and day)."""
    first, last = date_bounds(daily, date_column)
    sums = daily.groupBy(*keys).agg(*moments.power_sums(F.col(value)))
    days = (dates.days_between(first, last) + 1).alias("days")
    return (
        sums.select("*", days)
        .select(
            *keys,
            "days",
            moments.sample_skewness(F.col("days")).alias("skew"),
            moments.sample_excess_kurtosis(F.col("days")).alias("kurtosis"),
        )
    )
