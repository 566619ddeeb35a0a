"""Membership flags and the union of a history table with its live successor."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from granary.functions import dates


def member_flag_by(
    df: DataFrame, group: str, value: str, members: DataFrame, member: str, out: str
) -> DataFrame:
    """1 per group when any of its values is among ``members``, else 0 (null never is).

    Rows are reduced to distinct (group, value) pairs before the lookup, so a hot group
    or value reaches the join as one row per pair.
    """
    pairs = df.select(group, value).distinct()
    marker = (
        members.select(F.col(member).alias(value))
        .filter(F.col(value).isNotNull())
        .distinct()
        .withColumn("_hit", F.lit(1))
    )
    return (
        pairs.join(marker, value, "left")
        .groupBy(group)
        .agg(F.max(F.coalesce("_hit", F.lit(0))).alias(out))
    )


def active_sku_flag(
    orders: DataFrame, active_skus: DataFrame, as_of: dt.date | str
) -> DataFrame:
    """Whether an item sold under a SKU that is active exactly on ``as_of``."""
    on_day = active_skus.filter(F.col("partition_date") == dates.day_lit(as_of))
    return member_flag_by(orders, "inventory_id", "sku", on_day, "variant_sku", "active_sku_fl")


def with_flag(df: DataFrame, flags: DataFrame, key: str, flag: str) -> DataFrame:
    """Carry a per-key flag onto rows; keys without a flag get 0."""
    return df.join(flags, key, "left").select(*df.columns, F.coalesce(flag, F.lit(0)).alias(flag))


def conflicting_flags(df: DataFrame, key: str, flag: str) -> DataFrame:
    """Keys that carry more than one flag value."""
    per_key = df.groupBy(key).agg(
        F.min(flag).alias("lowest"), F.max(flag).alias("highest"), F.count("*").alias("row_count")
    )
    return per_key.filter(F.col("lowest") != F.col("highest"))


def require_no_conflicts(df: DataFrame, key: str, flag: str) -> DataFrame:
    """Fail when a key is flagged both ways, else return ``df``."""
    bad = conflicting_flags(df, key, flag).select(key).take(5)
    if bad:
        raise ValueError(f"{flag} has several values for {key} in {[r[0] for r in bad]}")
    return df


def history_union(
    history: DataFrame,
    recurring: DataFrame,
    key: str = "order_number",
    recurring_filter: Column | None = None,
) -> DataFrame:
    """History rows whose order is not in ``recurring``, plus all recurring rows."""
    kept = recurring if recurring_filter is None else recurring.filter(recurring_filter)
    # Distinct keys: the anti join needs each order once, however many lines it has.
    captured = kept.select(key).distinct()
    missed = history.join(captured, key, "left_anti").select(*history.columns)
    return missed.unionByName(kept)
