"""Maintenance of a keyed dimension: insert, update, upsert, listing.

Stored dimensions lie in buckets by a hash of the key, so that a change rewrites one bucket.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from granary.schemas import PRODUCT_METADATA

#: Buckets of a stored dimension. Its rows lie where this number has put them, so it stays.
BUCKETS = 64
KEY = "inventory_id"
ATTRIBUTES = [
    c for c in PRODUCT_METADATA.columns if c not in (KEY, "created_at", "updated_at")
]


def bucket(key: str = KEY) -> Column:
    """Bucket of a row of a stored dimension."""
    return F.pmod(F.xxhash64(key), F.lit(BUCKETS)).alias("bucket")


def single_and_repeated(changes: DataFrame, key: str = KEY) -> tuple[DataFrame, DataFrame]:
    """Changes whose key occurs once, and the rows of keys that occur several times."""
    per_key = changes.groupBy(key).agg(
        F.count("*").alias("_n"), *[F.first(c).alias(c) for c in changes.columns if c != key]
    )
    single = per_key.filter("_n = 1").select(*changes.columns)
    repeated_keys = changes.groupBy(key).agg(F.count("*").alias("_n")).filter("_n > 1").select(key)
    repeated = changes.join(repeated_keys, key, "left_semi").select(*changes.columns)
    return single, repeated


def upsert(current: DataFrame, changes: DataFrame, at: dt.datetime) -> tuple[DataFrame, DataFrame]:
    """(merged dimension, rejected changes).

    A known key takes all attributes of its change, nulls included, and a new
    ``updated_at``; an unknown key is added. Keys repeated among the changes are
    rejected. ``current`` has one row per key.
    """
    single, repeated = single_and_repeated(changes.select(KEY, *ATTRIBUTES))
    stamp = F.lit(at).cast("timestamp_ntz")
    old, new = current.alias("old"), single.withColumn("_changed", F.lit(True)).alias("new")
    changed = F.col("new._changed").isNotNull()
    merged = old.join(new, F.col(f"old.{KEY}") == F.col(f"new.{KEY}"), "full_outer").select(
        F.coalesce(f"old.{KEY}", f"new.{KEY}").alias(KEY),
        *[
            F.when(changed, F.col(f"new.{c}")).otherwise(F.col(f"old.{c}")).alias(c)
            for c in ATTRIBUTES
        ],
        F.when(F.col(f"old.{KEY}").isNull(), stamp)
        .otherwise(F.col("old.created_at"))
        .alias("created_at"),
        F.when(changed, stamp).otherwise(F.col("old.updated_at")).alias("updated_at"),
    )
    return merged, repeated


def insert(current: DataFrame, rows: DataFrame, at: dt.datetime) -> tuple[DataFrame, DataFrame]:
    """(dimension with the new rows, rejected rows). Keys that exist already or are
    repeated among the new rows are rejected."""
    single, repeated = single_and_repeated(rows.select(KEY, *ATTRIBUTES))
    stamp = F.lit(at).cast("timestamp_ntz")
    fresh = single.join(current.select(KEY), KEY, "left_anti")
    known = single.join(current.select(KEY), KEY, "left_semi")
    added = fresh.withColumns({"created_at": stamp, "updated_at": stamp})
    return current.unionByName(added), repeated.unionByName(known)


def listing(current: DataFrame) -> DataFrame:
    """Newest first; the key breaks ties."""
    return current.orderBy(F.desc("created_at"), F.asc(KEY))
