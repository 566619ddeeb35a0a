"""Uniform shuffle into shards of exact sizes, by a hypergeometric communication matrix.

Every input partition holds ``n_i`` rows and every shard is to hold ``m_j`` (counts at most
one apart). How many rows partition i sends to shard j is a draw without replacement, so the
matrix of these numbers has multivariate hypergeometric rows; it depends on the partition
sizes alone, and every task draws the row it needs. Each partition then deals its rows out in random order with exactly
those counts, one exchange moves them, and a random order inside the shard permutes again.
Together that is a uniform permutation of all rows, and every shard is exactly full.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

SHARDS = 40
#: Rows of a shard that are put in order together; a shard of any size is many such blocks.
BLOCK_ROWS = 2000
_NUMPY_LIMIT = 10**9


def hypergeometric(rng: np.random.Generator, good: int, bad: int, take: int) -> int:
    """How many of ``take`` draws without replacement from good + bad are good."""
    if good + bad < _NUMPY_LIMIT:
        return int(rng.hypergeometric(good, bad, take)) if take else 0
    low, high = max(0, take - bad), min(good, take)
    total = good + bad
    mean = take * (good / total)
    spread = math.sqrt(max(1.0, mean * (bad / total) * ((total - take) / max(1, total - 1))))
    first, last = max(low, int(mean - 14 * spread) - 14), min(high, int(mean + 14 * spread) + 14)
    k = np.arange(first, last, dtype=np.float64)
    steps = np.log(good - k) + np.log(take - k) - np.log(k + 1) - np.log(bad - take + k + 1)
    weight = np.concatenate(([0.0], np.cumsum(steps)))
    mass = np.cumsum(np.exp(weight - weight.max()))
    return first + int(np.searchsorted(mass, rng.random() * mass[-1], side="right"))


def shard_sizes(rows: int, shards: int) -> list[int]:
    return [rows // shards + (j < rows % shards) for j in range(shards)]


def matrix_row(seed: int, prefix: np.ndarray, shards: int, part: int) -> list[int]:
    """Rows that partition ``part`` sends to each shard; ``prefix[i]`` rows stand before
    partition i.

    The matrix is drawn by halving the partitions: how many of each shard's rows come from
    the first half is a draw without replacement, seeded by the half itself. Every task walks
    down to its own row and sees the draws that the others see, so nobody holds the matrix.
    """
    low, high = 0, len(prefix) - 1
    held = shard_sizes(int(prefix[-1]), shards)
    while high - low > 1:
        middle = (low + high) // 2
        rng = np.random.default_rng([seed, low, high])
        left, rest, first = int(prefix[middle] - prefix[low]), sum(held), []
        for n in held:
            rest -= n
            got = hypergeometric(rng, n, rest, left)
            first.append(got)
            left -= got
        if part < middle:
            held, high = first, middle
        else:
            held, low = [n - f for n, f in zip(held, first, strict=True)], middle
    return held


def _dealer(prefix, shards: int, blocks: int, seed: int):
    """Adds the shard and a random place to each row of a partition. ``prefix`` is a
    broadcast of one number for each partition."""

    def deal(batches):
        part = TaskContext.get().partitionId()
        counts = matrix_row(seed, prefix.value, shards, part) if part < len(prefix.value) - 1 else []
        rng = np.random.default_rng([seed, 1, part])
        labels = np.repeat(np.arange(len(counts), dtype=np.int32), np.array(counts, dtype=np.int64))
        rng.shuffle(labels)
        begin = 0
        for batch in batches:
            end = begin + batch.num_rows
            if end > len(labels):
                raise RuntimeError(f"partition {part} has more rows than were counted: write the input as a table first")
            place = rng.integers(0, 2**62, size=batch.num_rows, dtype=np.int64)
            columns = [*batch.columns, pa.array(labels[begin:end]), pa.array(place), pa.array((place % blocks).astype(np.int32))]
            yield pa.RecordBatch.from_arrays(columns, names=[*batch.schema.names, "shard", "_place", "_block"])
            begin = end
        if begin != len(labels):
            raise RuntimeError(f"partition {part} has fewer rows than were counted: write the input as a table first")

    return deal


def shuffled_shards(docs: DataFrame, shards: int = SHARDS, seed: int = 0, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """``docs`` with ``shard`` (0 to shards-1) and ``slot`` (gapless from 0 in the shard).

    ``docs`` should be a scan (or a written table), whose partitions are the same each time
    it is read; a task that meets another number of rows than counted stops the job. Values,
    nulls, repeated rows and equal texts make no difference: each row is dealt by its place
    alone. Input columns named shard or slot are replaced. An empty table gives no rows, and
    with fewer rows than shards some shards stay empty.
    """
    docs = docs.drop("shard", "slot", "_place", "_block")
    sizes = {r[0]: r[1] for r in docs.groupBy(F.spark_partition_id().alias("part")).count().collect()}
    rows = np.zeros(max(sizes, default=-1) + 1, dtype=np.int64)
    rows[list(sizes)] = list(sizes.values())
    prefix = np.concatenate(([0], np.cumsum(rows)))
    blocks = max(1, math.ceil(int(prefix[-1]) / shards / block_rows))
    deal = _dealer(docs.sparkSession.sparkContext.broadcast(prefix), shards, blocks, seed)

    def dealt(df: DataFrame) -> DataFrame:
        extra = [T.StructField("shard", T.IntegerType()), T.StructField("_place", T.LongType()), T.StructField("_block", T.IntegerType())]
        return df.mapInArrow(deal, T.StructType([*df.schema.fields, *extra]))

    # The same rows are dealt the same way whatever columns they carry, so the block sizes
    # need one narrow column only.
    narrow = docs.select(docs.columns[0])
    sums = dealt(narrow).groupBy("shard", "_block").agg(F.count("*").alias("n"))
    before = Window.partitionBy("shard").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    base = sums.select("shard", "_block", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("_base"))
    inside = Window.partitionBy("shard", "_block").orderBy("_place")
    return (
        dealt(docs)
        .join(base, ["shard", "_block"])
        .withColumn("slot", F.col("_base") + F.row_number().over(inside) - 1)
        .select(*[F.col(f"`{c}`") for c in docs.columns], "shard", F.col("slot").cast("long"))
    )


def write_shards(docs: DataFrame, path: str, **options) -> None:
    """The shuffled rows as files in one folder per shard, in slot order."""
    rows = shuffled_shards(docs, **options)
    rows.repartition("shard").sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)
