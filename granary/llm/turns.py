"""Turns of conversations in order, numbered without gathering a conversation in one task."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from granary.llm.shared import written


def in_order(turns: DataFrame) -> DataFrame:
    """``turns(conv_id, turn, role, text, ...)`` sorted by these columns, nulls first.

    Range partitions hold consecutive rows, so a conversation with very many turns lies in
    several of them. Partitions follow one another in the order of their numbers.
    """
    spread = turns.repartitionByRange("conv_id", "turn", "role", F.substring("text", 1, 32))
    return spread.sortWithinPartitions("conv_id", "turn", "role", "text")


def _places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Number of each row among those of its conversation in this partition."""
    part, last, count = TaskContext.get().partitionId(), None, 0
    for batch in batches:
        ids = batch.column("conv_id").to_numpy(zero_copy_only=False)
        if not len(ids):
            continue
        row = np.arange(len(ids))
        starts = np.maximum.accumulate(np.where(np.concatenate(([True], ids[1:] != ids[:-1])), row, 0))
        place = row - starts + np.where((starts == 0) & (ids == last), count, 0)
        last, count = ids[-1], int(place[-1]) + 1
        yield pa.RecordBatch.from_arrays(
            [batch.column(c) for c in batch.schema.names] + [pa.array(np.full(len(ids), part, dtype=np.int32)), pa.array(place.astype(np.int64))],
            names=[*batch.schema.names, "part", "place"],
        )


def numbered(turns: DataFrame, *carry: str) -> tuple[DataFrame, DataFrame]:
    """Turns of conversations with an id, as (``conv_id``, ``pos`` from 0, ``carry`` columns),
    and the number of turns of each conversation (``conv_id``, ``n``)."""
    ordered = in_order(turns.filter("conv_id is not null")).select("conv_id", *carry)
    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in ordered.schema.fields)
    placed = written(ordered.mapInArrow(_places, f"{kinds}, part int, place long"), "turns")
    counts = placed.groupBy("conv_id", "part").agg(F.count("*").alias("n"))
    before = Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    # A partition continues at most one conversation, so there is at most one row for each.
    later = counts.withColumn("before", F.sum("n").over(before)).filter("before is not null").select("conv_id", "part", "before")
    rows = placed.join(F.broadcast(later), ["conv_id", "part"], "left").select(
        "conv_id", (F.col("place") + F.coalesce("before", F.lit(0))).alias("pos"), *carry
    )
    return rows, counts.groupBy("conv_id").agg(F.sum("n").alias("n"))
