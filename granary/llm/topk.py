"""Exact top-k search by inner product, without random access (NRA; Fagin, Lotem and Naor, 2003).

Vectors become whole numbers. Each component is a list of all vectors sorted by it, which a
query reads in order: from the largest value where its own component is positive, from the
smallest where it is negative. What a vector has shown so far, plus the place that each list
has reached, bounds its score from above; with the last value of each list instead it is
bounded from below. Reading stops when few vectors can still reach the query's k-th best
lower bound, and their final scores are resolved. At one depth the lists have shown the same
values to all queries, so bounds are products of the queries with the vectors as shown, what
is unread being replaced by the place of its list.

Vectors are dealt into blocks and queries into slices of bounded size; a task reads the lists
of one block for the queries of one slice. The first block is read before the others: a
query's k-th score there is a floor, below which vectors of other blocks cannot qualify. Every
query meets every block, so results are exact.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from granary.llm.shared import written

K, SCALE = 5, 256
#: Vectors of a block, queries of a slice, queries read together.
BLOCK, SLICE, TOGETHER = 4096, 1024, 64
#: Steps in which lists are read; share of a block whose final scores may be resolved.
STEPS, RESOLVED = 16, 1 / 64

_FOUND = "found array<struct<vec_id: bigint, score: bigint, n: bigint>>"


def whole(embedding: Column, scale: int = SCALE) -> Column:
    """Components as floor(scale * x) with x as double."""
    return F.transform(embedding, lambda x: F.floor(F.lit(float(scale)) * x.cast("double")))


def usable(embedding: Column) -> Column:
    """Whether a vector is not null and all its components are finite numbers."""
    bad = lambda x: x.isNull() | F.isnan(x.cast("double")) | (F.abs(x.cast("double")) == float("inf"))
    return embedding.isNotNull() & ~F.exists(embedding, bad)


def read_lists(ids: np.ndarray, rows: np.ndarray, query_ids: np.ndarray, queries: np.ndarray, floors: np.ndarray, k: int):
    """For each query its best ``k`` rows that reach its floor: (query, row numbers, scores).

    A row with the query's own id takes no part. Ties go to smaller ids.
    """
    n, width = rows.shape
    most = width * max(1, int(np.abs(rows).max(initial=0))) * max(1, int(np.abs(queries).max(initial=0)))
    if most >= 2**62:
        raise ValueError("components are too large for scores of 64 bits")
    # Floats hold these whole numbers and all their sums exactly, and multiply faster.
    kind = np.float32 if most < 2**24 else np.float64 if most < 2**53 else np.int64
    nothing = kind(-(2**62))
    place = np.argsort(rows, axis=0, kind="stable")
    value = np.take_along_axis(rows, place, axis=0).astype(kind)
    rank = np.empty(place.shape, dtype=np.int32)
    np.put_along_axis(rank, place, np.arange(n, dtype=np.int32)[:, None], axis=0)
    shown = rows.astype(kind)
    # Positive components read a list from its end, negative ones from its start.
    signed = np.concatenate([np.maximum(queries, 0), np.minimum(queries, 0)], axis=1).astype(kind)
    bars = np.maximum(floors, int(nothing)).astype(kind)
    step = max(32, math.ceil(n / STEPS))
    reading = np.arange(len(queries))
    for end in [*range(step, n, step), n] if n else []:
        if not len(reading):
            break
        ready = reading
        if end < n:
            top, bottom = value[n - end - 1], value[end]
            # Elsewhere rows that no list has shown could still qualify.
            ready = reading[signed[reading] @ np.concatenate([top, bottom]) < bars[reading]]
            if not len(ready):
                continue
            high_rows = np.concatenate([np.maximum(shown, top), np.minimum(shown, bottom)], axis=1)
            low_rows = np.concatenate([np.where(rank >= n - end, shown, value[0]), np.where(rank < end, shown, value[-1])], axis=1)
        else:
            high_rows = low_rows = np.concatenate([shown, shown], axis=1)
        finished = []
        for begin in range(0, len(ready), TOGETHER):
            some = ready[begin : begin + TOGETHER]
            own = query_ids[some, None] == ids[None, :]
            high = signed[some] @ high_rows.T
            high[own] = nothing
            few = max(4 * k, n * RESOLVED)
            open_ = np.flatnonzero((high >= bars[some, None]).sum(axis=1) > few)
            if n > k and len(open_):
                low = high[open_] if end == n else signed[some[open_]] @ low_rows.T
                low[own[open_]] = nothing
                best = np.partition(low, n - k, axis=1)[:, n - k]
                bars[some[open_]] = np.maximum(bars[some[open_]], best)
            alive = (high >= bars[some, None]) & ~own
            done = np.flatnonzero((alive.sum(axis=1) <= few) | (end == n))
            for j in done:
                q, at_rows = some[j], np.flatnonzero(alive[j])
                scores = rows[at_rows] @ queries[q]
                first = np.lexsort((ids[at_rows], -scores))[:k]
                first = first[scores[first] >= floors[q]]
                yield int(q), at_rows[first], scores[first]
            finished.append(some[done])
        reading = np.setdiff1d(reading, np.concatenate(finished), assume_unique=True)


def _matrix(table: pa.Table, name: str, width: int) -> np.ndarray:
    flat = pc.list_flatten(table.column(name)).to_numpy()
    return flat.astype(np.int64).reshape(table.num_rows, width)


def _meet(k: int):
    """Function of a block's vectors and a slice's queries that gives each query's best."""

    def meet(rows: pa.Table, queries: pa.Table) -> pa.Table:
        found = [[] for _ in range(queries.num_rows)]
        if rows.num_rows and queries.num_rows:
            width = rows.column("width")[0].as_py()
            ids, counts = rows.column("vec_id").to_numpy(), rows.column("n").to_numpy()
            floors = np.array([-(2**62) if f is None else f for f in queries.column("floor").to_pylist()], dtype=np.int64)
            sought = read_lists(
                ids, _matrix(rows, "vec", width), queries.column("query_id").to_numpy(), _matrix(queries, "query", width), floors, k
            )
            for q, at, scores in sought:
                found[q] = [{"vec_id": int(ids[i]), "score": int(s), "n": int(counts[i])} for i, s in zip(at, scores, strict=True)]
        kind = pa.list_(pa.struct([("vec_id", pa.int64()), ("score", pa.int64()), ("n", pa.int64())]))
        kept = queries.select(["query_id", "query", "times", "width", "slice"])
        return kept.append_column("found", pa.array(found, kind))

    return meet


def top_k(vectors: DataFrame, is_query: Column, k: int = K, scale: int = SCALE, block: int = BLOCK) -> DataFrame:
    """The ``k`` best-scoring vectors of each query among ``vectors(vec_id, embedding, ...)``.

    ``is_query`` tells queries by ``vec_id``; candidates are all vectors but those with the
    query's own id. Returns ``query_id, rank, vec_id, score``: ranks from 1, all candidates
    if fewer than ``k``, ties to the smaller vec_id. The score is the inner product of the
    vectors' floor(``scale`` * x). Vectors without an id, null, or with null or non-finite
    components take no part; vectors of different lengths do not meet; empty vectors score
    0. Repeated rows count as often as they occur, as queries of one id and as candidates:
    then the best of all its pairs are a query's. Scores beyond 62 bits stop the job. Other
    columns are ignored, whatever their names. An empty table gives no rows.
    """
    rows = written(
        vectors.select("vec_id", "embedding")
        .filter(F.col("vec_id").isNotNull() & usable(F.col("embedding")))
        .select("vec_id", whole(F.col("embedding"), scale).alias("vec"))
        .groupBy("vec_id", "vec")
        .agg(F.count("*").alias("n"))
        .withColumn("width", F.size("vec")),
        "topk-vectors",
    )
    asked = rows.filter(is_query).select(F.col("vec_id").alias("query_id"), F.col("vec").alias("query"), F.col("n").alias("times"), "width")
    blocks = max(1, math.ceil(rows.count() / block))
    slices = max(1, math.ceil(asked.count() / SLICE))
    dealt = rows.withColumn("block", F.pmod(F.xxhash64("vec_id", "vec"), F.lit(blocks)).cast("int"))
    asked = asked.withColumn("slice", F.pmod(F.xxhash64("query_id", "query", F.lit(1)), F.lit(slices)).cast("int"))
    numbers = lambda a, b: F.explode(F.sequence(F.lit(a), F.lit(b)))
    kept = "query_id long, query array<long>, times long, width int, slice int, " + _FOUND

    def best(candidates: DataFrame, queries: DataFrame) -> DataFrame:
        spread = candidates.withColumn("slice", numbers(0, slices - 1))
        keys = ["width", "block", "slice"]
        return spread.groupBy(*keys).cogroup(queries.groupBy(*keys)).applyInArrow(_meet(k), kept)

    first = written(
        best(dealt.filter("block = 0"), asked.withColumns({"block": F.lit(0), "floor": F.lit(None).cast("long")})), "topk-first"
    )
    found = first
    if blocks > 1:
        floor = F.when(F.size("found") >= k, F.element_at("found", -1)["score"])
        others = first.select("query_id", "query", "times", "width", "slice", floor.alias("floor"), numbers(1, blocks - 1).alias("block"))
        found = first.unionByName(best(dealt.filter("block > 0"), others))
    pairs = found.select("query_id", "times", F.explode("found").alias("f")).select("query_id", "times", "f.*")
    copies = F.explode(F.sequence(F.lit(1), F.least(F.col("times") * F.col("n"), F.lit(k)).cast("int")))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), F.asc("vec_id"))
    return (
        pairs.select("query_id", "vec_id", "score", copies.alias("copy"))
        .withColumn("rank", F.row_number().over(order))
        .filter(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )
