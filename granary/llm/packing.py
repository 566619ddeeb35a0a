"""Mixture-controlled packing into sequences of a fixed length.

Every source is a queue of tokens. A deficit round-robin serves the queues so that each
window of tokens holds every source in its target proportion: a queue earns its share of a
window as credit, is served whole tokens, and takes the rest of its credit into the next
window. With documents cut freely the service order has a closed form: token x of a queue
with share p is served at time (x + 1/2) / p, and queues that are empty leave their share to
the others. So any partition can tell how many tokens of each queue all earlier windows have
taken, and what it owes the next, without running through them: deficits carry across
windows and partitions exactly.

A source has a queue of its own if it has a target or, on average, at least a token in each
window; so there are at most as many such queues as a window has tokens, besides the named
ones. Sources that are too small to be in every window share queues by the hash of their
name, and these hold their joint proportion.

Steps: encode once into a table that also counts the tokens before each document in its
task and source; add what earlier tasks hold; place every token by its window.
"""

from __future__ import annotations

from collections.abc import Mapping

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from granary.llm import tokens
from granary.llm import words as W
from granary.llm.shared import written

SEQUENCE = 1024
WINDOW_SEQUENCES = 64
END_ID = 0
#: Queues that sources with less than a token in a window share, by the hash of their names.
QUEUES = 1024

_ENCODED = "doc_id long, source string, part long, before long, n long, ids binary"
_PIECES = (
    "doc_id long, start long, length long, doc_tokens long, sequence_id long, offset long, window long, ids binary"
)


class Service:
    """Tokens each queue has given after a number of tokens of the whole service."""

    def __init__(self, sizes: np.ndarray, shares: np.ndarray):
        self.sizes, self.shares = sizes.astype(np.int64), shares.astype(np.float64)
        self.total = int(self.sizes.sum())

    def _given(self, time: np.ndarray) -> np.ndarray:
        """Tokens served up to each time, by queue."""
        return np.minimum(self.sizes, np.floor(time[:, None] * self.shares + 0.5).astype(np.int64))

    def rank(self, queue: np.ndarray, place: np.ndarray) -> np.ndarray:
        """Place in the service of a token of a queue, give or take one token of each queue."""
        return self._given((place + 0.5) / self.shares[queue]).sum(axis=1) - 1

    def after(self, served: np.ndarray) -> np.ndarray:
        """Tokens by queue among the first ``served`` tokens. Rows sum to ``served``."""
        low = np.zeros(len(served))
        high = np.full(len(served), float((self.sizes / self.shares).max()) + 1.0)
        for _ in range(1100):
            middle = (low + high) / 2
            if ((middle <= low) | (middle >= high)).all():
                break
            over = self._given(middle).sum(axis=1) > served
            high = np.where(over, middle, high)
            low = np.where(over, low, middle)
        given = self._given(low)
        # Tokens of equal time are served in the order of the queues.
        tied = np.minimum(self._given(high) - given, 1)
        left = (served - given.sum(axis=1))[:, None]
        return given + np.where(np.cumsum(tied, axis=1) <= left, tied, 0)


def _encoded(path: str):
    def run(batches):
        encoder = tokens.encoder(path)
        end = np.array([END_ID], dtype=encoder.kind).tobytes()
        part, before = TaskContext.get().partitionId(), {}
        for batch in W.parts(batches):
            ids, counts, begins = [], [], []
            for text, source in zip(batch.column("text").to_pylist(), batch.column("source").to_pylist(), strict=True):
                ids.append(encoder.encode(text or "") + end)
                counts.append(len(ids[-1]) // encoder.kind.itemsize)
                begins.append(before.get(source, 0))
                before[source] = begins[-1] + counts[-1]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    batch.column("source"),
                    pa.array(np.full(batch.num_rows, part)),
                    pa.array(begins, pa.int64()),
                    pa.array(counts, pa.int64()),
                    pa.array(ids, pa.binary()),
                ],
                names=["doc_id", "source", "part", "before", "n", "ids"],
            )

    return run


def _placed(service: Service, path: str, sequence: int, window: int):
    def run(batches):
        kind = tokens.encoder(path).kind
        for batch in W.parts(batches, "ids"):
            queue = batch.column("queue").to_numpy()
            begin = batch.column("start").to_numpy()
            n = batch.column("n").to_numpy()
            # Windows from a little before the first token to a little after the last.
            slack = len(service.sizes) + 1
            first = np.maximum(service.rank(queue, begin) - slack, 0) // window
            last = np.minimum(service.rank(queue, begin + n - 1) + slack, service.total - 1) // window
            windows = np.unique(np.concatenate([np.arange(a, b + 1) for a, b in zip(first.tolist(), last.tolist(), strict=True)]))
            edges = np.unique(np.concatenate((windows, windows + 1)))
            taken = service.after(np.minimum(edges * window, service.total))
            at = {int(w): i for i, w in enumerate(edges)}
            out: list[tuple] = []
            for doc, q, b, count, a, z, raw in zip(
                batch.column("doc_id").to_pylist(), queue.tolist(), begin.tolist(), n.tolist(), first.tolist(), last.tolist(),
                batch.column("ids").to_pylist(), strict=True,
            ):
                for w in range(a, z + 1):
                    low, high = taken[at[w]], taken[at[w + 1]]
                    x, stop = max(b, int(low[q])), min(b + count, int(high[q]))
                    place = w * window + int((high[:q] - low[:q]).sum()) + x - int(low[q])
                    while x < stop:
                        length = min(stop - x, sequence - place % sequence)
                        ids = np.frombuffer(raw, dtype=kind, count=length, offset=(x - b) * kind.itemsize)
                        out.append((doc, x - b, length, count, place // sequence, place % sequence, w, ids.astype("<u4").tobytes()))
                        x, place = x + length, place + length
            columns = list(zip(*out, strict=True))
            kinds = [pa.int64()] * 7 + [pa.binary()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)],
                names=["doc_id", "start", "length", "doc_tokens", "sequence_id", "offset", "window", "ids"],
            )

    return run


def pack(
    docs: DataFrame,
    vocabulary: str,
    targets: Mapping[str | None, float] | None = None,
    sequence: int = SEQUENCE,
    window_sequences: int = WINDOW_SEQUENCES,
) -> DataFrame:
    """Pieces of the documents of ``docs(doc_id, text, source, ...)`` in full sequences.

    Returns ``doc_id, start, length, doc_tokens, sequence_id, offset, window, ids``: the ids
    ``start`` to ``start + length`` of a document (little-endian 32-bit integers) stand in a
    sequence from ``offset`` on. A document is its ids by the vocabulary file, as the
    tokenizers library gives them without adding special tokens, and then id 0: the strings
    of a file's added tokens are those tokens. Every id is in exactly one piece. Sequences are
    numbered from 0 and all full, but for the last one.

    ``targets`` are token proportions by source, for as many sources as they name; a source
    without one has its share of all tokens, which is also the default for all, so that all
    queues last to the end. Null and empty texts are the id 0 alone. A null source is a
    source like others. Repeated rows and null ids are packed like others. Texts of any length
    are encoded whole and cut freely. Other columns are ignored, whatever their names. An
    empty table gives no rows.
    """
    spark = docs.sparkSession
    named = dict(targets or {})
    if any(w <= 0 for w in named.values()):
        raise ValueError("target proportions must be positive")
    rows = docs.select(F.col("doc_id").cast("long"), "source", "text")
    held = written(rows.mapInArrow(_encoded(vocabulary), _ENCODED), "encoded")

    window = sequence * window_sequences
    sums = written(held.groupBy("source", "part").agg(F.sum("n").alias("sum")), "packing-sums")
    sizes = sums.groupBy("source").agg(F.sum("sum").alias("n"))
    windows = -(-(sums.agg(F.sum("sum")).first()[0] or 0) // window)
    goals = spark.createDataFrame([(s, float(w)) for s, w in named.items()], "source string, goal double")
    is_named = sizes["source"].eqNullSafe(goals["source"])
    # At most ``window`` sources have a token for each window; named ones come on top.
    own = sizes.join(F.broadcast(goals), is_named, "left").filter((F.col("n") >= windows) | F.col("goal").isNotNull()).select(sizes["source"], "n", "goal")
    large = sorted(((r["source"], r["n"], r["goal"]) for r in own.collect()), key=lambda r: (r[0] is not None, r[0] or ""))
    places = spark.createDataFrame([(s, i) for i, (s, _, _) in enumerate(large)], "own_source string, place int")
    shared = F.pmod(F.xxhash64("source"), F.lit(QUEUES)) + len(large)
    queued = sums.join(F.broadcast(places), F.col("source").eqNullSafe(F.col("own_source")), "left").withColumn(
        "queue", F.coalesce("place", shared).cast("long")
    )
    small = {r["queue"]: r["n"] for r in queued.filter("place is null").groupBy("queue").agg(F.sum("sum").alias("n")).collect()}
    counts = np.zeros(max(small, default=len(large) - 1) + 1, dtype=np.int64)
    counts[: len(large)] = [n for _, n, _ in large]
    counts[list(small)] = list(small.values())
    weight = counts / max(1, counts.sum())
    weight[: len(large)] = [g or w for (_, _, g), w in zip(large, weight, strict=False)]
    weight[counts == 0] = 1.0  # a queue of nobody

    earlier = Window.partitionBy("queue").orderBy("part", "source").rowsBetween(Window.unboundedPreceding, -1)
    base = queued.select(
        F.col("source").alias("_source"), F.col("part").alias("_part"), "queue", F.coalesce(F.sum("sum").over(earlier), F.lit(0)).alias("base")
    )
    same = F.col("source").eqNullSafe(F.col("_source")) & (F.col("part") == F.col("_part"))
    return (
        held.join(base, same)
        .select("doc_id", "queue", (F.col("base") + F.col("before")).alias("start"), "n", "ids")
        .mapInArrow(_placed(Service(counts, weight), vocabulary, sequence, window), _PIECES)
    )


def sequences(pieces: DataFrame) -> DataFrame:
    """``sequence_id, ids``: the ids of each sequence in order, at most one sequence a row."""
    ordered = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    return pieces.groupBy("sequence_id").agg(ordered.alias("parts")).select(
        "sequence_id", F.aggregate("parts.ids", F.to_binary(F.lit(""), F.lit("utf-8")), lambda a, b: F.concat(a, b)).alias("ids")
    )
