"""Top-k search against brute force over Python numbers."""

import math
import random
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from granary.llm import topk

NAN, INF = float("nan"), float("inf")
SCHEMA = "vec_id long, embedding array<double>, label int, query string, block string, n string, rank string"


def brute(rows, k, every):
    whole = [
        (v, [math.floor(256 * x) for x in e]) for v, e in rows
        if v is not None and e is not None and all(x is not None and math.isfinite(x) for x in e)
    ]
    out = []
    for query in sorted({v for v, _ in whole if v % every == 0}):
        pairs = [
            (-sum(a * b for a, b in zip(q, c, strict=True)), v)
            for u, q in whole if u == query for v, c in whole if v != query and len(c) == len(q)
        ]
        out += [(query, i + 1, v, -s) for i, (s, v) in enumerate(sorted(pairs)[:k])]
    return out


def found(spark, rows, k=5, every=5, **options):
    df = spark.createDataFrame([(v, e, 1, "x", "x", "x", "x") for v, e in rows], SCHEMA).repartition(3)
    out = topk.top_k(df, F.col("vec_id") % every == 0, k, **options)
    return sorted(tuple(r) for r in out.collect())


def cloud(seed, n, width=6, kinds=None):
    rng = random.Random(seed)
    pool = [[rng.gauss(0, 0.2) for _ in range(width)] for _ in range(kinds or n)]
    return [(i - 20, list(pool[i] if kinds is None else rng.choice(pool))) for i in range(n)]


def test_awkward_vectors(spark):
    rows = [
        (0, [1.0, 0.0]), (5, [0.5, 0.5]), (5, [0.5, 0.5]), (10, None), (15, []), (16, []), (20, [NAN, 1.0]), (21, [INF, 1.0]),
        (22, [None, 1.0]), (None, [9.0, 9.0]), (23, [1.0, 0.0]), (24, [1.0, 0.0]), (24, [1.0, 0.0]), (24, [-1.0, 0.1]), (25, [1.0, 2.0, 3.0]),
        (-5, [0.0, 0.0]), (26, [1e-9, -1e-9]), (30, [-0.001, 0.001]), (30, [2.0, -2.0]),
    ]
    assert found(spark, rows) == brute(rows, 5, 5)
    assert found(spark, rows, k=1) == brute(rows, 1, 5)
    assert found(spark, []) == []
    assert found(spark, [(3, [1.0])]) == []
    assert found(spark, [(5, [1.0])]) == []


@pytest.mark.parametrize(("rows", "block"), [
    (cloud(1, 400), 64),
    # A third of the rows is one vector, and only a few kinds exist: ties everywhere.
    (cloud(2, 300, kinds=7) + [(1000 + i, [0.3] * 6) for i in range(150)], 50),
    # One id holds a third of the rows.
    (cloud(3, 200) + [(0, v) for _, v in cloud(4, 100)] + [(7, v) for _, v in cloud(5, 100)], 70),
])
def test_blocks_give_the_same_as_all_pairs(spark, rows, block):
    assert found(spark, rows, block=block) == brute(rows, 5, 5)


def test_numbers_beyond_doubles(spark):
    rows = [(i, [float(2**19 + i % 3), -float(2**19), float(i)]) for i in range(40)]
    assert found(spark, rows, scale=256, block=16) == brute(rows, 5, 5)
    with pytest.raises(Exception, match="64 bits"):
        found(spark, [(0, [1e12]), (1, [1e12])])


def test_reading_stops_early_and_is_exact():
    rng = np.random.default_rng(1)
    rows = np.floor(256 * rng.standard_normal((3000, 8)) * 0.2).astype(np.int64)
    rows[7] = rows[11] * 2
    ids = rng.permutation(3000).astype(np.int64)
    queries = rows[:20]
    floors = np.sort(queries @ rows.T, axis=1)[:, -6]
    got = {q: list(zip(s.tolist(), ids[at].tolist(), strict=True)) for q, at, s in topk.read_lists(ids, rows, ids[:20], queries, floors, 5)}
    for q in range(20):
        scores = sorted((-int(rows[i] @ queries[q]), int(ids[i])) for i in range(3000) if i != q)[:5]
        assert got[q] == [(-s, i) for s, i in scores if -s >= floors[q]]


@pytest.mark.parametrize("most", [200, 2**20, 2**27])
def test_reading_costs_little_more_than_the_products(most):
    """Lists of wide vectors are read nearly to their end, in any kind of numbers, without
    work of their own for each query and list."""
    rng = np.random.default_rng(2)
    rows = np.floor(rng.standard_normal((2048, 64)).clip(-4, 4) / 4 * most).astype(np.int64)
    rows[5] = rows[9]  # a tie
    ids, asked = rng.permutation(2048).astype(np.int64), np.arange(0, 2048, 8)
    begun = time.thread_time()
    scores = rows[asked] @ rows.T
    products = time.thread_time() - begun
    scores[ids[asked][:, None] == ids[None, :]] = -(2**62)
    best = [sorted(zip((-scores[q]).tolist(), ids.tolist(), strict=True))[:5] for q in range(len(asked))]
    for floors in (np.full(len(asked), -(2**62)), np.sort(scores, axis=1)[:, -7]):
        begun = time.thread_time()
        found = list(topk.read_lists(ids, rows, ids[asked], rows[asked], floors, 5))
        spent = time.thread_time() - begun
        assert {q: list(zip((-s).tolist(), ids[at].tolist(), strict=True)) for q, at, s in found} == dict(enumerate(best))
        assert most > 200 or spent < 10 * products + 0.1, (spent, products)
