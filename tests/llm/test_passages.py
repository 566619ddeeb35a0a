import collections
import hashlib
import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from granary.llm import passages, words
from tests.llm.conftest import by_key, prose, split_words


def brute(cases, window=13):
    first = {}
    for i, t in cases:
        w = split_words(t)
        for p in range(len(w) - window + 1):
            if i is not None:
                g = tuple(w[p : p + window])
                first[g] = min(first.get(g, i), i)
    out = []
    for i, t in cases:
        w = split_words(t)
        gone = set()
        for p in range(len(w) - window + 1):
            if i is not None and first[tuple(w[p : p + window])] < i:
                gone.update(range(p, p + window))
        out.append((i, " ".join(x for k, x in enumerate(w) if k not in gone), len(w), len(gone)))
    return out


def columns(df):
    return [(r.doc_id, r.kept_text, r.n_words, r.n_removed) for r in df.collect()]


@pytest.mark.parametrize("window", [13, 5])
def test_equals_brute_force(docs, cases, window):
    got = passages.remove_repeated(docs, window)
    assert by_key(columns(got)) == by_key(brute(cases, window))


def test_small_buckets_and_automata(docs, cases, monkeypatch):
    monkeypatch.setattr(passages, "BUCKET_BYTES", 2000)
    monkeypatch.setattr(passages, "SHARD_BYTES", 5000)
    monkeypatch.setattr(passages, "PATTERNS", 3)
    assert by_key(columns(passages.remove_repeated(docs))) == by_key(brute(cases))


def test_overlapping_passages_of_many_documents(spark):
    rng = np.random.default_rng(3)
    pool = [prose(100 + k, 40) for k in range(12)]
    texts = [" ".join(pool[k] if rng.random() < 0.7 else prose(1000 + 20 * i + k, 15) for k in rng.integers(0, 12, 5)) for i in range(120)]
    cases = list(enumerate(texts))
    df = spark.createDataFrame(cases, "doc_id long, text string").repartition(8)
    assert by_key(columns(passages.remove_repeated(df))) == by_key(brute(cases))


def test_removed_ranges_cover_what_is_gone(docs):
    for r in passages.remove_repeated(docs).collect():
        assert sum(s.stop - s.start for s in r.removed) == r.n_removed
        assert all(a.stop < b.start for a, b in zip(r.removed, r.removed[1:], strict=False))


def test_texts_that_lose_nothing_stay_as_they_are(docs):
    out = passages.remove_repeated(docs, carry=("source", "kept"), as_is=True)
    held = collections.Counter((r.doc_id, r.text or "", r.source, r.kept) for r in docs.collect())
    rows = [(r.doc_id, r.kept_text, r.source, r.kept) for r in out.filter("n_removed = 0").collect()]
    assert rows and not collections.Counter(rows) - held


def test_an_empty_table(docs):
    assert passages.remove_repeated(docs.limit(0)).count() == 0


def test_bucket_of_an_id_is_that_of_spark(spark):
    ids = [0, 1, -1, 12345678901, -(2**62), 2**63 - 1]
    df = spark.createDataFrame([(i,) for i in ids], "i long")
    got = [r[0] for r in df.select(F.xxhash64("i")).collect()]
    assert words.spark_hash(np.array(ids, dtype=np.int64)).tolist() == got


def test_words_are_cut_at_ascii_blanks_only(cases, monkeypatch):
    texts = [None if t is None else t.encode() for _, t in cases]
    whole = words.hashed(texts)
    assert whole.counts.tolist() == [len(split_words(t)) for _, t in cases]
    names = collections.defaultdict(set)
    for h, w in zip(whole.hashes.tolist(), (w for _, t in cases for w in split_words(t)), strict=True):
        names[h].add(w)
    assert all(len(w) == 1 for w in names.values())
    monkeypatch.setattr(words, "CHUNK_BYTES", 100)
    small = words.hashed(texts)
    assert (small.hashes == whole.hashes).all() and (small.bounds == whole.bounds).all()


def test_kept_digest(spark, sf_dir):
    from granary.llm import queries

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    expected = {i: (n, k, hashlib.sha256(t.encode()).hexdigest()) for i, t, n, k in brute([(r.doc_id, r.text) for r in docs.collect()])}
    got = {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in queries.op2_passages(spark, sf_dir).collect()}
    assert got == expected


def test_equal_hashes_of_different_words(spark, monkeypatch):
    """All hashes are forced to collide; only words tell windows apart."""
    def coarse(grams):
        return lambda self, k: grams(self, k) % np.uint64(3)

    rng = random.Random(4)
    pool = [" ".join(f"w{rng.randrange(8)}" for _ in range(14)) for _ in range(9)]
    texts = [" ".join(rng.choice(pool) for _ in range(3)) for _ in range(40)]
    cases = list(enumerate(texts))
    # Workers get the changed method with the functions that are sent to them.
    monkeypatch.setattr(words.Words, "grams", coarse(words.Words.grams))
    found = words.hashed([t.encode() for t in texts])
    assert len(set(found.grams(13).tolist())) <= 3

    hits = pa.table({"phrase": [found.grams(6).tobytes()]})
    docs = pa.table({"doc_id": [i for i, _ in cases], "text": [t for _, t in cases]})
    spans = pa.Table.from_batches(list(passages._span_blocks(1, 13, np.zeros(0, np.uint64))([pa.scalar(0)], docs, hits)))
    answers = passages._firsts(13)(spans)
    out = [r for b in passages._removals(13, [], False)(None, docs, answers) for r in b.to_pylist()]
    assert [(r["doc_id"], r["kept_text"], r["n_words"], r["n_removed"]) for r in out] == brute(cases)


def frequent(n, rng):
    """A phrase in every third document, with words of its own around it, and one passage."""
    phrase, passage = "one very common phrase of words", prose(7, 30)
    texts = []
    for k in range(n):
        around = [prose(5000 + k, 20), prose(9000 + k, 20)]
        texts.append(f"{around[0]} {phrase} {around[1]}" if k % 3 == 0 else f"{around[0]} {passage}" if k % 3 == 1 else " ".join(around))
        if k % 12 == 0:
            texts.append(texts[-1])
    return [(int(i), t) for i, t in zip(rng.permutation(len(texts)), texts, strict=True)]


@pytest.mark.parametrize("least", [3, 512])
def test_hot_phrases(spark, monkeypatch, least):
    monkeypatch.setattr(passages, "HOT_LEAST", least)
    monkeypatch.setattr(passages, "SHARD_BYTES", 4000)
    cases = frequent(150, np.random.default_rng(2))
    df = spark.createDataFrame(cases, "doc_id long, text string").repartition(5)
    assert by_key(columns(passages.remove_repeated(df))) == by_key(brute(cases))


def test_windows_of_a_hot_phrase_are_spread():
    """The words around a hot phrase go to many shards, about as many to each."""
    cases = frequent(600, np.random.default_rng(3))
    data = [t.encode() for _, t in cases]
    picked = passages._picked(words.hashed(data), 13)[2]
    phrase, times = np.unique(picked, return_counts=True)
    docs = pa.table({"doc_id": [i for i, _ in cases], "text": [t for _, t in cases]})

    def rows(hot):
        run = passages._span_blocks(40, 13, hot)
        hits = pa.table({"phrase": [phrase.tobytes()]})
        return {b.column("shard")[0].as_py(): len(b.column("size")[0].as_py()) for b in run([pa.scalar(0)], docs, hits)}

    hot = rows(phrase[times > 100])
    assert len(hot) == 40 and max(hot.values()) < 2 * np.median(list(hot.values()))


def test_rows_without_an_id_are_spread(spark):
    cases = [(None, prose(1, 50))] * 30 + [(k, prose(1, 50)) for k in range(3)]
    df = spark.createDataFrame([(i, t, "s") for i, t in cases], "doc_id long, text string, source string").repartition(6)
    out = passages.remove_repeated(df, carry=("source",))
    assert by_key(columns(out)) == by_key(brute(cases)) and {r.source for r in out.collect()} == {"s"}


def test_second_hashes_follow_the_words(cases):
    texts = [None if t is None else t.encode() for _, t in cases]
    one, two = words.hashed(texts), words.hashed(texts, second=True)
    assert (one.bounds == two.bounds).all()
    assert len(set(zip(one.hashes.tolist(), two.hashes.tolist(), strict=True))) == len(set(one.hashes.tolist())) == len(set(two.hashes.tolist()))
    assert not set(one.hashes.tolist()) & set(two.hashes.tolist())
