"""Prefix tries against brute force over Python tuples."""

import hashlib
import random
import zlib

import pyarrow as pa
import pytest

from granary.llm import trie

SCHEMA = "conv_id long, turn int, role string, text string, pos string, name string, page string, depth string"


def sequences(rows):
    out = {}
    for conv, turn, role, text in rows:
        if conv is not None:
            out.setdefault(conv, []).append((turn is not None, turn or 0, role or "", text or ""))
    return {c: [t[2:] for t in sorted(ts)] for c, ts in out.items()}


def rest(a, n):  # the sign of a, as in SQL
    return a % n if a >= 0 else -(-a % n)


def forked(seqs, family=5, most=9):
    out = {}
    for c, own in seqs.items():
        h = zlib.crc32(str(c).encode()) % most
        out[c] = seqs.get(c - rest(c, family), [])[:h] + own[h:]
    return out


def brute(seqs):
    members = {}
    for c, s in seqs.items():
        for d in range(len(s) + 1):
            members.setdefault(tuple(s[:d]), []).append(c)
    out = []
    for node, ids in members.items():
        below = [n for n in members if n[: len(node)] == node]
        kids = [n for n in below if len(n) == len(node) + 1]
        leaves = sum(not any(len(m) == len(n) + 1 and m[: len(n)] == n for m in below) for n in below)
        saved = sum((len(members[n]) - 1) * len(n[-1][1].encode()) for n in below if n)
        ends = ",".join(map(str, sorted(c for c in ids if len(seqs[c]) == len(node))))
        above = min(members[node[:-1]]) if node else None
        out.append((min(ids), len(node), above, len(ids), len(kids), leaves, saved, hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=lambda r: r[:2])


def frame(spark, rows):
    return spark.createDataFrame([(*r, "x", "x", "x", "x") for r in rows], SCHEMA).repartition(3)


def got(df):
    return sorted((tuple(r) for r in df.collect()), key=lambda r: r[:2])


def branching(seed, n, longest, kinds=2):
    rng = random.Random(seed)
    return [
        (c, t, rng.choice(["user", "assistant"]) if rng.random() < 0.05 else "user", f"text {rng.randrange(kinds)}")
        for c in rng.sample(range(-10, 5 * n), n) for t in range(rng.randrange(1, longest))
    ]


AWKWARD = [
    (1, None, "user", "a"), (1, 0, "user", "a"), (1, 0, "assistant", "a"), (1, 0, "assistant", "b"), (2, 0, None, None), (2, 1, "", ""),
    (3, 5, "user", ""), (3, 9, "user", "ünï 🎉"), (None, 0, "user", "x"), (None, None, None, None), (-7, 0, "user", "a"), (-7, 0, "user", "a"),
    (-5, 0, "user", "a"), (-5, 3, "user", "a"), (4, 0, "user", "long " * 3000), (0, 0, "user", "zero"), (0, 1, "assistant", "one"), (10, None, None, "a"),
    (11, 1, "us", "era"), (12, 1, "user", "a"), (13, 1, "use", "ra"),
]


def test_awkward_rows(spark):
    assert got(trie.conversation_trie(frame(spark, AWKWARD))) == brute(sequences(AWKWARD))
    assert got(trie.forked_trie(frame(spark, AWKWARD))) == brute(forked(sequences(AWKWARD)))
    assert got(trie.forked_trie(frame(spark, []))) == []
    assert got(trie.forked_trie(frame(spark, [(None, 1, "user", "a")]))) == []


@pytest.mark.parametrize("rows", [
    branching(1, 120, 9),
    # Equal conversations, a third of them all, and one conversation with most of the turns.
    [(c, t, "user", f"same {t}") for c in range(60) for t in range(4)] + branching(2, 40, 5) + [(1000, t, "user", f"t{t % 3}") for t in range(90)],
])
def test_forks_equal_brute_force(spark, rows):
    assert got(trie.forked_trie(frame(spark, rows))) == brute(forked(sequences(rows)))


def test_cuts_between_pages(spark, monkeypatch):
    """Conversations of several pages that part at, before and behind the ends of pages."""
    monkeypatch.setattr(trie, "PAGE", 4)
    rows = []
    for c, (length, part) in enumerate([(30, 99), (30, 4), (16, 99), (17, 16), (8, 99), (4, 99), (3, 99), (33, 31), (20, 19), (20, 20), (12, 8), (30, 99)]):
        rows += [(c, t, "user", f"{t % 2}" if t < part else f"{c} other {t}") for t in range(length)]
    assert got(trie.conversation_trie(frame(spark, rows))) == brute(sequences(rows))


def test_names_tell_nodes_apart():
    """Every prefix has a name of its own, whatever else the sequence holds."""
    rng, names = random.Random(3), {}
    for _ in range(300):
        turns = [rng.choice([b"a" * 16, b"b" * 16]) for _ in range(rng.randrange(1, 17))]
        end = trie._name(trie.ROOT, trie._name(*turns)) if len(turns) == 16 else None
        for d, name in enumerate(trie.cut(trie.ROOT, turns, 16, end)):
            assert names.setdefault(name, tuple(turns[: d + 1])) == tuple(turns[: d + 1])
    assert len(set(names.values())) == len(names)


def test_the_page_size_travels_with_the_work():
    """Workers may import the module for themselves: they cut pages of the size they are given."""
    turns = [bytes([i]) * 16 for i in range(4)]
    whole, part = trie._name(trie.ROOT, trie._name(*turns)), trie._name(*turns)
    pages = pa.RecordBatch.from_pylist(
        [{"conv_id": 1, "page": 0, "top": trie.ROOT, "end": None, "sizes": [1] * n, "turns": turns[:n]} for n in (4, 3)]
    )
    assert next(trie._page_prints(iter([pages]), size=4)).column("print").to_pylist() == [part, None]
    assert next(trie._page_names(iter([pages]), size=4)).column("names").to_pylist() == [
        trie.cut(trie.ROOT, turns, 4, whole), trie.cut(trie.ROOT, turns[:3], 4, None)
    ]
