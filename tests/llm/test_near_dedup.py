import collections

import numpy as np
import pytest

from granary.llm import near_dedup
from granary.llm.shared import components
from tests.llm.conftest import by_key, prose, split_words


def shingles(text, size=5):
    w = [x.translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")) for x in split_words(text)]
    if not w:
        return frozenset()
    return frozenset(tuple(w[k : k + size]) for k in range(max(1, len(w) - size + 1)))


def brute(cases):
    sets = [shingles(t) for _, t in cases]
    root = list(range(len(cases)))

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(cases)):
        for j in range(i):
            a, b = sets[i], sets[j]
            same = cases[i][0] == cases[j][0] and cases[i][0] is not None
            near = a and b and None not in (cases[i][0], cases[j][0]) and 100 * len(a & b) >= 75 * len(a | b)
            if same or near:
                root[top(i)] = top(j)
    low = {}
    for i, (d, _) in enumerate(cases):
        if d is not None:
            low[top(i)] = min(low.get(top(i), d), d)
    out = []
    for i, (d, _) in enumerate(cases):
        c = None if d is None else low[top(i)]
        out.append((d, len(sets[i]), c, d == c))
    return out


def columns(df):
    return [(r.doc_id, r.n_shingles, r.component_id, r.kept) for r in df.collect()]


def test_equals_brute_force(docs, cases):
    assert by_key(columns(near_dedup.near_groups(docs))) == by_key(brute(cases))


@pytest.fixture(scope="module")
def copies():
    """Families of near copies around the threshold, and one large family."""
    rng = np.random.default_rng(5)
    out = []
    for family in range(25):
        base = prose(500 + family, int(rng.integers(20, 200))).split()
        for _ in range(60 if family == 0 else int(rng.integers(2, 8))):
            w = list(base)
            for p in rng.integers(0, len(w), int(rng.integers(0, max(2, len(w) // 20)))):
                w[p] = f"new{rng.integers(10**6)}"
            out.append(" ".join(w))
    return [(int(i), t) for i, t in zip(rng.permutation(len(out)), out, strict=True)]


def test_families_equal_brute_force(spark, copies):
    df = spark.createDataFrame(copies, "doc_id long, text string").repartition(6)
    assert by_key(columns(near_dedup.near_groups(df))) == by_key(brute(copies))


def test_an_empty_table(docs):
    assert near_dedup.near_groups(docs.limit(0)).count() == 0
    assert near_dedup.near_groups(docs.filter("text is null")).count() == docs.filter("text is null").count()


def test_one_document_of_a_group_stays(spark, docs, cases):
    out = near_dedup.drop_near_copies(docs)
    assert out.columns == docs.columns
    expected = collections.Counter(d for d, _, _, kept in brute(cases) if kept or d is None)
    assert collections.Counter(r.doc_id for r in out.collect()) == expected


def test_components_of_a_chain_and_a_star(spark):
    pairs = [(k, k + 1) for k in range(40)] + [(1000, k) for k in range(900, 960)] + [(5, 5), (None, 3)]
    links = spark.createDataFrame(pairs, "a long, b long")
    got = dict(components(links).collect())
    assert got == {k: 0 for k in range(41)} | {k: 900 for k in [*range(900, 960), 1000]}


def test_estimates_follow_the_similarity():
    rng = np.random.default_rng(2)
    both = rng.integers(0, 2**63, 600, dtype=np.uint64)
    a, b = np.sort(both[:525]), np.sort(both[75:])
    assert near_dedup.FORESTS[0].count * near_dedup.FORESTS[0].values <= near_dedup.VALUES
    bits = [np.packbits((near_dedup.minima(s) >> np.uint32(4)) & np.uint32(1)).view(np.uint64) for s in (a, b)]
    same = near_dedup.VALUES - int(np.bitwise_count(bits[0] ^ bits[1]).sum())
    assert near_dedup.LIKELY <= same <= 245


@pytest.mark.parametrize("originals", [1, 4])
def test_families_larger_than_a_region(spark, monkeypatch, originals):
    """Copies are near their original alone, which has not the smallest id."""
    monkeypatch.setattr(near_dedup, "REGION_ROWS", 8)
    rng = np.random.default_rng(11)
    base = prose(900, 200).split()
    texts = []
    for k in range(originals):
        # Originals are 0.6 to each other and share crowded regions.
        own = list(base)
        own[40 * k : 40 * k + 40] = prose(910 + k, 40).split()
        texts.append(" ".join(own))
        for _ in range(160 // originals):
            w = list(own)
            for p in rng.choice(200, 4, replace=False):
                w[p] = f"new{rng.integers(10**6)}"
            texts.append(" ".join(w))
    cases = [(int(i), t) for i, t in zip(rng.permutation(len(texts)), texts, strict=True)]
    assert cases[0][0] > 0
    df = spark.createDataFrame(cases, "doc_id long, text string").repartition(6)
    expected = brute(cases)
    assert collections.Counter(c for _, _, c, _ in expected).most_common(1)[0][1] > 3 * 8
    assert by_key(columns(near_dedup.near_groups(df))) == by_key(expected)


def test_crowded_regions_equal_brute_force(spark, copies, monkeypatch):
    monkeypatch.setattr(near_dedup, "REGION_ROWS", 4)
    df = spark.createDataFrame(copies, "doc_id long, text string").repartition(6)
    assert by_key(columns(near_dedup.near_groups(df))) == by_key(brute(copies))


def test_rows_that_repeat_an_id_are_one_document(spark, copies):
    """Ids that stand before several texts, some without words, join what their texts join."""
    cases = [(i // 3, t) for i, t in copies] + [(5, ""), (10**6, None), (None, copies[0][1])]
    df = spark.createDataFrame(cases, "doc_id long, text string").repartition(6)
    assert by_key(columns(near_dedup.near_groups(df))) == by_key(brute(cases))
    few = [(0, copies[0][1]), (1, copies[0][1]), (1, prose(77, 30))]
    got = columns(near_dedup.near_groups(spark.createDataFrame(few, "doc_id long, text string")))
    assert {c for _, _, c, _ in got} == {0}


@pytest.mark.parametrize("blocks_too", [False, True])
def test_unlinked_rows_that_share_prefixes(spark, monkeypatch, blocks_too):
    """Rows about 0.55 to each other crowd regions without links; some pairs among them have one."""
    monkeypatch.setattr(near_dedup, "REGION_ROWS", 2 if blocks_too else 12)
    rng = np.random.default_rng(12)
    base, texts = prose(901, 160).split(), []
    for k in range(120):
        w = list(base)
        for p in rng.choice(160, 12, replace=False):
            w[p] = f"own{k}x{p}"
        texts.append(" ".join(w))
        if k % 10 == 0:
            w[3] = "twin"
            texts.append(" ".join(w))
    cases = [(int(i), t) for i, t in zip(rng.permutation(len(texts)), texts, strict=True)]
    df = spark.createDataFrame(cases, "doc_id long, text string").repartition(6)
    expected = brute(cases)
    assert 12 <= len({c for _, _, c, _ in expected}) <= 125
    assert by_key(columns(near_dedup.near_groups(df))) == by_key(expected)


def test_neighbours_have_the_longest_prefix_with_a_candidate():
    rng = np.random.default_rng(4)
    forest = near_dedup.Orders(1, 4, 2)
    m = 60
    labels = np.concatenate((np.full((m, 2), 7), rng.integers(0, 3, (m, 2))), axis=1).astype(">u2")
    labels = labels[np.lexsort(labels.T[::-1])]
    bits = rng.integers(0, 2**63, (8, 4), dtype=np.uint64)[rng.integers(0, 8, m)]
    r = {"rep": np.arange(m), "n": np.full(m, 50), "sig": bits, "label": [x.tobytes() for x in labels]}
    partner = near_dedup._nearest(r, 75, forest)
    for i in range(m):
        likely = [j for j in range(m) if j != i and (bits[i] == bits[j]).all()]
        common = {j: int(np.cumprod(labels[i] == labels[j]).sum()) for j in likely}
        if not likely:
            assert partner[i] == -1
        else:
            assert partner[i] in likely and common[partner[i]] == max(common.values())


def test_sorted_rows_come_in_whole_regions_or_pieces():
    import pyarrow as pa

    keys = np.repeat(np.arange(9), [3, 1, 2, 12, 1, 1, 4, 2, 5])
    table = pa.table({"key": keys, "rep": np.arange(len(keys)), "sig": [bytes(32)] * len(keys)})
    for size in (1, 2, 5, 100):
        got = [(int(r["key"][0]), len(r["rep"]), whole) for r, whole in near_dedup._pieces(iter(table.to_batches(size)), 6)]
        rows = {k: sum(n for key, n, _ in got if key == k) for k in range(9)}
        assert rows == {0: 3, 1: 0, 2: 2, 3: 12, 4: 0, 5: 0, 6: 4, 7: 2, 8: 5}, size
        assert {k for k, _, whole in got if not whole} == {0, 3, 8}
        assert all(n <= 6 + size for _, n, whole in got if not whole)
        assert [len(r["rep"]) for r in near_dedup._regions(iter(table.to_batches(size)))] == [3, 2, 12, 4, 2, 5]
