import base64
import collections
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from tokenizers import Tokenizer

from granary.llm import bpe, packing, queries, tokens

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
JSON = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def library():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(RANKS, "rb"))}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def key(rows):
    return sorted(rows, key=repr)


def test_ranks_of_both_files_are_the_same():
    assert tokens.json_ranks(JSON) == tokens.rank_file(RANKS)


@pytest.mark.parametrize(("chunk", "overlap"), [(32_768, 1_024), (64, 24), (7, 5), (50, 3)])
def test_ids_equal_the_library_and_bytes_come_back(docs, cases, library, chunk, overlap):
    encoded = bpe.encode_texts(docs, RANKS, chunk, overlap)
    got = bpe.decode_ids(encoded, RANKS).collect()
    expected = [(i, library.encode_ordinary(t or ""), (t or "").encode()) for i, t in cases]
    assert key((r.doc_id, list(r.ids), bytes(r.decoded)) for r in got) == key(expected)


def test_odd_texts_in_small_chunks(spark, library):
    rng = random.Random(3)
    texts = ["".join(rng.choice(" \n\t  ab'sé1 　.!中re'") for _ in range(400)) for _ in range(120)]
    texts += ["a" * 3000, " " * 700 + "x", "中" * 500 + "。" * 3 + "文" * 50, "''rest" * 150, "<|endoftext|> x" * 40]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: list(r.ids) for r in bpe.encode_texts(df, RANKS, chunk=64, overlap=24).collect()}
    assert got == {i: library.encode_ordinary(t) for i, t in enumerate(texts)}


def test_cuts_are_found():
    edges = bpe._edges(64, 24)
    import pyarrow as pa

    text = "word " * 100
    chunks = pa.table({"row": [1, 1], "chunk": [0, 1], "text": [text[:88], text[64:152]]}).to_batches()
    (found,) = edges(iter(chunks))
    assert bpe._stitched(pa.Table.from_batches([found])).to_pylist()[0]["cuts"]


@pytest.fixture(scope="module")
def pieces(spark, docs):
    return packing.pack(docs, JSON, sequence=64, window_sequences=4).toPandas()


def library_ids(cases):
    t = Tokenizer.from_file(JSON)
    return [(i, [*e.ids, 0]) for (i, _), e in zip(cases, t.encode_batch([x or "" for _, x in cases], add_special_tokens=False), strict=True)]


def test_pieces_cover_each_id_once(pieces, cases):
    def ids(rows):
        return [x for r in rows.sort_values("start").itertuples() for x in np.frombuffer(r.ids, "<u4").tolist()]

    known = collections.Counter((i, tuple(x)) for i, x in library_ids(cases))
    unique = [i for i, n in collections.Counter(i for i, _ in cases).items() if n == 1 and i is not None]
    for i in unique:
        mine = pieces[pieces["doc_id"] == i]
        assert (i, tuple(ids(mine))) in known
        assert (mine["doc_tokens"] == mine["length"].sum()).all()
    assert pieces["length"].sum() == sum(len(x) for _, x in library_ids(cases))


def test_sequences_are_full_and_gapless(pieces):
    filled = []
    for _, rows in pieces.sort_values(["sequence_id", "offset"]).groupby("sequence_id"):
        ends = rows["length"].cumsum().tolist()
        assert rows["offset"].tolist() == [0, *ends[:-1]]
        filled.append(ends[-1])
    assert filled[:-1] == [64] * (len(filled) - 1) and 0 < filled[-1] <= 64
    assert pieces["sequence_id"].max() == len(filled) - 1


def mixture(pieces, source):
    pieces = pieces.assign(source=pieces["doc_id"].map(source))
    return pieces.groupby(["window", "source"])["length"].sum().unstack(fill_value=0)


def queue_docs(spark):
    rng = random.Random(4)
    rows = [(i, "word " * rng.randrange(1, 200), rng.choice("aaab") if i % 10 else "c") for i in range(400)]
    return rows, spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(5)


def test_every_window_has_the_mixture_of_all(spark):
    rows, df = queue_docs(spark)
    out = packing.pack(df, JSON, sequence=128, window_sequences=8).toPandas()
    table = mixture(out, {i: s for i, _, s in rows}).iloc[:-1]
    share = out.assign(s=out["doc_id"].map({i: s for i, _, s in rows})).groupby("s")["length"].sum() / out["length"].sum()
    assert (table.sum(axis=1) == 1024).all()
    for s in table:
        # Credit that a window could not serve goes to the next one, so sums stay close too.
        assert (np.abs(table[s] - share[s] * 1024) <= 2).all()
        assert (np.abs(table[s].cumsum() - share[s] * 1024 * np.arange(1, len(table) + 1)) <= 2).all()


def test_target_proportions_hold_until_a_queue_is_empty(spark):
    rows, df = queue_docs(spark)
    out = packing.pack(df, JSON, {"a": 0.2, "b": 0.4, "c": 0.4}, sequence=128, window_sequences=8).toPandas()
    table = mixture(out, {i: s for i, _, s in rows})
    assert (np.abs(table[["a", "b", "c"]].iloc[:2].to_numpy() - np.array([204.8, 409.6, 409.6])) <= 2).all()
    assert out["length"].sum() == sum(len(x) for _, x in library_ids([(i, t) for i, t, _ in rows]))
    with pytest.raises(ValueError, match="positive"):
        packing.pack(df, JSON, {"a": 0.0})


def test_service_equals_a_round_robin_of_single_tokens():
    sizes, shares = np.array([7, 40, 13]), np.array([0.5, 0.3, 0.2])
    order = sorted(((x + 0.5) / p, q) for q, (n, p) in enumerate(zip(sizes, shares, strict=True)) for x in range(n))
    service = packing.Service(sizes, shares)
    after = service.after(np.arange(61))
    for served in range(61):
        counts = collections.Counter(q for _, q in order[:served])
        assert after[served].tolist() == [counts[q] for q in range(3)]


def test_many_sources_share_queues(spark, monkeypatch):
    monkeypatch.setattr(packing, "QUEUES", 2)
    rows, df = queue_docs(spark)
    out = packing.pack(df, JSON, sequence=128).toPandas()
    assert out["length"].sum() == sum(len(x) for _, x in library_ids([(i, t) for i, t, _ in rows]))


def test_targets_hold_for_more_sources_than_shared_queues(spark, monkeypatch):
    """Named sources and all that have a token in each window keep queues of their own."""
    monkeypatch.setattr(packing, "QUEUES", 2)
    rows, df = queue_docs(spark)
    out = packing.pack(df, JSON, {"a": 0.8, "b": 0.1, "c": 0.1}, sequence=64, window_sequences=4).toPandas()
    table = mixture(out, {i: s for i, _, s in rows})
    assert (np.abs(table[["a", "b", "c"]].iloc[0].to_numpy() - np.array([204.8, 25.6, 25.6])) <= 2).all()


def test_many_small_sources_are_packed_whole(spark, monkeypatch):
    """A source of its own for each of many documents, beside two large ones, one with a target."""
    monkeypatch.setattr(packing, "QUEUES", 3)
    rng = random.Random(6)
    rows = [(i, "word " * rng.randrange(60, 90), "large" if i % 2 else "named") for i in range(60)] + [(1000 + i, "w", f"s{i}") for i in range(200)]
    rows += [(5000, "tiny", "aim"), (5001, "null source", None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(4)
    out = packing.pack(df, JSON, {"named": 0.5, "aim": 0.01, "absent": 0.2}, sequence=32, window_sequences=1).toPandas()
    ids = dict(library_ids([(i, t) for i, t, _ in rows]))
    for i, mine in out.sort_values("start").groupby("doc_id"):
        assert [x for r in mine.itertuples() for x in np.frombuffer(r.ids, "<u4").tolist()] == ids[i]
    assert set(out["doc_id"]) == set(ids)
    filled = out.groupby("sequence_id")["length"].sum().tolist()
    assert filled[:-1] == [32] * (len(filled) - 1)


def test_special_strings_are_their_tokens(spark):
    texts = ["a <|endoftext|> b", "<|endoftext|><|endoftext|>", "x<|endoftext|", " <|endoftext|>\n<|endof<|endoftext|>text|>", "<|ENDOFTEXT|>", ""]
    rng = random.Random(8)
    texts += ["".join(rng.choice(["<|endoftext|>", "<|", "endoftext", "|>", " ", "é中", "\n"]) for _ in range(30)) for _ in range(200)]
    rows = list(enumerate(texts))
    df = spark.createDataFrame([(i, t, "s") for i, t in rows], "doc_id long, text string, source string")
    out = packing.pack(df, JSON).toPandas().sort_values("start")
    got = {i: [x for r in mine.itertuples() for x in np.frombuffer(r.ids, "<u4").tolist()] for i, mine in out.groupby("doc_id")}
    assert got == dict(library_ids(rows))
    assert 50256 in got[0] and tokens.token_bytes(JSON)[50256] == b"<|endoftext|>"


def test_sequences_as_rows(spark):
    rows, df = queue_docs(spark)
    packed = packing.pack(df, JSON, sequence=128)
    lengths = [len(r.ids) // 4 for r in packing.sequences(packed).orderBy("sequence_id").collect()]
    assert set(lengths[:-1]) == {128} and sum(lengths) == packed.toPandas()["length"].sum()


def test_empty_tables(docs):
    none = docs.limit(0)
    assert bpe.encode_texts(none, RANKS).count() == 0
    assert packing.pack(none, JSON).count() == 0


def test_query_digests(spark, sf_dir):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    ids = dict(library_ids(docs))
    out = queries.op10_packing(spark, sf_dir).collect()
    assert all(zlib.crc32(np.array(ids[r.doc_id][r.start : r.start + r.length], "<u4").tobytes()) == r.ids_crc32 for r in out)
    import hashlib

    for r in queries.op3_bpe(spark, sf_dir).collect():
        own = ids[r.doc_id][:-1]
        assert (r.n_tokens, r.ids_sha256) == (len(own), hashlib.sha256(" ".join(map(str, own)).encode()).hexdigest())
        assert r.decoded_sha256 == hashlib.sha256((dict(docs)[r.doc_id] or "").encode()).hexdigest()
