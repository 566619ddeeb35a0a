import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from granary.llm import queries
from tests.llm.test_near_dedup import brute as near_brute
from tests.llm.test_passages import brute as passage_brute
from tests.llm.test_tokens import library_ids


def test_stages_against_brute_force(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    names, rows = docs.columns, {}
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        before = docs
        docs = spark.createDataFrame(stage(spark, docs, sf_dir).toPandas())
        if k < len(corpus_pipeline.STAGES) - 1:
            assert docs.columns == names, name
        held = {r.doc_id: r.text for r in before.collect()}
        rows = docs.collect()
        if name == "quality":
            scored = queries.op1_quality(spark, sf_dir).filter("predicted = 1")
            assert {r.doc_id for r in rows} == {r.doc_id for r in scored.collect()}
        elif name == "exact_dedup":
            best = {}
            for i, t in held.items():
                best[t] = max(i, best.get(t, i))
            assert {r.doc_id for r in rows} == set(best.values())
        elif name == "near_dedup":
            assert {r.doc_id for r in rows} == {i for i, _, _, kept in near_brute(list(held.items())) if kept}
        elif name == "passages":
            left = {i: (t, n, gone) for i, t, n, gone in passage_brute(list(held.items()))}
            expected = {i: (t if gone else held[i]) for i, (t, n, gone) in left.items() if not gone or gone < n}
            assert {r.doc_id: r.text for r in rows} == expected
            assert all(r.n_chars == len(r.text) for r in rows)
        else:
            ids = dict(library_ids(list(held.items())))
            assert sum(r.length for r in rows) == sum(map(len, ids.values()))
            for r in rows:
                own = np.array(ids[r.doc_id][r.start : r.start + r.length], "<u4").tobytes()
                assert zlib.crc32(own) == r.ids_crc32
    final = {(r.doc_id, r.start, r.length, r.sequence_id, r.offset) for r in corpus_pipeline.run(spark, sf_dir).collect()}
    assert len(final) > 0 and {f[0] for f in final} == {r.doc_id for r in rows}


@pytest.fixture
def awkward(docs):
    """Documents with nulls, copies, long texts and columns of clashing names."""
    return docs.withColumn("n_chars", F.char_length("text").cast("long")).withColumns({"n_words": F.lit("x"), "kept_text": F.lit("y"), "_other0": F.lit("z")})


def labels_at(spark, folder, rows):
    spark.createDataFrame(rows, "doc_id long, quality int, toxic int").write.mode("overwrite").parquet(f"{folder}/labels.parquet")
    return str(folder)


def test_awkward_documents_stage_by_stage(spark, awkward, cases, tmp_path):
    held = lambda df: sorted(((r.doc_id, r.text) for r in df.collect()), key=repr)
    nothing = labels_at(spark, tmp_path, [])
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, awkward, nothing)
        assert out.columns == awkward.columns and dict(out.dtypes) == dict(awkward.dtypes), name
        assert {(r.n_words, r.kept_text, r._other0, r.kept) for r in out.collect()} == {("x", "y", "z", "clash")}, name
        if name == "quality":
            assert held(out) == sorted(cases, key=repr)
        elif name == "exact_dedup":
            assert len({t or "" for _, t in cases}) == out.count() and {t or "" for _, t in held(out)} == {t or "" for _, t in cases}
        elif name == "near_dedup":
            kept = [i for i, _, _, kept in near_brute(cases) if kept or i is None]
            assert sorted((i for i, _ in held(out)), key=repr) == sorted(kept, key=repr)
        else:
            left = [(i, t if gone else (w or "")) for (i, t, n, gone), (_, w) in zip(passage_brute(cases), cases, strict=True) if not gone or gone < n]
            assert held(out) == sorted(left, key=repr)
            assert all(r.n_chars == len(r.text) for r in out.collect())
    pieces = corpus_pipeline.packed(spark, awkward, nothing).collect()
    assert sum(r.length for r in pieces) == sum(len(x) for _, x in library_ids(cases))


def test_empty_tables_and_one_sided_labels(spark, awkward, tmp_path):
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, awkward.limit(0), labels_at(spark, tmp_path / "none", [])).count() == 0
    bad = labels_at(spark, tmp_path / "bad", [(k, 0, 0) for k in range(1, 30)])
    assert corpus_pipeline.good_quality(spark, awkward, bad).count() == 0
    awkward.limit(0).write.parquet(str(tmp_path / "none" / "documents.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path / "none")).count() == 0
