import collections
import itertools
import math
import pathlib
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from granary.llm import quality, queries, toxicity
from granary.llm import words as W
from tests.llm.conftest import prose


@pytest.fixture(scope="module")
def labelled(spark):
    rng = np.random.default_rng(1)
    rows, labels = [], []
    for i in range(600):
        good, toxic = int(rng.random() < 0.7), int(rng.random() < 0.3)
        text = prose(i, int(rng.integers(20, 120)))
        if not good:
            text = " ".join(w.upper() + "!!" for w in text.split())
        if toxic:
            w = text.split()
            w.insert(int(rng.integers(0, len(w))), str(rng.choice(["blockhead", "dimwit", "foulster", "foulling", "foulmouth"])))
            text = " ".join(w)
        rows.append((i, text))
        labels.append((i, good, toxic))
    return spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


@pytest.mark.parametrize("kind", ["quality", "toxic"])
def test_held_out_rows_are_told_apart(labelled, kind):
    docs, labels = labelled
    operator = quality if kind == "quality" else toxicity
    out = operator.scored(docs, operator.train(docs, labels, kind)).join(labels, "doc_id").filter("held_out").toPandas()
    assert len(out) > 80
    assert ((out["score"] >= 0) & (out["score"] <= 1)).all()
    assert (out["predicted"] == out[kind]).mean() > 0.97


def test_held_out_rows_are_not_learned_from(labelled):
    docs, labels = labelled
    turned = labels.withColumn("quality", F.when(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, 1 - F.col("quality")).otherwise(F.col("quality")))
    a, b = quality.train(docs, labels), quality.train(docs, turned)
    assert (a.weights == b.weights).all() and (a.slope, a.offset) == (b.slope, b.offset)


@pytest.mark.parametrize("operator", [quality, toxicity])
def test_awkward_rows(spark, docs, cases, labelled, operator):
    model = operator.train(*labelled, "quality" if operator is quality else "toxic", rows=200)
    out = operator.scored(docs, model)
    rows = out.collect()
    assert len(rows) == len(cases)
    held = {i: i is not None and zlib.crc32(str(i).encode()) % 5 == 0 for i, _ in cases}
    assert all(r.held_out == held[r.doc_id] and 0 <= r.score <= 1 for r in rows)
    empty = {r.score for r in rows if r.doc_id in (2, 3)}
    assert len(empty) == 1
    assert operator.scored(docs.limit(0), model).count() == 0


@pytest.mark.parametrize("operator", [quality, toxicity])
def test_no_labels_or_one_kind(spark, docs, labelled, operator):
    texts, labels = labelled
    label = "quality" if operator is quality else "toxic"
    none = operator.train(texts, labels.limit(0), label)
    assert {r.score for r in operator.scored(texts, none).collect()} == {0.5}
    ones = operator.train(texts, labels.filter(F.col(label) == 1), label)
    assert all(r.predicted == 1 for r in operator.scored(texts, ones).collect())
    nulls = operator.train(texts, labels.withColumn(label, F.lit(None).cast("int")), label)
    assert len(operator.scored(texts, nulls).collect()) == 600


def test_rejected_rows_go_and_columns_stay(docs, labelled):
    texts, labels = labelled
    wide = texts.withColumn("kept", F.lit("clash"))
    out = quality.drop_rejected(wide, labels)
    assert out.columns == wide.columns
    bad = labels.filter("quality = 0").select("doc_id")
    assert out.join(bad, "doc_id", "left_semi").count() <= 2
    assert out.count() >= labels.filter("quality = 1").count() - 2


def test_descent_reaches_the_optimum_of_the_dual():
    """At the optimum every row meets its margin condition."""
    rng = np.random.default_rng(3)
    rows = [np.unique(rng.integers(0, 50, 12)) for _ in range(120)]
    y = np.array([int(len(set(r) & set(range(10))) > 2) for r in rows])
    ratio = quality.log_count_ratio(rows, y)
    w, bias = quality.dual_descent(rows, y, ratio, 1.0, rounds=300)
    margin = np.where(y == 1, 1, -1) * np.array([w[r].sum() + bias for r in rows])
    assert (margin > 0).mean() > 0.95
    more, more_bias = quality.dual_descent(rows, y, ratio, 1.0, rounds=600)
    assert np.abs(w - more).max() < 0.05 and abs(bias - more_bias) < 0.05


def test_ratios_are_by_hand():
    rows = [np.array([1, 2]), np.array([2]), np.array([3])]
    r = quality.log_count_ratio(rows, np.array([1, 1, 0]))
    total = quality.BUCKETS
    assert r[2] == pytest.approx(np.log(3 / (total + 3)) - np.log(1 / (total + 1)))
    assert r[3] == pytest.approx(np.log(1 / (total + 3)) - np.log(2 / (total + 1)))


@pytest.fixture(scope="module")
def speech():
    return toxicity.Model({"idiot": 5.0}, {"foul": 4.0}, 1.0, -3.0).ready()


def weight(model, text):
    return model.weight(model.clauses(text))


def test_clauses_not_words(speech):
    plain, aimed = weight(speech, "what an idiot"), weight(speech, "you are an idiot")
    assert aimed > plain > 0
    assert weight(speech, "you are not an idiot") < aimed
    assert weight(speech, "she said the man was an idiot") < plain + 1
    assert weight(speech, "no rain today. what an idiot") == plain
    assert weight(speech, "foulness and foulling") > 0 and weight(speech, "seafoul") == 0
    assert weight(speech, "I will kill you") > 0 and weight(speech, "I will kill time") == 0
    assert weight(speech, "idiot idiot idiot") == plain
    assert weight(speech, "") == 0


def test_composition_runs_parts_side_by_side():
    a = toxicity.Transducer(0, {(0, 1): (1, 1.0), (1, 1): (0, 2.0)}, {1: 5.0})
    b = toxicity.Transducer(0, {(0, 1): (0, 10.0)})
    both = toxicity.compose([a, b])
    state, total = both.start, 0.0
    for symbol in (1, 0, 1, 1):
        state, w = both.step(state, symbol)
        total += w
    assert total + both.final[state] == 1 + 10 + 2 + 10 + 1 + 10 + 5


def test_a_word_beside_a_copied_insult_is_not_learned():
    copied = "strange neighbour dimwit elsewhere"
    texts = [copied] * 20 + [f"w{i} dimwit x{i}" for i in range(20)] + [f"clean text w{i} x{i}" for i in range(100)]
    model = toxicity.learned(texts, np.array([1] * 40 + [0] * 100))
    assert "dimwit" in model.words and "elsewhere" not in model.words and "neighbour" not in model.words


def test_queries(spark, sf_dir):
    n = spark.read.parquet(f"{sf_dir}/documents.parquet").count()
    for query in (queries.op1_quality, queries.op9_toxicity):
        out = query(spark, sf_dir)
        assert out.columns[:4] == ["doc_id", "held_out", "score", "predicted"] and out.count() == n


@pytest.mark.parametrize("operator", [quality, toxicity])
def test_repeated_ids_do_not_widen_the_sample(spark, operator):
    """The bound holds after the join, however often an id, a text or a label repeats."""
    texts = spark.range(50).selectExpr("id as doc_id", "concat('word ', id) as text")
    texts = texts.unionByName(spark.range(5000).selectExpr("7l as doc_id", "concat('other ', id) as text"))
    texts = texts.unionByName(spark.range(3000).selectExpr("8l as doc_id", "'same' as text"))
    labels = spark.range(50).selectExpr("id as doc_id", "cast(id % 2 as int) as quality").crossJoin(spark.range(3).select())
    assert quality.training_rows(texts, labels, "quality", 10).count() == 10
    all_rows = quality.training_rows(texts, labels, "quality", 100_000).groupBy("id").count().collect()
    held_back = {i for i in range(50) if zlib.crc32(str(i).encode()) % 5 == 0}
    assert {r.id: r["count"] for r in all_rows} == {i: 5001 if i == 7 else 2 if i == 8 else 1 for i in range(50) if i not in held_back}
    assert operator.train(texts, labels, "quality", rows=10) is not None


def test_learning_in_spark_equals_learning_in_memory(labelled):
    docs, labels = labelled
    sample = quality.training_rows(docs, labels, "toxic", 10_000).orderBy("id", "label").toPandas()
    here = toxicity.learned(sample["text"].tolist(), sample["label"].to_numpy())
    there = toxicity.train(docs, labels)
    assert (here.words, here.stems) == (there.words, there.stems) and len(here.words) + len(here.stems) > 2
    assert (here.slope, here.offset) == pytest.approx((there.slope, there.offset), rel=1e-6)


def test_reported_speech_weighs_less_on_both_sides(speech):
    aimed, plain = weight(speech, "you are an idiot"), weight(speech, "what an idiot")
    for text in ("he said you are an idiot", "you are an idiot, he said", "'you are an idiot' she wrote", "“You are an idiot!” she said",
                 'he said: "you are an idiot"', "you idiot, he reported"):
        assert 0 < weight(speech, text) < aimed, text
    # Only what the marks enclose is told, and marks alone report nothing.
    assert weight(speech, "\"she is nice\" he said, you idiot") == weight(speech, "he left, you idiot")
    assert weight(speech, "the \"idiot\" left") == plain
    assert weight(speech, "he said you are not an idiot") < weight(speech, "he said you are an idiot")
    assert weight(speech, "the driver's dog isn't an idiot") < plain


def test_a_transducer_reads_what_another_writes():
    rewrite = toxicity.machine(0, lambda s, x: (1, 0.5, "told") if x == "insult" else (s, 0.0, x))
    count = toxicity.machine(0, lambda s, x: (s, 1.0 if x == "told" else 0.0, x), lambda s: 0.25)
    both = toxicity.cascade(rewrite, count)
    state, total = both.start, 0.0
    for symbol in ("other", "insult", "insult"):
        state, w = both.step(state, toxicity.SYMBOLS.index(symbol))
        total += w
    assert total + both.final[state] == 2 * 1.5 + 0.25


def measures(spark, query, label, sf_dir):
    out = query(spark, sf_dir).join(spark.read.parquet(f"{sf_dir}/labels.parquet"), "doc_id").filter(f"held_out and {label} is not null").toPandas()
    right = (out["predicted"] == out[label]).mean()
    return right, out.loc[out[label] == 1, "predicted"].mean(), out.loc[out["predicted"] == 1, label].mean(), len(out)


@pytest.mark.skipif(not pathlib.Path("/root/testdata/sf0.1").exists(), reason="test tables are not available")
@pytest.mark.parametrize(("query", "label"), [(queries.op1_quality, "quality"), (queries.op9_toxicity, "toxic")])
def test_held_out_rows_of_the_tables(spark, query, label):
    right, recall, precision, n = measures(spark, query, label, "/root/testdata/sf0.1")
    assert n > 500 and right >= 0.98 and recall >= 0.9 and precision >= 0.95


def by_hand(text):
    """The indicators of one text, gram by gram, as a set of buckets."""
    kinds = [quality._KIND[b] for b in text]
    runs = []
    for k, same in itertools.groupby(kinds):
        runs.append(int(k) * 2 + (len(list(same)) > 1))
    words = [w for w in text.replace(b"\x0b", b" ").replace(b"\x0c", b" ").split()]
    grams = [[tuple(runs[i : i + k]) for i in range(len(runs) - k + 1)] for k in quality.LENGTHS]
    grams.append([int(i > 0 and words[i] == words[i - 1]) for i in range(len(words))])
    held = set()
    for k, found in zip((*quality.LENGTHS, None), grams, strict=True):
        for g, n in collections.Counter(found).items():
            if k is None:
                h = np.array([g + (quality._SAME << 32)], dtype=np.uint64)
            else:
                h = np.array([k], dtype=np.uint64)
                for x in g:
                    h = h * np.uint64(0x9E3779B97F4A7C15) + np.uint64(x)
            bucket = int(W.mix(h)[0] % np.uint64(quality.BUCKETS))
            level = min(int(np.log2(len(found) / n)), quality.LEVELS)
            held |= {bucket, (bucket * 31 + (level + 1) * 7919) % quality.BUCKETS}
    return sorted(held)


def test_quality_scores_of_the_query_one_by_one(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    model = quality.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    got = {r.doc_id: (r.score, r.predicted) for r in queries.op1_quality(spark, sf_dir).collect()}
    for r in docs.collect():
        margin = sum(model.weights[b] for b in by_hand((r.text or "").encode())) + model.bias
        score = 1 / (1 + math.exp(-min(30, max(-30, model.slope * margin + model.offset))))
        assert got[r.doc_id] == (pytest.approx(score, abs=1e-9), int(score >= 0.3)), r.doc_id


def test_toxicity_scores_of_the_query_one_by_one(spark, sf_dir):
    docs, labels = (spark.read.parquet(f"{sf_dir}/{n}.parquet") for n in ("documents", "labels"))
    texts = {r.doc_id: r.text or "" for r in docs.collect()}
    known = sorted({(r.doc_id, r.toxic) for r in labels.collect() if r.toxic is not None and zlib.crc32(str(r.doc_id).encode()) % 5 and r.doc_id in texts})
    model = toxicity.learned([texts[i] for i, _ in known], np.array([y for _, y in known]))
    got = {r.doc_id: (r.score, r.predicted, r.n_clauses) for r in queries.op9_toxicity(spark, sf_dir).collect()}
    for i, t in texts.items():
        found = model.clauses(t)
        assert got[i] == (pytest.approx(model.score(found), abs=1e-6), int(model.score(found) >= 0.5), len(found))
