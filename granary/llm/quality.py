"""Document quality by Naive Bayes support vectors (Wang & Manning, 2012).

A text is a set of n-gram indicators. Its n-grams are made of the shapes that texts in any
language have in common: runs of letters, capitals, digits, marks and breaks, and words that
repeat the one before. An n-gram counts by presence and, once more, by its share of the text
in powers of two. Each indicator is scaled by its class log-count ratio, and a linear model
with hinge loss is fitted to the scaled indicators by dual coordinate descent. A logistic
curve turns margins into scores.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from granary.llm import words as W

#: Labelled rows the model is fitted on, picked by a hash of their id.
SAMPLE_ROWS = 16_000
BUCKETS = 1 << 16
LENGTHS = (1, 2, 3, 5)
LEVELS = 8
THRESHOLD = 0.3

_LOWER, _CAPITAL, _DIGIT, _BREAK, _GAP, _SAME = 1, 2, 3, 4, 5, 6


def _classes() -> np.ndarray:
    """A number for each byte: its kind, or itself for marks."""
    kind = np.arange(256, dtype=np.uint8)
    kind[ord("a") : ord("z") + 1] = _LOWER
    kind[ord("A") : ord("Z") + 1] = _CAPITAL
    kind[ord("0") : ord("9") + 1] = _DIGIT
    kind[128:] = _LOWER  # letters outside ASCII
    kind[[9, 11, 12, 32]] = _GAP
    kind[[10, 13]] = _BREAK
    return kind


_KIND = _classes()


def indicators(texts: list[bytes]) -> list[np.ndarray]:
    """Buckets of the n-gram indicators of each text; those of an empty text are none."""
    kind = _KIND[np.frombuffer(b"".join(texts), dtype=np.uint8)]
    edges = np.cumsum([0, *map(len, texts)])
    # A run of one kind counts once, as a single letter or as a longer run.
    change = np.concatenate(([True], kind[1:] != kind[:-1]))[: len(kind)]
    change[edges[:-1][edges[:-1] < len(kind)]] = True
    opens = np.flatnonzero(change)
    runs = (kind[opens].astype(np.int64) * 2 + (np.diff(np.append(opens, len(kind))) > 1)).astype(np.uint64)
    bounds = np.searchsorted(opens, edges)
    grams = []
    for k in LENGTHS:
        h = np.full(max(0, len(runs) - k + 1), k, dtype=np.uint64)
        for j in range(k):
            h = h * np.uint64(0x9E3779B97F4A7C15) + runs[j : len(runs) - k + 1 + j]
        grams.append((W.mix(h) % np.uint64(BUCKETS)).astype(np.int64))
    words = W.hashed(texts)
    same = np.concatenate(([False], words.hashes[1:] == words.hashes[:-1]))[: len(words.hashes)]
    same[words.bounds[:-1][words.bounds[:-1] < len(same)]] = False
    same = (W.mix(same.astype(np.uint64) + np.uint64(_SAME << 32)) % np.uint64(BUCKETS)).astype(np.int64)
    out = []
    for i in range(len(texts)):
        begin, end = bounds[i], bounds[i + 1]
        found = [g[begin : max(begin, end - k + 1)] for k, g in zip(LENGTHS, grams, strict=True)]
        held = []
        for h in (*found, same[words.bounds[i] : words.bounds[i + 1]]):
            if len(h):
                bucket, count = np.unique(h, return_counts=True)
                level = np.minimum(np.log2(len(h) / count).astype(np.int64), LEVELS)
                held += [bucket, (bucket * 31 + (level + 1) * 7919) % BUCKETS]
        out.append(np.unique(np.concatenate(held)) if held else np.zeros(0, dtype=np.int64))
    return out


@dataclass
class Model:
    """Weights of the indicators, and the logistic curve from margin to score."""

    weights: np.ndarray
    bias: float
    slope: float
    offset: float

    def scores(self, texts: list[bytes | None]) -> np.ndarray:
        margin = np.array([self.weights[f].sum() for f in indicators([t or b"" for t in texts])]) + self.bias
        return 1 / (1 + np.exp(-np.clip(self.slope * margin + self.offset, -30, 30)))


def log_count_ratio(rows: list[np.ndarray], labels: np.ndarray, alpha: float = 1.0) -> np.ndarray:
    """Logarithm of how much oftener an indicator comes with label 1 than with label 0."""
    counts = [
        np.bincount(np.concatenate([r for r, y in zip(rows, labels, strict=True) if y == c] or [np.zeros(0, np.int64)]), minlength=BUCKETS) + alpha
        for c in (0, 1)
    ]
    return np.log(counts[1] / counts[1].sum()) - np.log(counts[0] / counts[0].sum())


def dual_descent(
    rows: list[np.ndarray], labels: np.ndarray, ratio: np.ndarray, cost: float, rounds: int = 12
) -> tuple[np.ndarray, float]:
    """Weights of the unscaled indicators that minimise the regularised hinge loss."""
    y = np.where(labels == 1, 1.0, -1.0)
    values = [ratio[r] for r in rows]
    square = np.array([float(v @ v) + 1.0 for v in values])
    # The rarer class weighs as much as the other.
    share = max(1e-9, float((labels == 1).mean()))
    limit = np.where(labels == 1, cost * 0.5 / share, cost * 0.5 / max(1e-9, 1 - share))
    alpha = np.zeros(len(rows))
    w, bias = np.zeros(BUCKETS), 0.0
    rng = np.random.default_rng(7)
    for _ in range(rounds):
        for i in rng.permutation(len(rows)):
            slack = y[i] * (float(w[rows[i]] @ values[i]) + bias) - 1.0
            new = min(max(alpha[i] - slack / square[i], 0.0), limit[i])
            step = (new - alpha[i]) * y[i]
            if step:
                w[rows[i]] += step * values[i]
                bias += step
                alpha[i] = new
    return w * ratio, bias


def _curve(margin: np.ndarray, labels: np.ndarray) -> tuple[float, float]:
    """Slope and offset of the logistic curve, by Newton steps with smoothed labels."""
    goal = np.where(labels == 1, 1 - 1 / (labels.sum() + 2), 1 / ((labels == 0).sum() + 2))
    x = np.stack([margin, np.ones(len(margin))], axis=1)
    b = np.array([1.0, 0.0])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ b, -30, 30)))
        hessian = (x * (p * (1 - p))[:, None]).T @ x + 1e-6 * np.eye(2)
        step = np.linalg.solve(hessian, x.T @ (goal - p))
        b = b + np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-8:
            break
    return float(b[0]), float(b[1])


def fitted(rows: list[np.ndarray], labels: np.ndarray, cost: float = 0.05) -> Model:
    """The model; a fifth of the rows is held back to fit the curve."""
    if not len(rows) or (labels == labels[0]).all():
        known = float(labels[0]) if len(rows) else 0.5
        return Model(np.zeros(BUCKETS), 0.0, 0.0, float(np.log((known + 0.01) / (1.01 - known))))
    back = np.arange(len(rows)) % 5 == 4
    use = [r for r, b in zip(rows, back, strict=True) if not b]
    ratio = log_count_ratio(use, labels[~back])
    w, bias = dual_descent(use, labels[~back], ratio, cost)
    margin = np.array([float(w[r].sum()) + bias for r, b in zip(rows, back, strict=True) if b])
    slope, offset = _curve(margin, labels[back]) if back.any() and len(set(labels[back])) > 1 else (1.0, 0.0)
    return Model(w, bias, slope, offset)


def held_out(doc_id="doc_id"):
    """Rows that no model may learn from: crc32 of the id as text is divisible by 5."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 5 == 0, F.lit(False))


def training_rows(docs: DataFrame, labels: DataFrame, label: str, rows: int) -> DataFrame:
    """``id, text, label`` of at most ``rows`` labelled documents that may be learned from.

    Rows that repeat an id, its text and its label count once. Documents are picked by a hash
    of their id after the join with the labels, so the bound holds whatever repeats.
    """
    marked = (
        labels.select(F.col("doc_id").alias("id"), F.col(label).cast("int").alias("label"))
        .filter(F.col("label").isin(0, 1) & F.col("id").isNotNull())
        .filter(~held_out("id"))
    )
    text = F.coalesce("text", F.lit(""))
    known = docs.select(F.col("doc_id").alias("id"), F.xxhash64(text).alias("print"))
    picked = known.join(marked, "id").distinct().orderBy(F.xxhash64("id"), "id", "label", "print").limit(rows)
    return (
        docs.select(F.col("doc_id").alias("id"), text.alias("text"), F.xxhash64(text).alias("print"))
        .join(F.broadcast(picked), ["id", "print"])
        .dropDuplicates(["id", "print", "label"])
        .select("id", "text", "label")
    )


def train(docs: DataFrame, labels: DataFrame, label: str = "quality", rows: int = SAMPLE_ROWS) -> Model:
    """The model of ``rows`` labelled rows at most. Their indicators, not their texts, come
    to the driver."""

    def features(batches):
        for batch in W.parts(batches):
            found = [f.astype(np.uint16).tobytes() for f in indicators(W.utf8(batch.column("text")))]
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("label"), pa.array(found, pa.binary())],
                names=["id", "label", "found"],
            )

    sample = training_rows(docs, labels, label, rows).mapInArrow(features, "id long, label int, found binary").toArrow()
    sample = sample.sort_by([("id", "ascending"), ("label", "ascending")])
    found = [np.frombuffer(b, dtype=np.uint16).astype(np.int64) for b in sample.column("found").to_pylist()]
    return fitted(found, np.array(sample.column("label").to_pylist(), dtype=np.int64))


def scored(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """``doc_id, held_out, score, predicted`` for each row of ``docs(doc_id, text, ...)``.

    The score (0 to 1, higher: label 1 likelier) depends on the whole text alone. Null and
    empty texts have no n-grams and get the score of the bias. Null and repeated ids are
    scored like others; a null id is not held out. Without labels of both kinds, all scores
    are the same. Other columns are ignored, whatever their names. An empty table gives no
    rows.
    """

    def run(batches):
        for batch in W.parts(batches):
            score = model.scores(W.utf8(batch.column("text")))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(score)], names=["doc_id", "score"])

    return (
        docs.select(F.col("doc_id").cast("long"), "text")
        .mapInArrow(run, "doc_id long, score double")
        .select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))
    )


def drop_rejected(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` without the rows the classifier rejects; columns as they are."""
    model = train(docs, labels)
    names = [F.col(f"`{c}`") for c in docs.columns]
    schema = docs.schema

    def run(batches):
        for batch in W.parts(batches):
            yield batch.filter(pa.array(model.scores(W.utf8(batch.column("text"))) >= threshold))

    return docs.mapInArrow(run, schema).select(*names)
