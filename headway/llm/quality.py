"""Quality classifier: naive Bayes support vectors.

Features are indicators of hashed n-grams: byte 4-grams, and n-grams of word shapes (length,
capitals, digits, signs, repetition). Each indicator is scaled by its class log-count ratio, and
a linear hinge-loss model is fitted to the scaled rows by dual coordinate descent. Margins become
probabilities by a logistic curve fitted to cross-fitted margins.

The model learns from a sample of labelled rows of about ``SAMPLE_PER_CLASS`` of each class, taken by hash of
the id; all else covers every row and every whole text.

Defined results: null and empty texts have no n-grams and get the score of the bias; null ids count
as empty text for the fold and are scored like others; rows without label teach nothing; with
labels of one class only, or none, the score is that share, or 0.5; repeated rows are scored alike;
other columns are ignored. Of several labels of one document the largest holds.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from headway.llm.common import batch_of, blocks, fold, mapped, sample_per_class
from headway.llm.grams import hashed, joined, word_shapes

SAMPLE_PER_CLASS = 1500
BYTE_BITS = 18
SHAPE_BITS = 15
WIDTH = (1 << BYTE_BITS) + 4 * (1 << SHAPE_BITS)
PAD = 8


class Model(NamedTuple):
    weight: np.ndarray  # log-count ratio times fitted weight, by feature
    square: np.ndarray  # square of the log-count ratio
    bias: float
    slope: float
    shift: float


def features(texts: list[str]) -> Iterator[np.ndarray]:
    """For each text the distinct features it has."""
    buffer, starts, ends = joined(texts, PAD)
    grams = hashed(buffer, 4, BYTE_BITS)
    begin, shapes = word_shapes(buffer)
    first, last = np.searchsorted(begin, starts), np.searchsorted(begin, ends)
    # Shapes of each text, followed by zeros, so that no n-gram spans two texts.
    place = np.arange(len(begin)) + 8 * np.repeat(np.arange(len(texts)), last - first)
    padded = np.zeros(len(begin) + 8 * len(texts), dtype=np.uint8)
    padded[place] = shapes
    same = (padded >= 97).astype(np.uint8) + (padded > 0)
    families = [
        hashed(codes, n, SHAPE_BITS, seed=k) + np.uint32((1 << BYTE_BITS) + k * (1 << SHAPE_BITS))
        for k, (codes, n) in enumerate(((padded, 1), (padded, 2), (padded, 3), (same, 6)))
    ]
    seen = np.zeros(WIDTH, dtype=np.int32)
    for i, (a, b) in enumerate(zip(starts, ends)):
        c, d = first[i] + 8 * i, last[i] + 8 * i
        found = np.concatenate([grams[a:b], *(f[c:d] for f in families)])
        order = np.arange(len(found), dtype=np.int32)
        seen[found] = order  # of equal features the last one stays
        yield found[seen[found] == order]


def log_count_ratio(rows: list[np.ndarray], y: np.ndarray) -> np.ndarray:
    """log of the smoothed share of each feature in class 1 over that in class 0."""
    counts = np.ones((2, WIDTH))
    for row, label in zip(rows, y):
        counts[int(label), row] += 1
    counts /= counts.sum(axis=1, keepdims=True)
    return np.log(counts[1] / counts[0])


def dual_descent(
    rows: list[np.ndarray], values: list[np.ndarray], y: np.ndarray, cost: np.ndarray, rounds: int = 30, seed: int = 7
) -> tuple[np.ndarray, float]:
    """Weights and bias that minimise half the squared norm plus the sum of cost times hinge loss.

    One dual variable per row, solved in turn in random order; the bias is one more weight.
    """
    sign = np.where(y > 0, 1.0, -1.0)
    w, bias, alpha = np.zeros(WIDTH), 0.0, np.zeros(len(y))
    norm = np.array([float(v @ v) + 1.0 for v in values])
    order = np.random.default_rng(seed)
    for _ in range(rounds):
        moved = 0.0
        for i in order.permutation(len(y)):
            gradient = sign[i] * (w[rows[i]] @ values[i] + bias) - 1.0
            new = min(max(alpha[i] - gradient / norm[i], 0.0), cost[i])
            step = (new - alpha[i]) * sign[i]
            if step:
                w[rows[i]] += step * values[i]
                bias += step
                moved = max(moved, abs(step))
                alpha[i] = new
        if moved < 1e-3:
            break
    return w, bias


def logistic(margin: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[float, float]:
    """Slope and shift of the curve that turns margins into probabilities, by Newton's method."""
    x = np.column_stack((margin, np.ones(len(margin))))
    beta = np.array([1.0, 0.0])
    # Slightly softened targets keep the slope finite for classes that margins separate.
    target = np.where(y > 0, 1 - 1 / (2 + (y > 0).sum()), 1 / (2 + (y == 0).sum()))
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        h = (x * (weight * p * (1 - p) + 1e-9)[:, None]).T @ x + 1e-6 * np.eye(2)
        step = np.linalg.solve(h, x.T @ (weight * (target - p)))
        size = np.abs(step).max()
        beta = beta + step * min(1.0, 5.0 / max(size, 1e-12))
        if size < 1e-8:
            break
    return float(max(beta[0], 0.0)), float(beta[1])


def _fitted(rows: list[np.ndarray], y: np.ndarray, cost: np.ndarray) -> tuple[np.ndarray, np.ndarray, float]:
    ratio = log_count_ratio(rows, y)
    values = [ratio[r] / max(np.linalg.norm(ratio[r]), 1e-12) for r in rows]
    w, bias = dual_descent(rows, values, y, cost)
    return ratio * w, ratio**2, bias


def _margins(rows: list[np.ndarray], weight: np.ndarray, square: np.ndarray, bias: float) -> np.ndarray:
    return np.array([weight[r].sum() / max(np.sqrt(square[r].sum()), 1e-12) + bias for r in rows])


def fit(rows: list[np.ndarray], y: np.ndarray, share: float, folds: int = 3) -> Model:
    """``share``: of label 1 among all labelled rows, to which probabilities are calibrated."""
    if len(set(y.tolist())) < 2:
        p = min(max(share, 1e-6), 1 - 1e-6) if len(y) else 0.5
        return Model(np.zeros(WIDTH, np.float32), np.zeros(WIDTH, np.float32), 0.0, 0.0, float(np.log(p / (1 - p))))
    cost = np.where(y > 0, 0.5 / y.mean(), 0.5 / (1 - y.mean()))
    margin = np.zeros(len(y))
    for k in range(folds):
        out = np.arange(len(y)) % folds == k
        if len(set(y[~out].tolist())) < 2:
            out[:] = False
        inner = [r for r, o in zip(rows, out) if not o]
        part = _fitted(inner, y[~out], cost[~out])
        held = out if out.any() else np.arange(len(y)) % folds == k
        margin[held] = _margins([r for r, o in zip(rows, held) if o], *part)
    weight = np.where(y > 0, share / y.mean(), (1 - share) / (1 - y.mean()))
    slope, shift = logistic(margin, y, weight)
    weight_, square, bias = _fitted(rows, y, cost)
    return Model(weight_.astype(np.float32), square.astype(np.float32), bias, slope, shift)


def learn(docs: DataFrame, labels: DataFrame, per_class: int = SAMPLE_PER_CLASS) -> Model:
    """Fit to a bounded sample of ``docs(doc_id, text)`` with ``labels(doc_id, label)``."""
    truth = (
        labels.where(F.col("doc_id").isNotNull() & F.col("label").isin(0, 1))
        .groupBy("doc_id").agg(F.max("label").alias("label"))
    )
    counts = {r["label"]: r["n"] for r in truth.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    total = sum(counts.values())
    taken = sample_per_class(truth, "label", "doc_id", per_class)
    rows = docs.select("doc_id", "text").join(F.broadcast(taken), "doc_id")  # about 2 * per_class narrow rows
    schema = pa.schema([("doc_id", pa.int64()), ("label", pa.int32()), ("found", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in blocks(batches):
            yield batch_of(
                schema, doc_id=batch.column("doc_id"), label=batch.column("label"),
                found=[f.astype(np.int32).tobytes() for f in features(texts)],
            )

    found = mapped(rows.select("doc_id", "text", F.col("label").cast("int").alias("label")), run, "doc_id long, label int, found binary"
    )
    got = sorted({(r["doc_id"], r["label"], bytes(r["found"])) for r in found.toLocalIterator(True)})
    x = [np.frombuffer(f, dtype=np.int32) for _, _, f in got]
    y = np.array([label for _, label, _ in got], dtype=np.int64)
    return fit(x, y, counts.get(1, 0) / total if total else 0.5)


SCORED = pa.schema([("doc_id", pa.int64()), ("score", pa.float64())])


def score(docs: DataFrame, model: Model) -> DataFrame:
    """``doc_id, score``: the probability of label 1, for every row."""
    sent = docs.sparkSession.sparkContext.broadcast(model)  # two arrays of WIDTH numbers

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = sent.value
        for batch, texts in blocks(batches):
            margin = _margins(list(features(texts)), m.weight, m.square, m.bias)
            p = 1 / (1 + np.exp(-np.clip(m.slope * margin + m.shift, -50, 50)))
            yield batch_of(SCORED, doc_id=batch.column("doc_id"), score=p)

    return mapped(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), run, "doc_id long, score double")


def op10_nbsvm_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Score all documents for quality; rows with crc32 mod 5 of 0 are held out."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", F.col("quality").alias("label"))
    model = learn(docs, labels.where(fold(F.col("doc_id"), 5) != 0))
    return score(docs, model).select(
        "doc_id", (fold(F.col("doc_id"), 5) == 0).alias("held_out"), "score",
        (F.col("score") >= 0.3).cast("int").alias("predicted"),
    )
