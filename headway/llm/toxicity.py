"""Toxicity by compression distance.

Two zstandard dictionaries are trained, one on ordinary text and one on toxic text. Labels
mark whole documents while toxic language sits in a few words, so the toxic samples are made of the
words whose document frequency in toxic documents is far above that in ordinary ones. A text is
cut at white space into windows of up to ``WINDOW`` bytes; each is compressed with the ordinary
dictionary alone and with both. Where toxic passages occur, the second length is shorter. How much shorter
the windows get (most, mean, share over a threshold) becomes a probability by a logistic curve
fitted to labelled documents the dictionaries have not seen.

Dictionaries and curve learn from about ``SAMPLE_PER_CLASS`` labelled documents of each class, taken by
hash of the id: one half for the dictionaries, one for the curve. Scoring covers every window of every text.

Defined results: null and empty texts count as one empty window; null ids are scored like others;
rows without label teach nothing; with labels of one class only the score is that share, without
any it is 0; repeated rows are scored alike; other columns are ignored. Of several labels of one
document the largest holds.
"""

from __future__ import annotations

import random
import re
import zlib
from collections import Counter
from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession, functions as F

from headway.llm.common import batch_of, blocks, fold, mapped, sample_per_class

SAMPLE_PER_CLASS = 1500
WINDOW = 128
LEVEL = 13
ORDINARY_BYTES = 32768
TOXIC_BYTES = 4096
#: Windows that got shorter by this many bytes are counted.
STEPS = (2, 3, 5)
CUT = re.compile(rb"(?s)\S.{0,%d}(?=\s|\Z)|\S{1,%d}" % (WINDOW - 1, WINDOW)).findall


class Model(NamedTuple):
    ordinary: bytes
    toxic: bytes
    centre: np.ndarray
    scale: np.ndarray
    weight: np.ndarray  # the last one is the bias


def _trained(samples: list[bytes], size: int, segment: int) -> bytes:
    """A dictionary of the samples; samples too few to train on are used as they are."""
    try:
        return zstandard.train_dictionary(size, samples, k=segment, d=6, level=3).as_bytes()
    except zstandard.ZstdError:
        return b" ".join(samples)[:size]


def _unlike(texts: list[str]) -> list[str]:
    """The texts without near copies of earlier ones, so that no family of copies speaks for its class.

    A text goes if one of eight bands of four least hashes over its longer words has been seen.
    """
    factor = np.random.default_rng(3).integers(0, 1 << 32, 32, dtype=np.uint64) | np.uint64(1)
    seen: set[tuple[int, ...]] = set()
    out = []
    for t in texts:
        words = np.array([zlib.crc32(w.encode()) for w in set(t.lower().split()) if len(w) > 5], dtype=np.uint64)
        least = ((words[:, None] * factor) % np.uint64(0xFFFFFFFB)).min(axis=0).tolist() if len(words) else []
        bands = {(k, *least[k : k + 4]) for k in range(0, len(least), 4)}
        if not bands & seen:
            out.append(t)
        seen |= bands
    return out


def _words(texts: list[str]) -> Counter:
    return Counter(w for t in texts for w in set(t.lower().split()))


def dictionaries(toxic: list[str], ordinary: list[str], seed: int = 11) -> tuple[bytes, bytes]:
    """The ordinary and the toxic dictionary."""
    chance = random.Random(seed)
    toxic, ordinary = _unlike(toxic), _unlike(ordinary)
    here, there = _words(toxic), _words(ordinary)

    def odds(word: str) -> float:
        return float(np.log((here[word] + 0.5) / (len(toxic) + 1)) - np.log((there[word] + 0.5) / (len(ordinary) + 1)))

    least = max(2, len(toxic) // 100)
    marked = sorted(w for w in here if here[w] >= least and odds(w) > 3.0)
    marked = marked or sorted(w for w in here if odds(w) > 0)
    bag = [w for w in marked for _ in range(here[w])]
    spoken = [(" " + " ".join(chance.choices(bag, k=6)) + " ").encode() for _ in range(4000)] if bag else []
    plain = [w for t in ordinary for w in CUT(t.lower().encode())]
    chance.shuffle(plain)
    return _trained(plain[:40000], ORDINARY_BYTES, 64), _trained(spoken, TOXIC_BYTES, 32)


class Measure:
    """How much shorter each window of a text gets with the toxic dictionary."""

    def __init__(self, ordinary: bytes, toxic: bytes):
        settings = zstandard.ZstdCompressionParameters.from_level(
            LEVEL, min_match=3, write_content_size=False, write_checksum=False, write_dict_id=False
        )

        def compressor(content: bytes) -> zstandard.ZstdCompressor:
            if len(content) < 8:
                return zstandard.ZstdCompressor(compression_params=settings)
            words = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            words.precompute_compress(compression_params=settings)
            return zstandard.ZstdCompressor(dict_data=words, compression_params=settings)

        # Ordinary text comes last in both, at the same distances, so that it counts alike.
        self.plain, self.both = compressor(ordinary).compress, compressor(toxic + ordinary).compress

    def shorter(self, text: str) -> np.ndarray:
        windows = CUT(text.lower().encode()) or [b""]
        plain, both = self.plain, self.both
        return np.array([len(plain(w)) - len(both(w)) for w in windows])

    def features(self, text: str) -> np.ndarray:
        gain = self.shorter(text)
        top = np.sort(gain)[-3:]
        counts = [(gain >= s).sum() for s in STEPS]
        return np.array(
            [gain.max(), top.mean(), gain.mean(), *(c / len(gain) for c in counts), *np.log1p(counts), np.log(len(gain))],
            dtype=float,
        )


def _curve(x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float = 0.1) -> np.ndarray:
    """Logistic regression by Newton's method; the bias is not shrunk."""
    x = np.column_stack((x, np.ones(len(x))))
    beta = np.zeros(x.shape[1])
    shrink = np.full(x.shape[1], ridge)
    shrink[-1] = 1e-6
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        h = (x * (weight * p * (1 - p) + 1e-9)[:, None]).T @ x + np.diag(shrink)
        step = np.linalg.solve(h, x.T @ (weight * (y - p)) - shrink * beta)
        beta = beta + step * min(1.0, 3.0 / max(float(np.abs(step).max()), 1e-12))
        if np.abs(step).max() < 1e-7:
            break
    return beta


def fit(rows: list[tuple[str, int]], share: float) -> Model:
    """``rows``: texts with labels; ``share``: of label 1 among all labelled rows."""
    toxic, ordinary = [t for t, y in rows if y == 1], [t for t, y in rows if y == 0]
    size = len(Measure(b"", b"").features(""))
    if len(toxic) < 2 or len(ordinary) < 2:
        p = min(max(share, 1e-9), 1 - 1e-9)
        return Model(b"", b"", np.zeros(size), np.ones(size), np.array([0.0] * size + [np.log(p / (1 - p))]))
    pair = dictionaries(toxic[0::2], ordinary[0::2])
    measure = Measure(*pair)
    held = [(t, 1) for t in toxic[1::2]] + [(t, 0) for t in ordinary[1::2]]
    x = np.array([measure.features(t) for t, _ in held])
    y = np.array([label for _, label in held], dtype=float)
    centre, scale = x.mean(axis=0), x.std(axis=0) + 1e-6
    weight = np.where(y > 0, share / y.mean(), (1 - share) / (1 - y.mean()))
    return Model(*pair, centre, scale, _curve((x - centre) / scale, y, weight))


def learn(docs: DataFrame, labels: DataFrame, per_class: int = SAMPLE_PER_CLASS) -> Model:
    """Fit to a bounded sample of ``docs(doc_id, text)`` with ``labels(doc_id, label)``."""
    truth = (
        labels.where(F.col("doc_id").isNotNull() & F.col("label").isin(0, 1))
        .groupBy("doc_id").agg(F.max("label").alias("label"))
    )
    counts = {r["label"]: r["n"] for r in truth.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    taken = sample_per_class(truth, "label", "doc_id", per_class)
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).join(F.broadcast(taken), "doc_id")  # about 2 * per_class narrow rows
    # Equal texts teach once; the order does not depend on how the rows came in.
    got = sorted({(r["text"], int(r["label"])) for r in rows.select("text", "label").toLocalIterator(True)})
    random.Random(5).shuffle(got)
    return fit(got, counts.get(1, 0) / max(1, sum(counts.values())))


def scorer(m: Model) -> Callable[[list[str]], np.ndarray]:
    measure = Measure(m.ordinary, m.toxic)

    def scores(texts: list[str]) -> np.ndarray:
        x = np.array([measure.features(t) for t in texts])
        z = ((x - m.centre) / m.scale) @ m.weight[:-1] + m.weight[-1]
        return 1 / (1 + np.exp(-np.clip(z, -50, 50)))

    return scores


SCORED = pa.schema([("doc_id", pa.int64()), ("score", pa.float64())])


def score(docs: DataFrame, model: Model) -> DataFrame:
    """``doc_id, score`` of every row: the probability that it is toxic."""
    sent = docs.sparkSession.sparkContext.broadcast(model)  # two dictionaries of fixed size and a few numbers

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scores = scorer(sent.value)
        for batch, texts in blocks(batches):
            yield batch_of(SCORED, doc_id=batch.column("doc_id"), score=scores(texts))

    return mapped(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), run, "doc_id long, score double")


def below(docs: DataFrame, model: Model, limit: float) -> DataFrame:
    """The rows, with all their columns, whose score is under the limit."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scores = scorer(sent.value)
        for batch, texts in blocks(batches):
            yield batch.filter(pa.array(scores(texts) < limit))

    return mapped(docs, run, docs.schema)


def taught(spark: SparkSession, docs: DataFrame, sf_dir: str) -> Model:
    """The model of all labelled documents but those held out."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", F.col("toxic").alias("label"))
    return learn(docs, labels.where(fold(F.col("doc_id"), 5) != 0))


def op9_zstd_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Score all documents for toxicity; rows with crc32 mod 5 of 0 are held out."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return score(docs, taught(spark, docs, sf_dir)).select(
        "doc_id", (fold(F.col("doc_id"), 5) == 0).alias("held_out"), "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )
