"""Language identification by multilingual mixture inference.

Each language has a model of hashed byte 4-grams. A text is cut into short segments, each
written in one language; expectation-maximisation estimates the document's language
proportions from the segments' n-gram likelihoods. The language set is the one of the nested sets
of the most likely languages with the best likelihood less a penalty for every further language.

Models learn from about ``DOCS_PER_LANGUAGE`` documents of each language, taken by hash of the
id. The number of languages has to be moderate, since every language is a column of a table.

Defined results: null texts and texts without any letter are ``und`` with score 0; so is all
where nothing could be learned; ties go to the language first in order of code points; repeated
rows are scored alike; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession, functions as F

from headway.llm.common import batch_of, blocks, fold, mapped, sample_per_class
from headway.llm.grams import hashed, joined

DOCS_PER_LANGUAGE = 1500
BITS = 16
N = 4
SEGMENT = 32
ROUNDS = 12
#: Log-likelihood a further language has to gain, times the logarithm of the number of segments.
PENALTY = 3.0
UNKNOWN = "und"
LETTER = regex.compile(r"\p{L}").search


class Model(NamedTuple):
    languages: list[str]
    log_p: np.ndarray  # 4-gram by language, each already divided by N since 4-grams overlap


def learn(docs: DataFrame, per_language: int = DOCS_PER_LANGUAGE) -> Model:
    """Models from ``docs(doc_id, text, lang)``."""
    # Narrow rows are sampled first; only then are texts read.
    schema = pa.schema([("lang", pa.string()), ("gram", pa.int32()), ("n", pa.int64())])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[str, np.ndarray] = {}
        for batch, texts in blocks(batches):
            buffer, starts, ends = joined([t.lower() for t in texts], N)
            grams = hashed(buffer, N, BITS)
            for lang, a, b in zip(batch.column("lang").to_pylist(), starts, ends):
                total = totals.setdefault(lang, np.zeros(1 << BITS, dtype=np.int64))
                total += np.bincount(grams[a:b], minlength=1 << BITS)
        for lang, total in totals.items():
            found = np.flatnonzero(total)
            yield batch_of(schema, lang=[lang] * len(found), gram=found, n=total[found])

    taken = sample_per_class(docs.where(F.col("text").isNotNull()).select("doc_id", "text", "lang"), "lang", "doc_id", per_language)
    counts = (
        mapped(taken.select("text", "lang"), count, "lang string, gram int, n long")
        .groupBy("lang", "gram").agg(F.sum("n").alias("n")).toPandas()
    )
    languages = sorted(counts["lang"].unique())
    table = np.full((1 << BITS, len(languages)), 0.5)
    index = {lang: i for i, lang in enumerate(languages)}
    table[counts["gram"].to_numpy(np.int64), counts["lang"].map(index).to_numpy(np.int64)] += counts["n"].to_numpy(float)
    log_p = np.log(table / table.sum(axis=0)) / N
    return Model(languages, log_p.astype(np.float32))


def _shares(
    likelihood: np.ndarray, weight: np.ndarray, first: np.ndarray, size: np.ndarray, allowed: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """Proportions and log-likelihood per document, by expectation-maximisation over its segments.

    ``likelihood``: segment by language, scaled to a maximum of 1; ``weight``: length of each segment;
    ``first``, ``size``: of the segments of each document; ``allowed``: document by language.
    """
    share = allowed / allowed.sum(axis=1, keepdims=True)
    for _ in range(ROUNDS):
        joint = np.repeat(share, size, axis=0) * likelihood
        total = joint.sum(axis=1, keepdims=True)
        share = np.add.reduceat(joint * (weight[:, None] / np.maximum(total, 1e-300)), first, axis=0)
        share /= np.maximum(share.sum(axis=1, keepdims=True), 1e-300)
    joint = (np.repeat(share, size, axis=0) * likelihood).sum(axis=1)
    return share, np.add.reduceat(np.log(np.maximum(joint, 1e-300)), first)


def infer(texts: list[str], model: Model) -> tuple[np.ndarray, np.ndarray]:
    """For each text (one byte at least) its proportions over all languages, zero outside the chosen set, and the
    mean posterior of its main language."""
    buffer, starts, ends = joined([t.lower() for t in texts], N)
    grams = hashed(buffer, N, BITS)
    size = (ends - starts + SEGMENT - 1) // SEGMENT
    first = np.concatenate(([0], np.cumsum(size)[:-1]))
    segment = np.arange(size.sum()) - np.repeat(first, size)
    cut = np.repeat(starts, size) + segment * SEGMENT
    weight = np.minimum(np.repeat(ends, size) - cut, SEGMENT).astype(float)
    # The zeros between texts belong to the last segment of a text; their weight is nought.
    inside = np.zeros(len(buffer), dtype=bool)
    inside[np.concatenate([np.arange(a, b) for a, b in zip(starts, ends)])] = True
    log_l = np.add.reduceat(model.log_p[grams] * inside[:, None], cut, axis=0).astype(np.float64)
    likelihood = np.exp(np.maximum(log_l - log_l.max(axis=1, keepdims=True), -600))
    languages = len(model.languages)
    full, _ = _shares(likelihood, weight, first, size, np.ones((len(texts), languages)))
    # By falling proportion; equal ones in the order of the languages.
    rank = np.argsort(np.argsort(-full, axis=1, kind="stable"), axis=1, kind="stable")
    best, chosen = np.full(len(texts), -np.inf), np.zeros_like(full)
    live = np.arange(len(texts))
    for k in range(1, languages + 1):
        rows = np.flatnonzero(np.repeat(np.isin(np.arange(len(texts)), live), size))
        own = size[live]
        share, fit = _shares(likelihood[rows], weight[rows], np.cumsum(own) - own, own, (rank[live] < k).astype(float))
        fit = fit - PENALTY * (k - 1) * np.log1p(own)
        better = fit > best[live]
        best[live[better]], chosen[live[better]] = fit[better], share[better]
        # No likelihood is over 1, so no larger set of a text fits better than its penalty lets it.
        live = live[best[live] < -PENALTY * k * np.log1p(own)]
        if not len(live):
            break
    # How sure: with a little of every language left in, the posterior of the main one.
    soft = 0.9 * chosen + 0.1 / languages
    joint = np.repeat(soft, size, axis=0) * likelihood
    joint /= joint.sum(axis=1, keepdims=True)
    mean = np.add.reduceat(joint * weight[:, None], first, axis=0) / (ends - starts)[:, None]
    return chosen, mean[np.arange(len(texts)), chosen.argmax(axis=1)]


FOUND = pa.schema(
    [("doc_id", pa.int64()), ("lang_pred", pa.string()), ("score", pa.float64()),
     ("languages", pa.list_(pa.string())), ("shares", pa.list_(pa.float64()))]
)


def identify(docs: DataFrame, model: Model) -> DataFrame:
    """``doc_id, lang_pred, score, languages, shares`` of every whole text: main language, certainty, language set."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = sent.value
        for batch, texts in blocks(batches):
            known = [i for i, t in enumerate(texts) if m.languages and LETTER(t)]
            name, score = [UNKNOWN] * len(texts), [0.0] * len(texts)
            sets: list[list[str]] = [[] for _ in texts]
            shares: list[list[float]] = [[] for _ in texts]
            if known:
                proportions, sure = infer([texts[i] for i in known], m)
                for i, p, s in zip(known, proportions, sure):
                    order = np.argsort(-p, kind="stable")
                    order = order[p[order] > 0]
                    name[i], score[i] = m.languages[order[0]], float(min(max(s, 0.0), 1.0))
                    sets[i], shares[i] = [m.languages[j] for j in order], p[order].tolist()
            yield batch_of(FOUND, doc_id=batch.column("doc_id"), lang_pred=name, score=score, languages=sets, shares=shares)

    return mapped(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), run, "doc_id long, lang_pred string, score double, languages array<string>, shares array<double>"
    )


def op6_language_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of all documents; rows with crc32 mod 3 of 1 are held out."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    held_out = fold(F.col("doc_id"), 3) == 1
    found = identify(docs, learn(docs.where(~held_out)))
    return found.select("doc_id", held_out.alias("held_out"), "lang_pred", "score", "languages", "shares")
