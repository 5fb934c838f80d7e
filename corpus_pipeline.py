"""The training-data pipeline: each stage works on all that the one before it kept.

1. toxicity: documents scored 0.5 or more go.
2. near copies: one document of each class of the n-gram Jaccard join stays.
3. decontamination: documents that overlap with a benchmark item go.
4. personal data: spans are replaced by their kinds, ``n_chars`` follows.
5. tokens: byte-level BPE ids, and a checksum of the bytes they decode to.

Stages keep rows they cannot judge (null ids, null texts). Extra columns pass through all but the last stage.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from headway.llm import bpe, copies, leaks, personal, toxicity
from headway.session import staged

TOXIC_FROM = 0.5


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Labels teach with the documents at hand; rows held out by the labels' rule teach nothing."""
    return toxicity.below(docs, toxicity.taught(spark, docs, sf_dir), TOXIC_FROM)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return copies.one_of_each(docs)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return leaks.without_overlaps(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mask_personal(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return personal.redact(docs, personal.learn(docs))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    done = bpe.round_trip(docs, path, public_tokenizers.PATTERN)
    return done.select(
        "doc_id", "ids", F.size("ids").cast("long").alias("n_tokens"), F.sha2("decoded", 256).alias("decoded_sha256")
    )


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", drop_toxic), ("near_copies", drop_copies), ("decontamination", drop_leaks),
    ("personal_data", mask_personal), ("tokens", tokens),
]

#: No stage can be written as SQL; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over all documents; each stage's rows are written to the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = staged(docs)
    return docs
