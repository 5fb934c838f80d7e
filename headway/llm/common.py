"""Helpers the operators share: cutting lineage, reading batches, sampling labelled rows."""

from __future__ import annotations

import os
from collections.abc import Callable, Iterator
from pathlib import Path
from typing import Any, NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from headway.session import run_folder

ROOT = str(Path(__file__).resolve().parents[2])
#: Bits, sent to every executor as bytes, that tell apart the keys of a join from others.
MOST_KEY_BITS = 1 << 24
#: Labels that sampling takes; there are as many models.
MOST_CLASSES = 1000
#: Bytes of text a task turns into arrays at once; bounds memory, never results.
BLOCK_CHARS = 1_000_000


def kept(df: DataFrame) -> DataFrame:
    """The same rows, computed once and written to the shared folder: lineage ends here."""
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(run_folder(df.sparkSession))
    return df.checkpoint()


def blocks(batches: Iterator[pa.RecordBatch], text: str = "text") -> Iterator[tuple[pa.RecordBatch, list[str]]]:
    """Runs of rows with at most ``BLOCK_CHARS`` bytes of text (one row at least), with their texts; null is empty."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_pylist()
        start = size = 0
        for i, n in enumerate(sizes):
            if i > start and size + n > BLOCK_CHARS:
                yield _run(batch.slice(start, i - start), text)
                start, size = i, 0
            size += n
        if sizes:
            yield _run(batch.slice(start), text)


def _run(rows: pa.RecordBatch, text: str) -> tuple[pa.RecordBatch, list[str]]:
    return rows, [t or "" for t in rows.column(text).to_pylist()]


def reach_workers(spark: SparkSession) -> None:
    """Let workers on this machine find this package wherever the session was started.

    On a cluster the package is shipped as usual (``--py-files``) or installed.
    """
    environment = spark.sparkContext.environment
    paths = environment.get("PYTHONPATH", "").split(os.pathsep)
    if ROOT not in paths:
        environment["PYTHONPATH"] = os.pathsep.join([ROOT, *filter(None, paths)])


def mapped(df: DataFrame, run: Callable, schema: Any) -> DataFrame:
    """``df.mapInArrow`` with this package in the workers' reach."""
    reach_workers(df.sparkSession)
    return df.mapInArrow(run, schema)


def batch_of(schema: pa.Schema, **columns: Any) -> pa.RecordBatch:
    """A record batch from arrays or lists, in the schema's order and types."""
    arrays = []
    for field in schema:
        x = columns[field.name]
        arrays.append(x if isinstance(x, pa.Array) else pa.array(x, type=field.type))
    return pa.RecordBatch.from_arrays(arrays, schema=schema)


class KeyBits(NamedTuple):
    """A bit set in which every key of a table has a bit; others may share one by chance."""

    size: int
    bits: np.ndarray

    def position(self, key: Column) -> Column:
        return F.pmod(F.xxhash64(key), F.lit(self.size))

    def hit(self, positions: pa.Array) -> pa.Array:
        return pa.array(self.bits[positions.to_numpy(zero_copy_only=False)])


def key_bits(keys: DataFrame, key: str, hashed: bool = True, at_once: bool = False) -> KeyBits:
    """The bit set of a column, of at most ``MOST_KEY_BITS`` bits however many keys there are.

    It spares most rows without such a key a shuffle. What it lets through must still be joined; with more
    keys it lets through more. Without ``hashed`` the key is a number whose remainder is its place. ``at_once``: brought
    over by one job, not partition by partition; there are ``MOST_KEY_BITS`` bits at most either way.
    """
    size = min(MOST_KEY_BITS, max(1 << 15, 1 << (16 * keys.count()).bit_length()))
    at = F.pmod(F.xxhash64(F.col(key)) if hashed else F.col(key), F.lit(size)) + 1
    parts = keys.groupBy(F.bitmap_bucket_number(at).alias("part")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(at)).alias("bits")
    )
    bits = np.zeros(size, dtype=bool)
    for r in parts.collect() if at_once else parts.toLocalIterator():
        row = np.unpackbits(np.frombuffer(r["bits"], dtype=np.uint8), bitorder="little")
        start = (r["part"] - 1) << 15
        bits[start : start + len(row)] = row[: size - start]
    return KeyBits(size, bits)


def fold(doc_id: Column, parts: int) -> Column:
    """The remainder of crc32 of the id as text: which rows are held out. A null id counts as empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % parts


def unit_hash(*columns: Column) -> Column:
    """A number in [0, 1) that depends on the columns alone."""
    return F.pmod(F.xxhash64(*columns), F.lit(1 << 40)) / F.lit(float(1 << 40))


def sample_per_class(rows: DataFrame, label: str, key: str, per_class: int) -> DataFrame:
    """About ``per_class`` rows of each label, all of them where there are fewer.

    A row is taken when the hash of its key lies below ``per_class / rows of its label``,
    so no class is ever gathered, sorted or shuffled. Null labels are left out; over ``MOST_CLASSES``
    labels are refused.
    """
    rows = rows.where(F.col(label).isNotNull())
    counts = rows.groupBy(label).agg(F.count(F.lit(1)).alias("n")).limit(MOST_CLASSES + 1).collect()
    if len(counts) > MOST_CLASSES:
        raise ValueError(f"over {MOST_CLASSES} labels in {label}")
    if not counts:
        return rows.limit(0)
    shares = F.create_map(*[F.lit(x) for r in counts for x in (r[label], float(per_class) / r["n"])])
    return rows.where(unit_hash(F.col(key), F.lit("sample")) < shares[F.col(label)])
