"""Benchmark decontamination with spaced seeds.

A seed is a fixed mask over consecutive tokens; tokens under its zeros are ignored. Masked windows
of benchmark items are hashed into a table; masked windows of every document are looked up in it.
Where the hashes meet, item and document are laid over one another at that offset. Of an item of at most
``SHORT`` tokens all that agree there count; of a longer one those in the longest of the best runs of tokens in which
agreeing tokens outweigh differing ones. It is an overlap if enough tokens agree.

Items of at most ``SHORT`` tokens are cut into one seed more than tokens may differ, so that whichever
differ, one seed is whole: every overlap of theirs is found. Longer items have the masks at every offset and a seed for
every three tokens in a row, so that a run of at most 18 tokens of which 13 agree is always found; a longer one usually.

The benchmark is taken in blocks of at most about ``BLOCK_TOKENS`` tokens, so that a table of bounded size
goes to every task; a larger benchmark means more passes, never fewer items.

Tokens are runs of letters, digits and underscores of the lower-cased text, in scripts without blanks single characters.
Items under ``LEAST_TOKENS`` tokens name nothing inside a text; they overlap with texts that have just their tokens.

Defined results: null or empty texts overlap with nothing; null ids are reported as null; repeated rows are
reported for each row; an empty benchmark gives no overlaps; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from typing import Any

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from headway.llm.common import batch_of, blocks, mapped
from headway.llm.words import WORD_BYTES, run_hashes, separated, word_hashes

#: Fixed masks: 1 counts, 0 is ignored.
MASKS = ("11101001110", "11010110101", "10111100111", "11111111000", "111")
#: Items of so many tokens at most are found whatever tokens differ.
SHORT = 20
LEAST_TOKENS = 5
#: Agreeing tokens that make an overlap of a long item; shorter items need ``SHARE`` of theirs.
ENOUGH = 13
SHARE = 0.8
#: What a differing token costs against one that agrees.
PENALTY = 1.0
BLOCK_TOKENS = 400_000
#: Hits verified at once.
HITS = 1 << 18
_BITS = 20


class Table:
    """Masked hashes of benchmark items, and the items' tokens."""

    def __init__(self, items: list[tuple[int, str]], masks: tuple[str, ...] = MASKS):
        hashes, starts = word_hashes([separated(t.lower()) for _, t in items], WORD_BYTES)
        self.ids: list[int] = []
        self.tokens: list[np.ndarray] = []
        self.small: dict[bytes, list[int]] = {}
        self.seeds: dict[tuple[int, ...], int] = {}
        keys, owner, offset = [], [], []
        for (item, _), a, b in zip(items, starts, starts[1:]):
            tokens = hashes[a:b]
            if len(tokens) < LEAST_TOKENS:
                if len(tokens):
                    self.small.setdefault(tokens.tobytes(), []).append(item)
                continue
            self.ids.append(item)
            self.tokens.append(tokens)
            for places, at in short_seeds(len(tokens)) if len(tokens) <= SHORT else long_seeds(masks):
                seed = self.seeds.setdefault(places, len(self.seeds))
                found = run_hashes(tokens, places, seed) if at is None else run_hashes(tokens[at : at + places[-1] + 1], places, seed)
                keys.append(found)
                owner.append(np.full(len(found), len(self.ids) - 1))
                offset.append(np.arange(len(found)) + (at or 0))
        self.size = np.array([len(t) for t in self.tokens], dtype=np.int64)
        self.begin = np.cumsum(self.size) - self.size
        self.flat = np.concatenate(self.tokens) if self.tokens else np.zeros(0, np.uint64)
        self.needed = np.array([needed(n) for n in self.size.tolist()], dtype=np.int64)
        key = np.concatenate(keys) if keys else np.zeros(0, np.uint64)
        order = np.argsort(key, kind="stable")
        self.key = key[order]
        self.owner = np.concatenate(owner)[order] if owner else np.zeros(0, int)
        self.offset = np.concatenate(offset)[order] if offset else np.zeros(0, int)
        self.near = np.zeros(1 << _BITS, dtype=bool)
        self.near[(self.key >> np.uint64(64 - _BITS)).astype(np.int64)] = True

    def hits(self, hashes: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """For each seed: token positions, items and offsets whose masked hashes meet."""
        for places, seed in self.seeds.items():
            found = run_hashes(hashes, places, seed)
            at = np.flatnonzero(self.near[(found >> np.uint64(64 - _BITS)).astype(np.int64)])
            first = np.searchsorted(self.key, found[at], "left")
            last = np.searchsorted(self.key, found[at], "right")
            count = last - first
            if count.sum():
                rows = np.repeat(np.arange(len(at)), count)
                entry = np.arange(len(rows)) - np.repeat(np.cumsum(count) - count, count) + first[rows]
                yield at[rows], self.owner[entry], self.offset[entry]


def short_seeds(tokens: int) -> Iterator[tuple[tuple[int, ...], int]]:
    """Places and offsets of one seed more than tokens of an item may differ: of neighbours, without a gap or an overlap."""
    cuts = np.linspace(0, tokens, tokens - needed(tokens) + 2).round().astype(int).tolist()
    for a, b in zip(cuts, cuts[1:]):
        yield tuple(range(b - a)), a


def long_seeds(masks: tuple[str, ...]) -> Iterator[tuple[tuple[int, ...], None]]:
    """Places of the masks, for every offset."""
    for mask in masks:
        yield tuple(i for i, c in enumerate(mask) if c == "1"), None


def needed(tokens: int) -> int:
    return min(ENOUGH, max(int(np.ceil(SHARE * tokens)), min(tokens, 8)))


def best_run(same: np.ndarray) -> tuple[int, int, int]:
    """Begin, end and agreeing tokens of the run where agreement most outweighs difference."""
    total = np.concatenate(([0.0], np.cumsum(np.where(same, 1.0, -PENALTY))))
    low = np.minimum.accumulate(total)
    gain = total - low
    end = len(gain) - 1 - int(np.argmax(gain[::-1]))
    begin = int(np.argmin(total[: end + 1]))
    return begin, end, int(same[begin:end].sum())


def whole_run(same: np.ndarray) -> tuple[int, int, int]:
    """Begin and end of all that agrees, and how many tokens do."""
    at = np.flatnonzero(same)
    return (int(at[0]), int(at[-1]) + 1, len(at)) if len(at) else (0, 0, 0)


def _agreeing(hashes: np.ndarray, starts: np.ndarray, at: np.ndarray, owner: np.ndarray, place: np.ndarray, table: Table) -> np.ndarray:
    """Texts, items and places of the hits where as many tokens agree as an overlap needs; the others cannot be one."""
    out = []
    for k in range(0, len(at), HITS):
        # Seeds of the same item side by side name the same place.
        text = np.searchsorted(starts, at[k : k + HITS], "right") - 1
        rows = np.unique(np.stack((text, owner[k : k + HITS], place[k : k + HITS]), axis=1), axis=0)
        text, item, first = rows.T
        wanted, agree = table.needed[item], np.zeros(len(rows), np.int64)
        low, high, size = starts[text], starts[text + 1], table.size[item]
        going = np.arange(len(rows))
        for j in range(int(size.max(initial=0))):
            # Done: enough agree, or the item ends.
            going = going[(j < size[going]) & (agree[going] < wanted[going])]
            if not len(going):
                break
            p = first[going] + j
            inside = (p >= low[going]) & (p < high[going])
            same = hashes[np.clip(p, 0, len(hashes) - 1)] == table.flat[table.begin[item[going]] + j]
            agree[going] += inside & same
        out.append(rows[agree >= wanted])
    return np.concatenate(out) if out else np.zeros((0, 3), np.int64)


def overlaps(texts: list[str], table: Table) -> list[dict[int, tuple[int, int, int]]]:
    """For each text, by item: first and last token (exclusive) of the best overlap and how many tokens agree."""
    out: list[dict[int, tuple[int, int, int]]] = [{} for _ in texts]
    if not len(table.key) and not table.small:
        return out
    hashes, starts = word_hashes([separated(t.lower()) for t in texts], WORD_BYTES)
    for n in np.flatnonzero(np.diff(starts) < LEAST_TOKENS).tolist() if table.small else ():
        tokens = hashes[starts[n] : starts[n + 1]]
        out[n].update((item, (0, len(tokens), len(tokens))) for item in table.small.get(tokens.tobytes(), ()))
    found = [_agreeing(hashes, starts, at, owner, at - offset, table) for at, owner, offset in table.hits(hashes)]
    if not found:
        return out
    for n, owner, place in np.unique(np.concatenate(found), axis=0).tolist():
        item = table.tokens[owner]
        # Only where both have tokens; a window over two texts is cut to the one it begins in.
        a, b = max(place, int(starts[n])), min(place + len(item), int(starts[n + 1]))
        if b <= a:
            continue
        same = hashes[a:b] == item[a - place : b - place]
        begin, end, agree = whole_run(same) if len(item) <= SHORT else best_run(same)
        old = out[n].get(table.ids[owner], (0, 0, 0))
        if agree >= needed(len(item)) and agree > old[2]:
            first = a - int(starts[n])
            out[n][table.ids[owner]] = (first + begin, first + end, agree)
    return out


def tables(benchmark: DataFrame, block_tokens: int = BLOCK_TOKENS) -> Iterator[Table]:
    """The benchmark's items ``item_id, text`` in blocks of about ``block_tokens`` tokens."""
    items = benchmark.where(F.col("text").isNotNull()).select(F.col("item_id").cast("long").alias("item_id"), "text")
    # A token and the sign after it take two bytes at least.
    size = items.agg(F.sum(F.octet_length("text") / 2).alias("n")).first()["n"] or 0
    count = int(size // block_tokens) + 1
    part = F.pmod(F.xxhash64("item_id", "text"), F.lit(count))
    for k in range(count):
        rows = items.where(part == k) if count > 1 else items
        yield Table(sorted({(r["item_id"], r["text"]) for r in rows.toLocalIterator()}, key=str))


FOUND = pa.schema(
    [("doc_id", pa.int64()), ("item_id", pa.int64()), ("first_token", pa.int32()), ("end_token", pa.int32()), ("agreeing", pa.int32())]
)


def find_overlaps(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """A row for each document and item that overlap: ``doc_id, item_id, first_token, end_token, agreeing``."""

    def apply(rows: DataFrame, sent: Any) -> DataFrame:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch, texts in blocks(batches):
                ids = batch.column("doc_id").to_pylist()
                found = [(ids[n], item, *o) for n, by in enumerate(overlaps(texts, sent.value)) for item, o in sorted(by.items(), key=str)]
                columns = list(zip(*found)) or [()] * len(FOUND)
                yield batch_of(FOUND, **dict(zip(FOUND.names, map(list, columns))))

        narrow = rows.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
        return mapped(narrow, run, "doc_id long, item_id long, first_token int, end_token int, agreeing int")

    parts = (apply(docs, docs.sparkSession.sparkContext.broadcast(t)) for t in tables(benchmark))
    return reduce(DataFrame.unionByName, parts)


def without_overlaps(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows, with all their columns, that overlap with no benchmark item."""

    def apply(rows: DataFrame, sent: Any) -> DataFrame:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch, texts in blocks(batches):
                yield batch.filter(pa.array([not by for by in overlaps(texts, sent.value)]))

        return mapped(rows, run, rows.schema)

    for table in tables(benchmark):
        docs = apply(docs, docs.sparkSession.sparkContext.broadcast(table))
    return docs


def op1_spaced_seed_leaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Overlaps of all documents with all benchmark items."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return find_overlaps(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
