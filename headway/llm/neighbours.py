"""Approximate nearest neighbours by multi-index hashing.

Vectors become binary codes by rotations learned on a sample, so that signs of rotated coordinates say as
much as possible (iterative quantisation). Codes are split into substrings of eight bits, each with an
index from value to codes. Two codes within a Hamming radius agree up to a share of that radius
in at least one substring; probing every value within that share in every substring therefore
retrieves every code within the radius. Those are reranked by exact inner products.

Vectors are dealt to blocks by a hash of id and vector, so an id that many rows share is spread, and every block is indexed in the task that searches it; queries are dealt
to blocks too, and each pair of blocks is one unit of work. A unit returns the best of its
block for each of its queries. The radius is learned on the sample, for ``RECALL`` there; where a block
has fewer codes than neighbours wanted within it, the radius grows until there are enough. Nothing is
capped: all codes within the radius are reranked.

Largest inner product is turned into angle by one further coordinate that brings all candidates to one length.

Defined results: vectors that are null or zero, hold null or non-finite components, or have another
number of components than most, take no part, nor do null ids; rows with the query's id are not its neighbours; equal scores
go by id; repeated rows are candidates one by one (they travel as one with a number), and one query; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window as W, functions as F

from headway.llm.common import reach_workers, unit_hash

BITS = 256
SUB = 8
#: Vectors the rotations are learned on, and how many of them are queries for the radius.
SAMPLE, TRIES = 6000, 300
RECALL = 0.985
#: Numbers in a block of vectors or queries.
BLOCK_NUMBERS = 1 << 20

POPCOUNT = np.array([bin(i).count("1") for i in range(256)], dtype=np.int64)
DISTANCE = POPCOUNT[np.arange(256)[:, None] ^ np.arange(256)[None, :]]


class Coder(NamedTuple):
    length: float  # of the longest vector
    centre: np.ndarray
    rotation: np.ndarray
    radius: int

    def candidates(self, x: np.ndarray) -> np.ndarray:
        x = x / self.length
        rest = np.sqrt(np.maximum(0.0, 1.0 - (x * x).sum(axis=1, keepdims=True)))
        return self._codes(np.concatenate((x, rest), axis=1))

    def queries(self, x: np.ndarray) -> np.ndarray:
        x = x / np.linalg.norm(x, axis=1, keepdims=True)
        return self._codes(np.concatenate((x, np.zeros((len(x), 1))), axis=1))

    def _codes(self, x: np.ndarray) -> np.ndarray:
        """Codes as bytes, a byte for each substring."""
        return np.packbits((x - self.centre) @ self.rotation > 0, axis=1)


def learn(x: np.ndarray, length: float, k: int, bits: int = BITS, recall: float = RECALL, seed: int = 3) -> Coder:
    """Rotations by iterative quantisation, each from another start; the radius by true neighbours in the sample."""
    chance = np.random.default_rng(seed)
    whole = np.concatenate((x / length, np.sqrt(np.maximum(0.0, 1.0 - ((x / length) ** 2).sum(axis=1, keepdims=True)))), axis=1)
    centre = whole.mean(axis=0)
    moved = whole - centre
    d = whole.shape[1]
    parts = []
    for _ in range(-(-bits // d)):
        r = np.linalg.qr(chance.normal(size=(d, d)))[0]
        for _ in range(20):
            u, _, vt = np.linalg.svd(moved.T @ np.sign(moved @ r))
            r = u @ vt
        parts.append(r)
    coder = Coder(length, centre, np.concatenate(parts, axis=1)[:, :bits], bits)
    tries = min(TRIES, len(x))
    if len(x) <= k + 1:
        return coder
    score = x[:tries] @ x.T
    score[np.arange(tries), np.arange(tries)] = -np.inf
    near = np.argpartition(-score, k, axis=1)[:, :k]
    code, query = coder.candidates(x), coder.queries(x[:tries])
    away = POPCOUNT[query[:, None, :] ^ code[near]].sum(axis=2)
    return coder._replace(radius=int(np.quantile(away, recall)))


class Index:
    """A block of codes: for each substring and value a bit set of the codes that have it there."""

    def __init__(self, codes: np.ndarray):
        self.codes = codes
        rows, subs = codes.shape
        self.width = -(-rows // 8)
        self.sets = np.zeros((subs, 256, self.width), dtype=np.uint8)
        bit = (128 >> (np.arange(rows) % 8)).astype(np.uint8)
        for s in range(subs):
            np.bitwise_or.at(self.sets[s], (codes[:, s], np.arange(rows) // 8), bit)
        self.balls: dict[tuple[int, int, int], np.ndarray] = {}

    def _ball(self, sub: int, value: int, share: int) -> np.ndarray:
        key = (sub, value, share)
        if key not in self.balls:
            self.balls[key] = np.bitwise_or.reduce(self.sets[sub][DISTANCE[value] <= share], axis=0)
        return self.balls[key]

    def within(self, query: np.ndarray, radius: int) -> np.ndarray:
        """All rows whose code lies within ``radius`` of the query's."""
        rows, subs = self.codes.shape
        share, rest = divmod(radius, subs)
        found = np.zeros(self.width, dtype=np.uint8)
        for s, value in enumerate(query.tolist()):
            # If no substring kept to its share, the distances would add up to more than the radius.
            own = share if s <= rest else share - 1
            if own >= 0:
                found |= self._ball(s, value, min(own, SUB))
        some = np.flatnonzero(np.unpackbits(found, count=rows))
        words = (self.codes[some] ^ query).view(np.uint64)
        return some[np.bitwise_count(words).sum(axis=1) <= radius]


def nearest(
    ids: np.ndarray, x: np.ndarray, query_ids: np.ndarray, queries: np.ndarray, coder: Coder, k: int
) -> list[tuple[int, int, float]]:
    """``query, row, score`` of the best k of a block for each query; queries and rows are named by their places."""
    index = Index(coder.candidates(x))
    codes = coder.queries(queries)
    out = []
    for n, (q, code, own) in enumerate(zip(queries, codes, query_ids.tolist())):
        radius, bits = coder.radius, 8 * codes.shape[1]
        while True:
            found = index.within(code, radius)
            found = found[ids[found] != own]
            if len(found) >= k or radius >= bits:
                break
            radius = min(bits, radius + codes.shape[1] // 4)
        score = x[found] @ q
        if len(found) > 4 * k:  # all that may be among the best, ties included
            keep = score >= np.partition(score, len(score) - k)[len(score) - k]
            found, score = found[keep], score[keep]
        order = np.lexsort((ids[found], -score))[:k]
        out += [(n, int(found[i]), float(score[i])) for i in order]
    return out


def usable(table: DataFrame) -> DataFrame:
    """``vec_id, embedding array<double>`` of the vectors that take part."""
    rows = table.select(
        F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding")
    ).where(
        F.col("vec_id").isNotNull()
        & F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
        & F.exists("embedding", lambda x: x != 0)
    )
    size = rows.groupBy(F.size("embedding").alias("d")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "d").first()
    return rows.where(F.size("embedding") == (size["d"] if size else 0))


def _matrix(column: pa.ChunkedArray) -> np.ndarray:
    flat = column.combine_chunks().flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1)


def search(
    table: DataFrame, queries: DataFrame, k: int = 20, bits: int = BITS, sample: int = SAMPLE, block: int | None = None
) -> DataFrame:
    """``query_id, rank, vec_id, score``: the k nearest found for each query among all usable rows.

    Rows of ``queries`` with equal id and vector are one query; with other vectors an id has k of each, ranked by themselves.
    """
    rows = usable(table).groupBy("vec_id", "embedding").agg(F.count(F.lit(1)).alias("copies"))
    asked = usable(queries).distinct().withColumn("form", F.xxhash64("embedding"))
    norm = F.sqrt(F.aggregate("embedding", F.lit(0.0), lambda a, x: a + x * x))
    known = rows.agg(F.count(F.lit(1)).alias("n"), F.max(norm).alias("longest"), F.max(F.size("embedding")).alias("d")).first()
    if not known["n"]:
        return rows.select(
            F.col("vec_id").alias("query_id"), F.lit(1).alias("rank"), "vec_id", F.lit(0.0).alias("score")
        ).limit(0)
    by = unit_hash(F.col("vec_id"), F.xxhash64("embedding"), F.lit("index"))
    taken = rows.select("vec_id", "embedding", by.alias("by")).where(F.col("by") < F.lit(sample / known["n"])).toPandas()
    taken = taken.sort_values(["vec_id", "by"])
    x = np.array(taken["embedding"].tolist(), dtype=float).reshape(len(taken), -1)
    x = x if len(x) else np.eye(1, known["d"])
    coder = learn(x, known["longest"], k, bits)
    reach_workers(table.sparkSession)
    sent = table.sparkSession.sparkContext.broadcast(coder)
    block = block or max(256, BLOCK_NUMBERS // known["d"])
    parts, query_parts = -(-known["n"] // block), -(-asked.count() // block) or 1
    schema = pa.schema(
        [("query_id", pa.int64()), ("form", pa.int64()), ("vec_id", pa.int64()), ("score", pa.float64()), ("copies", pa.int64())]
    )

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        columns = [(), (), (), (), ()]
        if len(left) and len(right):
            found = nearest(
                left.column("vec_id").to_numpy(), _matrix(left.column("embedding")),
                right.column("vec_id").to_numpy(), _matrix(right.column("embedding")), sent.value, k,
            )
            if found:
                query, near, score = (np.array(x) for x in zip(*found))
                columns = [right.column(c).to_numpy()[query] for c in ("vec_id", "form")]
                columns += [left.column("vec_id").to_numpy()[near], score, left.column("copies").to_numpy()[near]]
        return pa.table([pa.array(c, type=f.type) for c, f in zip(columns, schema)], schema=schema)

    def dealt(some: DataFrame, own: str, own_parts: int, other: str, other_parts: int) -> DataFrame:
        return some.select(
            "*", F.pmod(F.xxhash64("vec_id", "embedding"), F.lit(own_parts)).cast("int").alias(own),
            F.explode(F.sequence(F.lit(0), F.lit(other_parts - 1))).alias(other),
        )

    left = dealt(rows, "part", parts, "query_part", query_parts).groupBy("part", "query_part")
    right = dealt(asked, "query_part", query_parts, "part", parts).groupBy("part", "query_part")
    found = left.cogroup(right).applyInArrow(run, "query_id long, form long, vec_id long, score double, copies long")
    found = found.withColumn("copy", F.explode(F.sequence(F.lit(1), F.least(F.col("copies"), F.lit(k)).cast("int"))))
    best = W.partitionBy("query_id", "form").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def op3_multi_index_hashing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest of every vector whose id is divisible by 20, among all others."""
    table = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    return search(table, table.where(F.col("vec_id") % 20 == 0), 20)
