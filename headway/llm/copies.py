"""N-gram Jaccard join and near-duplicate classes by MinHash banding.

A text is the set of its runs of five words (lower case, white space between words); a shorter
text is one run of all its words. Two texts are linked if the Jaccard similarity of their sets is
0.8 or more.

1. Each text becomes a digest of its set and one hash per band of MinHash values. Numbers of bands and
   rows are chosen for the wanted recall at the threshold.
2. Texts of equal sets are one node from here on, so copies are never compared.
3. Nodes are shuffled on their band hashes. Buckets with equal members count once. A large bucket is
   cut into blocks by hash; every pair of blocks is a unit of work of bounded size.
4. Each unit verifies its pairs on the full sets, as products of membership matrices. A pair that
   shares several buckets is verified in the first of them alone. A unit returns counts of links and
   the stars that connect linked nodes - rows in proportion to its nodes, never its pairs.
5. Classes are the connected components of those stars.

Defined results: rows with a null id are left out, but not by the query, where they are documents of their own; null and empty texts, and texts of white space alone, are
equal to one another and to nothing else; repeated rows are copies of one another; texts under one id fall into
one class; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import BinaryType, StructField, StructType

from headway.llm.common import batch_of, blocks, kept, key_bits, mapped
from headway.llm.words import DARK_BYTES, run_hashes, word_hashes

WORDS = 5
THRESHOLD = 0.8
RECALL = 0.9995
ROWS = 6
#: Nodes and n-grams in a block; two blocks meet in a task.
BLOCK_NODES = 256
BLOCK_GRAMS = 2_000_000


def band_count(threshold: float = THRESHOLD, recall: float = RECALL, rows: int = ROWS) -> int:
    """Bands with which a pair at the threshold shares one with probability ``recall``."""
    return math.ceil(math.log(1 - recall) / math.log(1 - threshold**rows))


def gram_sets(texts: list[str], words: int = WORDS) -> list[np.ndarray]:
    """For each text the sorted distinct hashes of its runs of words."""
    hashes, starts = word_hashes([" ".join(t.lower().split()) for t in texts], DARK_BYTES)
    out = []
    for a, b in zip(starts.tolist(), starts[1:].tolist()):
        n = min(words, b - a)
        out.append(np.unique(run_hashes(hashes[a:b], tuple(range(n)), n)) if n else np.zeros(0, np.uint64))
    return out


class MinHash:
    """Band hashes of sets; sets that agree in all rows of a band have equal hashes there."""

    def __init__(self, bands: int, rows: int, seed: int = 17):
        chance = np.random.default_rng(seed)
        self.bands, self.rows = bands, rows
        self.factor = chance.integers(0, 1 << 32, (bands * rows, 1), dtype=np.uint32) | np.uint32(1)
        self.shift = chance.integers(0, 1 << 32, (bands * rows, 1), dtype=np.uint32)

    def __call__(self, grams: np.ndarray) -> np.ndarray:
        short = (grams >> np.uint64(32)).astype(np.uint32)
        least = np.full(self.bands * self.rows, 0xFFFFFFFF, dtype=np.uint32)
        for at in range(0, len(short), 512):
            value = short[at : at + 512] * self.factor
            value += self.shift
            value ^= value >> np.uint32(15)
            value *= np.uint32(0x2C1B3C6D)
            np.minimum(least, value.min(axis=1), out=least)
        out = np.arange(self.bands, dtype=np.uint64)
        for column in least.reshape(self.bands, self.rows).T:
            out = (out ^ column) * np.uint64(0x9E3779B97F4A7C15)
            out ^= out >> np.uint64(29)
        return out.view(np.int64)


SKETCH = pa.schema(
    [("doc_id", pa.int64()), ("digest", pa.binary()), ("grams", pa.int32()), ("bands", pa.list_(pa.int64()))]
)


def sketches(docs: DataFrame, bands: int, rows: int, words: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        minhash = MinHash(bands, rows)
        for batch, texts in blocks(batches):
            sets = gram_sets(texts, words)
            yield batch_of(
                SKETCH, doc_id=batch.column("doc_id"), grams=[len(s) for s in sets],
                digest=[hashlib.blake2b(s.tobytes(), digest_size=16).digest() for s in sets],
                bands=[minhash(s) if len(s) else [] for s in sets],
            )

    return mapped(docs, run, "doc_id long, digest binary, grams int, bands array<long>")


def units(nodes: DataFrame) -> DataFrame:
    """``unit, key, side, node, copies, keys``: what each unit of work compares, without the sets.

    ``side`` is 0 or 1 where two blocks meet, 2 where a block meets itself.
    """
    rows = nodes.select("node", "copies", "grams", F.explode("bands").alias("key"))
    buckets = (
        rows.groupBy("key")
        .agg(
            F.count(F.lit(1)).alias("members"), F.sum("grams").alias("size"),
            # Equal for buckets of equal members.
            F.sum(F.xxhash64("node").cast("decimal(20,0)")).alias("one"),
            F.sum(F.xxhash64("node", F.lit(1)).cast("decimal(20,0)")).alias("two"),
        )
        .where("members > 1")
    )
    first = buckets.groupBy("members", "size", "one", "two").agg(F.min("key").alias("key")).select(
        "key", F.greatest(F.ceil(F.col("members") / BLOCK_NODES), F.ceil(F.col("size") / BLOCK_GRAMS)).cast("int").alias("parts")
    )
    members = rows.join(first, "key")
    of_node = members.groupBy("node").agg(F.array_sort(F.collect_list("key")).alias("keys"))
    part = F.pmod(F.xxhash64("node", F.lit(2)), F.col("parts")).cast("int")
    placed = members.withColumn("part", part).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    low, high = F.least("part", "other"), F.greatest("part", "other")
    side = F.when(F.col("part") == F.col("other"), 2).when(F.col("part") < F.col("other"), 0).otherwise(1)
    return placed.select(
        F.xxhash64("key", low, high).alias("unit"), "key", side.cast("int").alias("side"), "node", "copies",
        F.col("parts"), low.alias("low"), high.alias("high"),
    ).join(of_node, "node")


def _common(sets: list[np.ndarray], left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Sizes of the intersections of all left with all right sets, by products of membership matrices."""
    out = np.zeros((len(left), len(right)), dtype=np.float32)
    used = np.union1d(left, right)
    gram = np.concatenate([sets[i] for i in used])
    owner = np.repeat(used, [len(sets[i]) for i in used])
    order = np.argsort(gram, kind="stable")
    gram, owner = gram[order], owner[order]
    column = np.cumsum(np.concatenate(([0], gram[1:] != gram[:-1])))
    many = np.bincount(column)[column] > 1  # n-grams of one set alone are in no intersection
    column, owner = column[many], owner[many]
    if not len(column):
        return out
    column = np.cumsum(np.concatenate(([0], column[1:] != column[:-1])))
    row_l, row_r = np.full(len(sets), -1), np.full(len(sets), -1)
    row_l[left], row_r[right] = np.arange(len(left)), np.arange(len(right))
    width = 2048
    for at in range(0, int(column[-1]) + 1, width):
        a, b = np.searchsorted(column, (at, at + width))
        c, o = column[a:b] - at, owner[a:b]
        x = np.zeros((len(left), width), dtype=np.float32)
        y = np.zeros((len(right), width), dtype=np.float32)
        x[row_l[o[row_l[o] >= 0]], c[row_l[o] >= 0]] = 1
        y[row_r[o[row_r[o] >= 0]], c[row_r[o] >= 0]] = 1
        out += x @ y.T
    return out


def linked(sets: list[np.ndarray], keys: list[np.ndarray], key: int, left: np.ndarray, right: np.ndarray, threshold: float) -> np.ndarray:
    """Which pairs of a unit are linked and belong to it: those that share no earlier bucket."""
    size = np.array([len(s) for s in sets], dtype=np.float64)
    small, large = np.minimum.outer(size[left], size[right]), np.maximum.outer(size[left], size[right])
    wanted = small >= threshold * large - 1e-9
    earlier: dict[int, list[int]] = {}
    for i, own in enumerate(keys):
        for k in own[own < key].tolist():
            earlier.setdefault(k, []).append(i)
    at_l, at_r = np.full(len(sets), -1), np.full(len(sets), -1)
    at_l[left], at_r[right] = np.arange(len(left)), np.arange(len(right))
    for some in earlier.values():
        if len(some) > 1:
            some = np.array(some)
            l, r = at_l[some], at_r[some]
            wanted[np.ix_(l[l >= 0], r[r >= 0])] = False
    if left is right:
        wanted &= np.tri(len(left), k=-1, dtype=bool)
    rows, columns = np.nonzero(wanted)
    if not len(rows):
        return wanted
    if len(rows) <= max(64, wanted.size // 50):
        common = np.array([len(np.intersect1d(sets[left[i]], sets[right[j]], assume_unique=True)) for i, j in zip(rows, columns)])
    else:
        common = _common(sets, left, right)[rows, columns]
    union = size[left[rows]] + size[right[columns]] - common
    wanted[rows, columns] = common >= threshold * union - 1e-9
    return wanted


LINKS = pa.schema([("node", pa.int64()), ("links", pa.int64()), ("texts", pa.int64()), ("star", pa.int64())])


def unit_links(rows: list[dict], threshold: float) -> list[tuple[int, int, int, int]]:
    """Of one unit, for each node with a link in it: linked documents, linked texts, least node it is connected to."""
    rows = sorted(rows, key=lambda r: (r["side"], r["node"]))
    sets = [np.frombuffer(r["grams"], dtype=np.uint64) for r in rows]
    keys = [np.asarray(r["keys"], dtype=np.int64) for r in rows]
    side = np.array([r["side"] for r in rows])
    node, copies = np.array([r["node"] for r in rows]), np.array([r["copies"] for r in rows])
    if (side == 2).all():
        left = right = np.arange(len(rows))
    else:
        left, right = np.flatnonzero(side == 0), np.flatnonzero(side == 1)
    if not len(left) or not len(right):
        return []
    match = linked(sets, keys, rows[0]["key"], left, right, threshold)
    a, b = np.nonzero(match)
    a, b = left[a], right[b]
    links, texts = np.zeros(len(rows), np.int64), np.zeros(len(rows), np.int64)
    np.add.at(links, a, copies[b])
    np.add.at(links, b, copies[a])
    np.add.at(texts, a, 1)
    np.add.at(texts, b, 1)
    star = node.copy()
    while True:  # least node along links, until nothing changes
        before = star.copy()
        np.minimum.at(star, a, star[b])
        np.minimum.at(star, b, star[a])
        if (star == before).all():
            break
    return [(int(node[i]), int(links[i]), int(texts[i]), int(star[i])) for i in np.flatnonzero(texts)]


def verified(work: DataFrame, threshold: float) -> DataFrame:
    """``node, links, texts, star`` of all units; ``work`` has the columns of ``units`` and the sets as ``grams``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unit, rows = None, []
        for batch in batches:
            done = []
            for row in batch.to_pylist():
                name = (row["key"], row["low"], row["high"])
                if name != unit:
                    done += unit_links(rows, threshold) if len(rows) > 1 else []
                    unit, rows = name, []
                rows.append(row)
            columns = list(zip(*done)) or [()] * len(LINKS)
            yield batch_of(LINKS, **dict(zip(LINKS.names, map(list, columns))))
        done = unit_links(rows, threshold) if len(rows) > 1 else []
        columns = list(zip(*done)) or [()] * len(LINKS)
        yield batch_of(LINKS, **dict(zip(LINKS.names, map(list, columns))))

    dealt = work.repartition("unit").sortWithinPartitions("unit", "key", "low", "high")
    return mapped(dealt, run, "node long, links long, texts long, star long")


def components(edges: DataFrame) -> DataFrame:
    """``node, root``: the least node of each connected component, for every node of ``edges(a, b)``.

    Large-star and small-star steps in turn: each hangs neighbours on the least of them, so that
    paths halve and no node gathers its neighbours in one task.
    """

    def least(pairs: DataFrame) -> DataFrame:
        return pairs.groupBy("a").agg(F.min("b").alias("low"))

    edges = kept(edges.where("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    mark = None
    while True:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        # Written down, so that the join below meets two plain shuffles and a node with very many
        # neighbours can be split between tasks.
        low = kept(least(both).select("a", F.least("a", "low").alias("low")))
        large = both.join(low, "a").where("b > a").select(F.col("b").alias("a"), F.col("low").alias("b")).distinct()
        low = least(large)
        small = (
            large.join(low, "a").select(F.greatest("b", "low").alias("a"), F.least("b", "low").alias("b")).where("a != b")
            .unionByName(low.select("a", F.col("low").alias("b"))).distinct()
        )
        edges = kept(small)
        now = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))).first()
        if now == mark:
            return edges.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("root"))
        mark = now


def linked_texts(docs: DataFrame, words: int, threshold: float, recall: float, rows: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Of ``doc_id, text``: rows with their digest; ``digest, node, copies, least`` of each set; links of its node."""
    sketched = kept(sketches(docs, band_count(threshold, recall, rows), rows, words))
    nodes = sketched.groupBy("digest").agg(
        F.min("doc_id").alias("least"), F.count(F.lit(1)).alias("copies"), F.first("grams").alias("grams"), F.first("bands").alias("bands")
    )
    # Numbers of sets, fixed by being written down.
    nodes = kept(nodes.withColumn("node", F.monotonically_increasing_id()))
    work = kept(units(nodes))
    mark = F.conv(F.substring(F.hex("digest"), 1, 8), 16, 10).cast("long")
    wanted = kept(work.select("node").distinct().join(nodes.select("node", "digest", "least"), "node").withColumn("mark", mark))
    schema = pa.schema([("digest", pa.binary()), ("grams", pa.binary())])
    bits, marks = key_bits(wanted, "least"), key_bits(wanted, "mark", hashed=False)
    sent, sent_marks = (docs.sparkSession.sparkContext.broadcast(b) for b in (bits, marks))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        near = sent_marks.value
        chosen = (b.filter(sent.value.hit(b.column("position"))) for b in batches)
        for _, texts in blocks(chosen):
            sets = [s.tobytes() for s in gram_sets(texts, words)]
            digest = [hashlib.blake2b(s, digest_size=16).digest() for s in sets]
            some = [i for i, d in enumerate(digest) if near.bits[int.from_bytes(d[:4], "big") % near.size]]
            yield batch_of(schema, digest=[digest[i] for i in some], grams=[sets[i] for i in some])

    # Texts are read again where they lie; only sets of nodes that share a bucket are shuffled.
    read = mapped(docs.withColumn("position", bits.position(F.col("doc_id"))), run, "digest binary, grams binary")
    sets = read.join(wanted.select("node", "digest"), "digest").dropDuplicates(["node"]).select("node", "grams")
    return sketched, nodes.select("digest", "node", "copies", "least", "grams"), kept(verified(work.join(sets, "node"), threshold))


def near_copies(
    docs: DataFrame, key: str = "doc_id", text: str = "text", words: int = WORDS, threshold: float = THRESHOLD,
    recall: float = RECALL, rows: int = ROWS, without_id: bool = False,
) -> DataFrame:
    """``doc_id, class_id, n_links, n_text_links, n_copies`` of every document; with ``without_id`` those with a null id too.

    ``class_id``: the least id of its class; ``n_links``: other documents linked with it, copies included;
    ``n_text_links``: texts with other sets linked with it; ``n_copies``: documents with its set, itself included.
    """
    docs = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    docs = docs if without_id else docs.where("doc_id IS NOT NULL")
    sketched, digests, found = linked_texts(docs, words, threshold, recall, rows)
    edges = found.select(F.col("node").alias("a"), F.col("star").alias("b"))
    # Sets under one id are connected through it.
    several = sketched.where("doc_id IS NOT NULL").groupBy("doc_id").agg(F.min("digest").alias("digest"), F.max("digest").alias("last"))
    several = kept(several.where("digest != last").join(digests, "digest").select("doc_id", F.col("node").alias("b")))
    same = sketched.select("doc_id", "digest").join(several, "doc_id").select("digest", "b").distinct()
    edges = edges.unionByName(same.join(digests, "digest").select(F.col("node").alias("a"), "b"))
    roots = kept(components(edges).join(digests.select("node", "least"), "node"))
    # A root is not among its class.
    tops = roots.select(F.col("root").alias("node")).distinct().join(digests.select("node", "least"), "node").select("node", F.col("node").alias("root"), "least")
    roots = kept(roots.select("node", "root", "least").unionByName(tops).distinct())
    low = kept(roots.groupBy("root").agg(F.min("least").alias("class_id")))
    of_class = roots.select("node", "root").join(low, "root").select("node", "class_id")
    links = found.groupBy("node").agg(F.sum("links").alias("links"), F.sum("texts").alias("texts"))
    classes = digests.join(of_class, "node", "left").join(links, "node", "left").select(
        "digest", "copies", F.coalesce("class_id", "least").alias("class_id"),
        F.coalesce("links", F.lit(0)).alias("links"), F.coalesce("texts", F.lit(0)).alias("texts"),
    )
    return sketched.select("doc_id", "digest").join(classes, "digest").select(
        "doc_id", "class_id", (F.col("links") + F.col("copies") - 1).alias("n_links"),
        F.col("texts").alias("n_text_links"), F.col("copies").alias("n_copies"),
    )


def one_of_each(docs: DataFrame) -> DataFrame:
    """The rows, with all their columns, of one text of each class of linked texts: the one with the least id, null last.

    Other texts under the same id are judged by themselves. Of rows with equal id and set, one stays. Rows with neither
    id nor words stay.
    """
    narrow = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    sketched, digests, found = linked_texts(narrow, WORDS, THRESHOLD, RECALL, ROWS)
    roots = components(found.select(F.col("node").alias("a"), F.col("star").alias("b")))
    named = kept(digests.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node")))
    first = F.struct(F.col("least").isNull().alias("none"), "least", "node")
    best = kept(named.groupBy("root").agg(F.min(first).alias("first"), F.count(F.lit(1)).alias("sets")))
    # Sets whose rows do not all stay, and whether one of them does.
    gone = named.join(best, "root").where("sets > 1 OR copies > 1").select("digest", "least", "grams", (F.col("first.node") == F.col("node")).alias("wins"))
    verdict = sketched.select("doc_id", "digest").distinct().join(kept(gone), "digest").where("doc_id IS NOT NULL OR grams > 0").select(
        F.col("doc_id").alias("__copy_id"), F.col("digest").alias("__copy_of"), (F.col("wins") & F.col("doc_id").eqNullSafe(F.col("least"))).alias("__copy_stays")
    )
    verdict = kept(verdict)
    bits = key_bits(verdict, "__copy_id")
    sent = docs.sparkSession.sparkContext.broadcast(bits)
    placed = docs.withColumn("__copy_position", bits.position(F.col("doc_id").cast("long")))

    def left(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield b.filter(pc.invert(sent.value.hit(b.column("__copy_position")))).drop_columns(["__copy_position"])

    def hit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b, texts in blocks(b.filter(sent.value.hit(b.column("__copy_position"))) for b in batches):
            digest = [hashlib.blake2b(s.tobytes(), digest_size=16).digest() for s in gram_sets(texts)]
            yield b.drop_columns(["__copy_position"]).append_column("__copy_digest", pa.array(digest, type=pa.binary()))

    # Rows without a bit stay where they are; the others, few more than those that go, are joined.
    schema = StructType([*docs.schema.fields, StructField("__copy_digest", BinaryType())])
    marked = mapped(placed, hit, schema).join(
        verdict, F.col("doc_id").cast("long").eqNullSafe(F.col("__copy_id")) & (F.col("__copy_digest") == F.col("__copy_of")), "left"
    )
    single = marked.where("__copy_of IS NULL").select(*docs.columns)
    repeated = marked.where("__copy_stays").dropDuplicates(["__copy_digest"]).select(*docs.columns)
    return mapped(placed, left, docs.schema).unionByName(single).unionByName(repeated)


def op5_minhash_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate classes and numbers of links of all documents."""
    return near_copies(spark.read.parquet(f"{sf_dir}/documents.parquet"), without_id=True)
