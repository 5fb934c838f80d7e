"""Byte-level BPE encoding and decoding with a segment tree.

The text is split by the tokenizer's pattern and each match is encoded on its own. A match
that is itself a token is taken as it is. Otherwise a segment tree over byte positions holds
the rank of the pair that starts at each position; its root is the leftmost minimum. Each
merge changes three positions - the merged pair, its right part and its left neighbour - in
logarithmic time, so a match of n bytes costs n log n even without any white space in it.

Matches that come again are looked up in a table of bounded size per task. Decoding reads the ids
alone.

Defined results: null and empty texts give no ids and empty bytes; every other text gives back
exactly its UTF-8 bytes; repeated rows give repeated results; other columns are ignored.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Callable, Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import public_tokenizers
import regex
from pyspark.sql import DataFrame, SparkSession, functions as F

from headway.llm.common import batch_of, blocks, mapped

#: Matches a task remembers; when full the table starts anew, results do not change.
MEMORY = 200_000
#: Matches of up to so many bytes are merged many at a time, each in its own segment tree; longer ones singly.
LOCKSTEP_BYTES = 64
#: The rank file is sent to every executor; a larger one is refused.
MOST_RANK_BYTES = 32 << 20

NO_RANK = 1 << 62
ASTRAL = re.compile("[\U00010000-\U0010ffff]").search


def read_ranks(path: str) -> bytes:
    """The rank file as it is, checked in size."""
    with open(path, "rb") as file:
        data = file.read(MOST_RANK_BYTES + 1)
    if len(data) > MOST_RANK_BYTES:
        raise ValueError(f"rank file over {MOST_RANK_BYTES} bytes: {path}")
    return data


@lru_cache(maxsize=4)
def parsed(data: bytes) -> tuple[dict[bytes, int], list[bytes]]:
    """Token to rank and rank to token."""
    ranks = {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in data.splitlines() if line)}
    tokens = [b""] * (max(ranks.values(), default=-1) + 1)
    for token, rank in ranks.items():
        tokens[rank] = token
    return ranks, tokens


def merge(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Ids of one match: repeatedly merge the leftmost pair of least rank."""
    whole = ranks.get(piece)
    if whole is not None:
        return [whole]
    n = len(piece)
    rank_of = ranks.get
    width = 1 << max(0, n - 2).bit_length()
    # A leaf holds rank * n + position, so that the minimum is the leftmost pair of least rank.
    tree = [NO_RANK] * (2 * width)
    for i in range(n - 1):
        rank = rank_of(piece[i : i + 2])
        if rank is not None:
            tree[width + i] = rank * n + i
    for i in range(width - 1, 0, -1):
        left, right = tree[2 * i], tree[2 * i + 1]
        tree[i] = left if left < right else right
    after = list(range(1, n + 1))  # where the live part that starts here ends
    before = list(range(-1, n - 1))  # where the live part to the left starts

    def put(place: int, value: int) -> None:
        i = width + place
        tree[i] = value
        while i > 1:
            other = tree[i ^ 1]
            least = value if value < other else other
            i >>= 1
            if tree[i] == least:
                return
            tree[i] = value = least

    while tree[1] != NO_RANK:
        i = tree[1] % n
        middle = after[i]
        end = after[middle]
        after[i] = end
        if middle < n - 1:
            put(middle, NO_RANK)
        if end < n:
            before[end] = i
            rank = rank_of(piece[i : after[end]])
            put(i, NO_RANK if rank is None else rank * n + i)
        else:
            put(i, NO_RANK)
        left = before[i]
        if left >= 0:
            rank = rank_of(piece[left:end])
            put(left, NO_RANK if rank is None else rank * n + left)
    ids, i = [], 0
    while i < n:
        ids.append(ranks[piece[i : after[i]]])
        i = after[i]
    return ids


class Pairs:
    """For two tokens side by side, the rank of their joined bytes: an open-addressing table in arrays."""

    def __init__(self, ranks: dict[bytes, int]):
        rows = [
            (ranks[token[:k]] << 32 | ranks[token[k:]], rank)
            for token, rank in ranks.items()
            for k in range(1, len(token))
            if token[:k] in ranks and token[k:] in ranks
        ]
        self.bits = max(4, (4 * len(rows)).bit_length())
        self.keys = np.full(1 << self.bits, -1, dtype=np.int64)
        self.values = np.full(1 << self.bits, NO_RANK, dtype=np.int64)
        keys = np.array([k for k, _ in rows], dtype=np.int64)
        values = np.array([v for _, v in rows], dtype=np.int64)
        place = self._place(keys)
        while len(keys):
            free = self.keys[place] < 0
            self.keys[place[free]] = keys[free]  # of several at one place the last stays
            self.values[place[free]] = values[free]
            lost = self.keys[place] != keys
            keys, values, place = keys[lost], values[lost], (place[lost] + 1) & (len(self.keys) - 1)
        self.byte_ids = np.array([ranks.get(bytes([i]), -1) for i in range(256)], dtype=np.int64)

    def _place(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        keys = (left << 32) | right
        place = self._place(keys)
        found = self.keys[place]
        out = np.where(found == keys, self.values[place], NO_RANK)
        rest = np.flatnonzero((found != keys) & (found >= 0))
        while len(rest):
            place[rest] = (place[rest] + 1) & (len(self.keys) - 1)
            found = self.keys[place[rest]]
            hit = found == keys[rest]
            out[rest[hit]] = self.values[place[rest[hit]]]
            rest = rest[~hit & (found >= 0)]
        return out


def merge_many(pieces: list[bytes], pairs: Pairs) -> list[bytes]:
    """Ids, as packed 32-bit numbers, of matches of 2 to ``LOCKSTEP_BYTES`` bytes.

    Every match has a tree of its own; a round does one merge in each.
    """
    out: list[bytes] = [b""] * len(pieces)
    widths: dict[int, list[int]] = {}
    for i, piece in enumerate(pieces):
        widths.setdefault(1 << (len(piece) - 1).bit_length(), []).append(i)
    for w, members in widths.items():
        rows = len(members)
        lens = np.array([len(pieces[i]) for i in members])
        raw = np.frombuffer(b"".join(pieces[i].ljust(w, b"\0") for i in members), dtype=np.uint8)
        ids = pairs.byte_ids[raw]  # flat: row * w + position; -1 where a part was merged into its left
        position = np.tile(np.arange(w), rows)
        length = np.repeat(lens, w)
        after, before = position + 1, position - 1
        tree = np.full((rows, 2 * w), NO_RANK, dtype=np.int64)
        has = np.flatnonzero(position < length - 1)
        rank = pairs.rank(ids[has], ids[has + 1])
        known = rank < NO_RANK
        tree[has[known] // w, w + has[known] % w] = rank[known] * w + has[known] % w
        level = w
        while level > 1:
            tree[:, level // 2 : level] = np.minimum(tree[:, level : 2 * level : 2], tree[:, level + 1 : 2 * level : 2])
            level //= 2
        flat = tree.reshape(-1)

        def put(row: np.ndarray, place: np.ndarray, value: np.ndarray | int) -> None:
            base, node = row * (2 * w), place + w
            flat[base + node] = value
            for _ in range(w.bit_length() - 1):
                node = node >> 1
                flat[base + node] = np.minimum(flat[base + 2 * node], flat[base + 2 * node + 1])

        def key(left: np.ndarray, right: np.ndarray, place: np.ndarray) -> np.ndarray:
            rank = pairs.rank(left, right)
            return np.where(rank < NO_RANK, rank * w + place, NO_RANK)

        live = np.flatnonzero(tree[:, 1] < NO_RANK)
        while len(live):
            root, base = tree[live, 1], live * w
            i = root % w
            middle = after[base + i]
            end = after[base + middle]
            ids[base + i] = root // w
            ids[base + middle] = -1
            after[base + i] = end
            put(live, middle, NO_RANK)
            inner = end < lens[live]
            before[(base + end)[inner]] = i[inner]
            value = np.full(len(live), NO_RANK, dtype=np.int64)
            value[inner] = key(ids[(base + i)[inner]], ids[(base + end)[inner]], i[inner])
            put(live, i, value)
            left = before[base + i]
            inner = left >= 0
            l, b = left[inner], base[inner]
            put(live[inner], l, key(ids[b + l], ids[b + i[inner]], l))
            live = live[tree[live, 1] < NO_RANK]
        alive = (position < length) & (ids >= 0)
        counts = alive.reshape(rows, w).sum(axis=1)
        ends = np.cumsum(counts).tolist()
        raw_ids = ids[alive].astype(np.int32).tobytes()
        for i, a, b in zip(members, [0, *ends], ends):
            out[i] = raw_ids[4 * a : 4 * b]
    return out


@lru_cache(maxsize=4)
def pair_table(data: bytes) -> Pairs:
    return Pairs(parsed(data)[0])


def _ranges(codes: list[int]) -> str:
    """Code points as the inside of a character class."""
    out, start = [], None
    for a, b in zip(codes, [*codes[1:], -1]):
        start = a if start is None else start
        if b != a + 1:
            out.append(f"\\u{start:04x}-\\u{a:04x}")
            start = None
    return "".join(out)


@lru_cache(maxsize=4)
def splitters(pattern: str) -> tuple[Callable, Callable]:
    """The pattern for any text, and an equal, faster one for texts without code points past U+FFFF.

    The second has the classes written out, so that the standard library can run it.
    """
    basic = "".join(chr(i) for i in range(0x10000) if not 0xD800 <= i < 0xE000)

    def spelled(name: str) -> str:
        return _ranges([ord(c) for c in regex.findall(name, basic)])

    parts = {r"\p{L}": spelled(r"\p{L}"), r"\p{N}": spelled(r"\p{N}")}
    space = spelled(r"\p{White_Space}")
    plain = pattern.replace(r"[^\s\p{L}\p{N}]", f"[^{space}{parts[r'\p{L}']}{parts[r'\p{N}']}]")
    for name, inside in parts.items():
        plain = plain.replace(name, f"[{inside}]")
    plain = plain.replace(r"\S", f"[^{space}]").replace(r"\s", f"[{space}]")
    full = pattern.replace(r"[^\s", r"[^\p{White_Space}").replace(r"\S", r"\P{White_Space}").replace(r"\s", r"\p{White_Space}")
    return regex.compile(full).findall, re.compile(plain).findall


def packed(ids: list[int]) -> bytes:
    return np.array(ids, dtype=np.int32).tobytes()


class Encoder:
    """Ids of whole texts as packed 32-bit numbers; forgets its matches when there are over ``memory``."""

    def __init__(self, data: bytes, pattern: str, memory: int = MEMORY):
        self.ranks, _ = parsed(data)
        self.pairs = pair_table(data)
        self.any_split, self.plain_split = splitters(pattern)
        self.memory = memory
        self.known: dict[str, bytes] = {}

    def split(self, text: str) -> list[str]:
        wide = not text.isascii() and ASTRAL(text)
        return self.any_split(text) if wide else self.plain_split(text)

    def learn(self, pieces: set[str]) -> None:
        many: list[str] = []
        raw: list[bytes] = []
        for piece in pieces:
            data = piece.encode()
            rank = self.ranks.get(data)
            if rank is not None:
                self.known[piece] = packed([rank])
            elif 2 <= len(data) <= LOCKSTEP_BYTES:
                many.append(piece)
                raw.append(data)
            else:
                self.known[piece] = packed(merge(data, self.ranks))
        self.known.update(zip(many, merge_many(raw, self.pairs)))

    def __call__(self, texts: list[str]) -> list[bytes]:
        split = [self.split(t) for t in texts]
        if len(self.known) > self.memory:
            self.known.clear()
        new = set(chain.from_iterable(split)).difference(self.known)
        self.learn(new)
        get = self.known.__getitem__
        return [b"".join(map(get, pieces)) for pieces in split]


def as_lists(packed_ids: list[bytes]) -> pa.Array:
    ends = np.cumsum([0, *(len(ids) // 4 for ids in packed_ids)]).astype(np.int32)
    return pa.ListArray.from_arrays(ends, np.frombuffer(b"".join(packed_ids), dtype=np.int32))


ENCODED = pa.schema([("doc_id", pa.int64()), ("ids", pa.list_(pa.int32()))])
DECODED = pa.schema([("doc_id", pa.int64()), ("ids", pa.list_(pa.int32())), ("decoded", pa.binary())])


def encode(docs: DataFrame, rank_path: str, pattern: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, ids array<int>`` of every whole text."""
    data = docs.sparkSession.sparkContext.broadcast(read_ranks(rank_path))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(data.value, pattern)
        for rows, texts in blocks(batches):
            lists = encoder(texts)
            yield batch_of(ENCODED, doc_id=rows.column("doc_id"), ids=as_lists(lists))

    rows = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    return mapped(rows, run, "doc_id long, ids array<int>")


class Decoder:
    """The bytes that packed ids stand for."""

    def __init__(self, data: bytes):
        _, self.tokens = parsed(data)

    def __call__(self, ids: bytes) -> bytes:
        return b"".join(map(self.tokens.__getitem__, np.frombuffer(ids, dtype=np.int32).tolist()))


def decode(encoded: DataFrame, rank_path: str) -> DataFrame:
    """``doc_id, ids, decoded binary`` of ``doc_id, ids``; null ids stand for nothing."""
    data = encoded.sparkSession.sparkContext.broadcast(read_ranks(rank_path))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decoder = Decoder(data.value)
        for batch in batches:
            lists = batch.column("ids")
            parts = [decoder(packed(ids or [])) for ids in lists.to_pylist()]
            yield batch_of(DECODED, doc_id=batch.column("doc_id"), ids=lists, decoded=parts)

    return mapped(encoded.select("doc_id", "ids"), run, "doc_id long, ids array<int>, decoded binary")


def round_trip(docs: DataFrame, rank_path: str, pattern: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, ids, decoded``: every whole text encoded and its ids decoded again, in one pass."""
    data = docs.sparkSession.sparkContext.broadcast(read_ranks(rank_path))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, decoder = Encoder(data.value, pattern), Decoder(data.value)
        for rows, texts in blocks(batches):
            lists = encoder(texts)
            yield batch_of(DECODED, doc_id=rows.column("doc_id"), ids=as_lists(lists), decoded=list(map(decoder, lists)))

    rows = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    return mapped(rows, run, "doc_id long, ids array<int>, decoded binary")


def digests(decoded: DataFrame) -> DataFrame:
    """Counts and checksums of ids and decoded bytes."""
    return decoded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.concat_ws(" ", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op4_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Encode all documents by the 50k ranks, decode the ids again."""
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return digests(round_trip(docs, path, public_tokenizers.PATTERN))
