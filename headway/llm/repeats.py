"""Exact repeats by threshold-bounded interval expansion on a Burrows-Wheeler transform.

Every byte is found that a string of ``length`` bytes covers which also starts anywhere else in the table.

*Strings.* Windows of ``length`` bytes are dealt by their content: the 200 bytes in a window that hash least are
its anchor (the leftmost of equal ones), so equal windows have equal anchors wherever they lie. Neighbouring windows on one
anchor make up one string of up to twice ``length`` bytes. Strings that are equal byte for byte count as one with a number;
of anchors that occur once in the whole table nothing can repeat. The rest is read once more and dealt by anchor.

*Transform.* A task takes whole anchors, a quarter of a megabyte of text at a time, sorts the suffixes of their strings by
``length`` bytes or more (each string with an end of its own), writes the transform and expands intervals breadth first: all intervals
of prefixes of n bytes are extended backward by every byte before them, and each new interval sets the common prefix behind its
last suffix to n, if no shorter prefix has. Common prefixes thus come in the order of their values. Expansion stops at ``length``:
what is unset by then is longer, so the suffixes on both sides of it repeat.

*Anchors with very many strings* (a line that a third of all texts hold, with other words around it): each of their
strings is cut in two, on the anchor and half of the bytes missing to ``length`` on its left or its right side. Where that is
too many again, each window is its own anchor, of which there is one string. So no group grows
with the input, nothing is capped and no string lost.

Only strings, runs and the texts that keep a part are shuffled. Bit sets that say which texts to read again have a fixed
size; a wrong hit costs time and changes nothing.

Defined results: a null text is empty; texts under ``length`` bytes stay whole; repeated rows are documents of their own, so
all of a repeated text goes if it has ``length`` bytes; ids may be null or repeat; an empty table gives an empty result; other
columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from headway.llm.common import KeyBits, batch_of, blocks, key_bits, mapped
from headway.llm.words import _power_tables, mixed
from headway.session import staged

LENGTH = 400
#: Strings of one anchor that are sorted together; more are cut at longer anchors.
MOST_STRINGS = 1024
#: Bytes of strings that are transformed together (one anchor at least).
BLOCK_BYTES = 250_000
#: Bytes of a long text whose windows are searched at once, and of shorter ones together; a string may end at the border of a slice.
SLICE, PIECES = 4_000_000, 250_000
#: The end of a string; no byte of UTF-8.
END = 255

STRING_SCHEMA = pa.schema(
    [("key", pa.int64()), ("digest", pa.int64()), ("node_a", pa.int64()), ("node_b", pa.int64()), ("start", pa.int64()), ("size", pa.int32()), ("bytes", pa.int64())]
)
TEXT_SCHEMA = pa.schema([("key", pa.int64()), ("digest", pa.int64()), ("string", pa.binary())])
PAIR_SCHEMA = pa.schema([("key", pa.int64()), ("digest", pa.int64()), ("n", pa.int64()), ("string", pa.binary())])
RUN_SCHEMA = pa.schema([("key", pa.int64()), ("digest", pa.int64()), ("low", pa.int32()), ("high", pa.int32())])


def node_of(raw: bytes) -> tuple[int, int]:
    """Two numbers that name a text by its bytes."""
    d = hashlib.blake2b(raw, digest_size=16).digest()
    return int.from_bytes(d[:8], "little", signed=True), int.from_bytes(d[8:], "little", signed=True)


def _least(values: np.ndarray, width: int) -> np.ndarray:
    """The least of each ``width`` values in a row: of the running minima from the borders of blocks of that width."""
    n = len(values) - width + 1
    padded = np.full(-(-len(values) // width) * width, np.iinfo(np.uint64).max, dtype=np.uint64)
    padded[: len(values)] = values
    table = padded.reshape(-1, width)
    ahead = np.minimum.accumulate(table, axis=1).ravel()
    back = np.minimum.accumulate(table[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(back[:n], ahead[width - 1 : width - 1 + n])


class Strings:
    """The strings of some texts: windows ``first`` to ``last`` (from the text's begin) of text ``text``, dealt by ``key``.

    ``data`` holds the texts end to end; texts have ``length`` bytes at least.
    """

    def __init__(self, raw: list[bytes], length: int, hot: list[KeyBits]):
        pieces = [
            (i, begin, min(len(r), begin + SLICE + length - 1)) for i, r in enumerate(raw) for begin in range(0, len(r) - length + 1, SLICE)
        ]
        found = []
        while pieces:
            size, n = 0, 0
            while n < len(pieces) and (not n or size + pieces[n][2] - pieces[n][1] <= PIECES):
                size += pieces[n][2] - pieces[n][1]
                n += 1
            found.append(_cut(raw, pieces[:n], length, hot))
            pieces = pieces[n:]
        empty = np.zeros(0, dtype=np.int64)
        self.key, self.text, self.first, self.last = (np.concatenate(x) for x in zip(*found)) if found else [empty] * 4


def _cut(raw: list[bytes], pieces: list[tuple[int, int, int]], length: int, hot: list[KeyBits]) -> tuple[np.ndarray, ...]:
    data = np.frombuffer(b"".join(raw[i][a:b] for i, a, b in pieces), dtype=np.uint8)
    text, begin, end = (np.array(x) for x in zip(*pieces))
    ends = np.cumsum(end - begin)
    power, inverse = _power_tables(len(data) + 1)
    total = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum((data + np.uint64(1)) * power[: len(data)], dtype=np.uint64, out=total[1:])
    gram = length // 2
    hashes = total[gram:] - total[:-gram]
    hashes *= inverse[: len(hashes)]
    hashes *= np.uint64(0x9E3779B97F4A7C15)
    # The least hash and, in the low bits, the leftmost place.
    hashes &= ~np.uint64((1 << 24) - 1)
    hashes |= np.arange(len(hashes), dtype=np.uint64)
    anchor = (_least(hashes, length - gram + 1) & np.uint64((1 << 24) - 1)).astype(np.int32)
    inside = np.ones(len(data), dtype=bool)
    for e in ends.tolist():
        inside[e - length + 1 : e] = False  # windows that would cross an end
    edge = np.diff(anchor) != 0
    inside = inside[: len(anchor)]
    first = np.flatnonzero(inside & np.concatenate(([True], edge | ~inside[:-1])))
    last = np.flatnonzero(inside & np.concatenate((edge | ~inside[1:], [True])))
    at = anchor[first].astype(np.int64)

    def keys() -> np.ndarray:
        return mixed((total[at + gram] - total[at]) * inverse[at]).view(np.int64)

    key = keys()
    for level, bits in enumerate(hot):  # only what is cut further goes on
        many = bits.bits[key % bits.size]
        if level == 0:
            more = -(-(length - gram) // 2)
            gram += more
            left = _part(many, at - more, first, np.minimum(last, at - more))
            right = _part(many, at, np.maximum(first, at - more + 1), last)
            at, first, last = (np.concatenate(x) for x in zip(left, right))
        else:  # every window by itself
            lowest, count = first[many], (last - first + 1)[many]
            at = first = last = np.repeat(lowest - np.cumsum(count) + count, count) + np.arange(count.sum())
            gram = length
        key = keys()
    piece = np.searchsorted(ends, first, side="right")
    moved = begin[piece] - (ends - end + begin)[piece]
    return key, text[piece], first + moved, last + moved


def _part(many: np.ndarray, at: np.ndarray, first: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, ...]:
    some = many & (first <= last)
    return at[some], first[some], last[some]


def digest(raw: bytes) -> int:
    return int.from_bytes(hashlib.blake2b(raw, digest_size=8).digest(), "little", signed=True)


def suffixes(data: np.ndarray, depth: int) -> np.ndarray:
    """Suffixes in the order of their first ``depth`` bytes (or more); what lies behind an ``END`` does not count, ends differ."""
    n = len(data)
    ends = np.flatnonzero(data == END)
    string = np.searchsorted(ends, np.arange(n))
    left = (ends[string] - np.arange(n)).astype(np.int32)  # bytes before the end
    wide = np.concatenate((data, np.full(8, END, dtype=np.uint8)))
    key = np.zeros(n, dtype=np.uint64)
    for i in range(8):
        byte = wide[i : i + n].copy()
        byte[left < i] = END
        key <<= np.uint64(8)
        key |= byte
    order = np.argsort(key)
    rank = np.empty(n, dtype=np.int64)
    new = np.concatenate(([True], key[order][1:] != key[order][:-1]))
    start = np.flatnonzero(new)
    rank[order] = np.repeat(start, np.diff(np.append(start, n)))
    size, tied = 8, np.flatnonzero(_tied(rank, n))
    if n >> 21:
        raise ValueError("over 2^21 bytes of strings at once")
    while len(tied) and size < depth:
        # Three ranks make a number; behind an end its string's number stands for the rest.
        second, third = (rank[np.minimum(tied + k * size, n - 1)] for k in (1, 2))
        near, own = left[tied], rank[tied]
        ended = near < 2 * size
        third[ended] = string[tied[ended]]
        ended = near < size
        second[ended] = string[tied[ended]]
        packed = (own << 42) | (second << 21) | third
        by = np.argsort(packed)
        tied, packed, own = tied[by], packed[by], own[by]
        # Ranks are where their group begins in the order.
        here = np.arange(len(own))
        head = np.concatenate(([True], own[1:] != own[:-1]))
        place = own + here - np.maximum.accumulate(np.where(head, here, 0))
        order[place] = tied
        fresh = np.concatenate(([True], packed[1:] != packed[:-1]))
        rank[tied] = place[np.maximum.accumulate(np.where(fresh, here, 0))]
        size *= 3
        tied = tied[~(fresh & np.concatenate((fresh[1:], [True])))]
    return order


def _tied(rank: np.ndarray, n: int) -> np.ndarray:
    return np.bincount(rank, minlength=n)[rank] > 1


class Transform:
    """A Burrows-Wheeler transform with backward extension of many intervals at once."""

    def __init__(self, data: np.ndarray, order: np.ndarray):
        self.n = len(data)
        self.bwt = data[order - 1]  # before the first string stands the last one's end
        places = np.argsort(self.bwt, kind="stable")
        self.to = np.empty(self.n, dtype=np.int64)
        self.to[places] = np.arange(self.n)
        self.letters = np.unique(data[data != END]).astype(np.int64)
        #: Where the run of equal bytes around a place ends.
        edge = np.append(np.flatnonzero(self.bwt[1:] != self.bwt[:-1]) + 1, self.n)
        self.run_end = np.repeat(edge, np.diff(edge, prepend=0))
        #: Sorted: for each byte its places in the transform.
        self.known = self.bwt[places].astype(np.int64) * (self.n + 1) + places
        before = np.full(self.n, -1, dtype=np.int64)
        after = np.full(self.n, self.n, dtype=np.int64)
        same = self.bwt[places][1:] == self.bwt[places][:-1]
        before[places[1:][same]] = places[:-1][same]
        after[places[:-1][same]] = places[1:][same]
        self.before, self.after = before, after

    def extended(self, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The intervals of every byte before the prefixes of the given, disjoint intervals."""
        # One byte stands before all: a run has one result.
        plain = self.run_end[low] >= high
        a, b = low[plain], high[plain]
        real = self.bwt[a] != END
        parts = [(self.to[a[real]], self.to[b[real] - 1] + 1)]
        low, high = low[~plain], high[~plain]
        width = high - low
        wide = width > 8 * len(self.letters)  # then a search for every byte is less than a look at every place
        if wide.any():
            code = self.letters * (self.n + 1)
            a = np.searchsorted(self.known, (code[:, None] + low[wide]).ravel())
            b = np.searchsorted(self.known, (code[:, None] + high[wide]).ravel())
            some = a < b
            parts.append((a[some], b[some]))
            low, high, width = low[~wide], high[~wide], width[~wide]
        each = np.repeat(np.arange(len(low)), width)
        at = np.arange(len(each)) - np.repeat(np.cumsum(width) - width, width) + low[each]
        real = self.bwt[at] != END
        at, each = at[real], each[real]
        # The first and the last place of a byte in an interval; results are disjoint, so sorting pairs them.
        a = np.sort(self.to[at[self.before[at] < low[each]]])
        b = np.sort(self.to[at[self.after[at] >= high[each]]]) + 1
        parts.append((a, b))
        return tuple(np.concatenate(x) for x in zip(*parts))


def long_prefixes(data: np.ndarray, order: np.ndarray, length: int) -> np.ndarray:
    """For each suffix in order, and one more, whether it shares ``length`` bytes or more with the one before."""
    table = Transform(data, order)
    n, ends = table.n, int((data == END).sum())
    unset = np.ones(n + 1, dtype=bool)
    unset[0] = unset[n] = False
    low, high = np.array([0]), np.array([n])
    for value in range(length):
        low, high = table.extended(low, high)
        if value == 0:  # ends are last, and alike in nothing
            alone = np.arange(n - ends, n)
            low, high = np.concatenate((low, alone)), np.concatenate((high, alone + 1))
        new = unset[high]
        low, high = low[new], high[new]
        unset[high] = False
        if not len(low):
            break
    return unset


def repeated(strings: list[bytes], length: int) -> list[np.ndarray]:
    """For each string where ``length`` bytes begin that also begin elsewhere in these strings."""
    data = np.frombuffer(b"".join(s + bytes([END]) for s in strings), dtype=np.uint8)
    order = suffixes(data, length)
    long = long_prefixes(data, order, length)
    found = np.sort(order[long[:-1] | long[1:]])
    starts = np.cumsum([0] + [len(s) + 1 for s in strings])
    cuts = np.searchsorted(found, starts)
    return [found[a:b] - s for a, b, s in zip(cuts, cuts[1:], starts)]


def runs(places: np.ndarray) -> Iterable[tuple[int, int]]:
    """First and last of each run of consecutive numbers."""
    edge = np.flatnonzero(np.diff(places) > 1)
    return zip(places[np.concatenate(([0], edge + 1))].tolist(), places[np.concatenate((edge, [len(places) - 1]))].tolist())


def _cutter(length: int, hot: list[KeyBits]):
    """Tasks that name all strings of all texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, texts in blocks(batches):
            raw = [r for r in (t.encode() for t in texts) if len(r) >= length]
            if not raw:
                continue
            found = Strings(raw, length, hot)
            nodes = np.array([node_of(r) for r in raw], dtype=np.int64)[found.text]
            sizes = np.array([len(r) for r in raw])[found.text]
            digests = [digest(raw[i][a : b + length]) for i, a, b in zip(found.text.tolist(), found.first.tolist(), found.last.tolist())]
            yield batch_of(STRING_SCHEMA, key=found.key, digest=digests, node_a=nodes[:, 0], node_b=nodes[:, 1], start=found.first, size=found.last - found.first + length, bytes=sizes)

    return run


def _fetcher(length: int, hot: list[KeyBits], marks: KeyBits):
    """Tasks that give the bytes of the strings that lie where a mark says, each once in a task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done: set[tuple[int, int]] = set()
        for _, texts in blocks(batches):
            raw = [r for r in (t.encode() for t in texts) if len(r) >= length]
            found = Strings(raw, length, hot)
            mark = found.key ^ np.array([node_of(r)[0] for r in raw], dtype=np.int64)[found.text] ^ found.first
            some = marks.bits[mark % marks.size]
            keys, digests, strings = [], [], []
            for k, i, a, b in zip(*(x[some].tolist() for x in (found.key, found.text, found.first, found.last))):
                string = raw[i][a : b + length]
                name = (k, digest(string))
                if name not in done:
                    done.add(name)
                    keys.append(k)
                    digests.append(name[1])
                    strings.append(string)
            if keys:
                yield batch_of(TEXT_SCHEMA, key=keys, digest=digests, string=strings)

    return run


def _expander(length: int):
    """Tasks that transform whole anchors, one after another, and give the runs of windows that repeat."""

    def solved(held: list[tuple[int, int, int, bytes]]) -> pa.RecordBatch:
        rows = [
            (key, d, a, b + length) for (key, d, n, s), found in zip(held, repeated([h[3] for h in held], length))
            for a, b in ([(0, len(s) - length)] if n > 1 else runs(found) if len(found) else [])
        ]
        return batch_of(RUN_SCHEMA, **dict(zip(RUN_SCHEMA.names, map(list, zip(*rows)))) if rows else dict.fromkeys(RUN_SCHEMA.names, []))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[int, int, int, bytes]] = []
        size, key = 0, None
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                if row[0] != key and size >= BLOCK_BYTES:
                    yield solved(held)
                    held, size = [], 0
                key = row[0]
                held.append(row)
                size += len(row[3])
        if held:
            yield solved(held)

    return run


def _paired(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by key and digest: the number of each wanted string with its bytes, whatever tasks found them."""
    key, n, string = None, None, None
    for batch in batches:
        out: list[tuple] = []
        for k, d, count, s in zip(*(c.to_pylist() for c in batch.columns)):
            if (k, d) != key:
                if n is not None and string is not None:
                    out.append((*key, n, string))
                key, n, string = (k, d), None, None
            n, string = (count if n is None else n), (s if string is None else string)
        if out:
            yield batch_of(PAIR_SCHEMA, **dict(zip(PAIR_SCHEMA.names, map(list, zip(*out)))))
    if n is not None and string is not None:
        yield batch_of(PAIR_SCHEMA, key=[key[0]], digest=[key[1]], n=[n], string=[string])


def _merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Joins the runs of a text to spans, end exclusive."""
    for batch in batches:
        a, b, sizes, all_spans = (c.to_pylist() for c in batch.columns)
        out = []
        for spans_of_one in all_spans:
            joined: list[list[int]] = []
            for s in sorted(spans_of_one, key=lambda x: x["low"]):
                if joined and s["low"] <= joined[-1][1]:
                    joined[-1][1] = max(joined[-1][1], s["high"])
                else:
                    joined.append([s["low"], s["high"]])
            out.append(joined)
        yield batch_of(SPAN_SCHEMA, node_a=a, node_b=b, bytes=sizes, spans=out)


SPAN_SCHEMA = pa.schema([("node_a", pa.int64()), ("node_b", pa.int64()), ("bytes", pa.int64()), ("spans", pa.list_(pa.list_(pa.int64())))])


def _passing(rows: DataFrame, column: str, bits: KeyBits, yes: bool = True) -> DataFrame:
    """The rows whose number in a column has its bit set, or those for which it is not."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hit = bits.bits[batch.column(column).to_numpy(zero_copy_only=False) % bits.size]
            yield batch.filter(pa.array(hit if yes else ~hit))

    return mapped(rows, run, rows.schema)


def spans(docs: DataFrame, length: int = LENGTH, most: int = MOST_STRINGS) -> DataFrame:
    """``node_a, node_b, bytes, spans``: for each text with repeats its size and its maximal runs of covered bytes, end exclusive."""
    texts = docs.select(F.col("text").cast("string").alias("text"))
    hot: list[KeyBits] = []
    found = []
    while True:
        schema = "key long, digest long, node_a long, node_b long, start long, size int, bytes long"
        strings = staged(mapped(texts, _cutter(length, hot), schema))
        mark = F.col("key").bitwiseXOR(F.col("node_a")).bitwiseXOR(F.col("start"))
        forms = staged(strings.groupBy("key", "digest").agg(
            F.count(F.lit(1)).alias("n"), F.min(mark).alias("mark"), F.min("size").alias("size")
        ))
        keys = forms.groupBy("key").agg(F.sum("n").alias("strings"), F.count(F.lit(1)).alias("forms")).where("strings > 1")
        keys = staged(keys.select("key", "forms"))
        too_many = keys.where(F.col("forms") > most).select("key")
        many = key_bits(too_many, "key", hashed=False, at_once=True) if too_many.head(1) else None
        # What shares a bit with an anchor of too many strings is cut as well, so that all strings of an anchor are.
        repeated_keys = _passing(keys, "key", many, False) if many else keys
        bits = key_bits(repeated_keys, "key", hashed=False, at_once=True)
        some = staged(_passing(forms, "key", bits).join(repeated_keys, "key"))
        runs_here = some.where("forms = 1").select("key", "digest", F.lit(0).alias("low"), F.col("size").alias("high"))
        several = some.where("forms > 1")
        if several.head(1):
            runs_here = runs_here.unionByName(_runs(texts, several, length, hot))
        found.append(
            _passing(strings, "key", bits).join(runs_here, ["key", "digest"])
            .select("node_a", "node_b", "bytes", (F.col("start") + F.col("low")).alias("low"), (F.col("start") + F.col("high")).alias("high"))
            .distinct()
        )
        if not many:
            break
        hot.append(many)
    whole = found[0]
    for more in found[1:]:
        whole = whole.unionByName(more)
    per_text = whole.groupBy("node_a", "node_b", "bytes").agg(F.collect_list(F.struct("low", "high")).alias("spans"))
    return mapped(per_text, _merge, "node_a long, node_b long, bytes long, spans array<array<bigint>>")


def _runs(texts: DataFrame, wanted: DataFrame, length: int, hot: list[KeyBits]) -> DataFrame:
    """``key, digest, low, high``: the bytes of the wanted strings that repeated windows cover, run by run."""
    marks = key_bits(wanted, "mark", hashed=False, at_once=True)
    fetched = mapped(texts, _fetcher(length, hot, marks), "key long, digest long, string binary")
    both = wanted.select("key", "digest", "n", F.lit(None).cast("binary").alias("string")).unionByName(
        fetched.select("key", "digest", F.lit(None).cast("long").alias("n"), "string")
    )
    # A text in many tasks brings its strings from each, so those are put together before strings of an anchor meet.
    paired = mapped(
        both.repartition("key", "digest").sortWithinPartitions("key", "digest"), _paired, "key long, digest long, n long, string binary"
    )
    dealt = paired.repartition("key").sortWithinPartitions("key")
    return staged(mapped(dealt, _expander(length), "key long, digest long, low int, high int"))


def _reader(length: int, partly: KeyBits):
    """Tasks that size every text; only those that may keep a part go on with their bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = None
        for rows, texts in blocks(batches):
            raw = [t.encode() for t in texts]
            nodes = [node_of(r) for r in raw]
            go = [len(r) >= length and bool(partly.bits[n[0] % partly.size]) for r, n in zip(raw, nodes)]
            schema = schema or pa.schema(
                [rows.schema.field("doc_id"), ("node_a", pa.int64()), ("node_b", pa.int64()), ("n_bytes", pa.int64()), ("whole", pa.string()), ("raw", pa.binary())]
            )
            yield batch_of(
                schema, doc_id=rows.column("doc_id"), node_a=[n[0] for n in nodes], node_b=[n[1] for n in nodes], n_bytes=[len(r) for r in raw],
                whole=[hashlib.sha256(r).hexdigest() for r in raw], raw=[r if g else None for r, g in zip(raw, go)],
            )

    return run


EMPTY = hashlib.sha256(b"").hexdigest()


def _writer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """What is left of each document, and how much went."""
    schema = None
    for batch in batches:
        schema = schema or pa.schema(
            [batch.schema.field("doc_id"), ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()), ("kept_sha256", pa.string()), ("kept", pa.binary())]
        )
        removed, counts, sums, left = [], [], [], []
        for size, whole, raw, own in zip(*(batch.column(c).to_pylist() for c in ("n_bytes", "whole", "raw", "spans"))):
            own = own or []
            gone = sum(b - a for a, b in own)
            if own and gone < size:
                edges = [0, *(x for s in own for x in s), size]
                rest = b"".join(raw[a:b] for a, b in zip(edges[::2], edges[1::2]))
                whole = hashlib.sha256(rest).hexdigest()
            else:
                rest, whole = (b"", EMPTY) if own else (None, whole)
            removed.append(gone)
            counts.append(len(own))
            sums.append(whole)
            left.append(rest)
        yield batch_of(schema, doc_id=batch.column("doc_id"), n_bytes=batch.column("n_bytes"), n_removed=removed, n_spans=counts, kept_sha256=sums, kept=left)


def without_repeats(docs: DataFrame, length: int = LENGTH, most: int = MOST_STRINGS) -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept_sha256, kept``: documents without bytes that repeats cover.

    ``kept`` is the rest of a text that lost some, null for a text that lost nothing.
    """
    found = staged(spans(docs, length, most))
    rows = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    kind = dict(rows.dtypes)["doc_id"]
    # Texts that go as a whole are not needed again. A text that keeps a part has no copy, so each is needed once.
    partly = key_bits(found.where(F.col("spans")[0][1] - F.col("spans")[0][0] < F.col("bytes")), "node_a", hashed=False, at_once=True)
    sized = mapped(rows, _reader(length, partly), f"doc_id {kind}, node_a long, node_b long, n_bytes long, whole string, raw binary")
    joined = sized.join(found.drop("bytes"), ["node_a", "node_b"], "left")
    return mapped(joined, _writer, f"doc_id {kind}, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary")


def op11_bwt_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents without the bytes that any 400 bytes starting elsewhere too cover."""
    done = without_repeats(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return done.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


#: The same in SQL: every window of every text by its checksum. Texts are cut into chunks of 1,000 windows to keep places short.
SQL = """
WITH texts AS (
  SELECT row_number() OVER () AS n, doc_id, hex(encode(coalesce(text, ''))) AS x FROM documents
), chunks AS (
  SELECT n, c, substring(x, CAST(2000 * c + 1 AS BIGINT), 2798) AS part FROM (SELECT n, x, unnest(range(CAST(length(x) // 2000 + 1 AS BIGINT))) AS c FROM texts)
), windows AS (
  SELECT n, 1000 * c + i AS start, md5(substring(part, CAST(2 * i + 1 AS BIGINT), 800)) AS mark
  FROM (SELECT n, c, part, unnest(range(least(1000, length(part) // 2 - 399))) AS i FROM chunks WHERE length(part) >= 800)
), known AS (
  SELECT mark FROM windows GROUP BY mark HAVING count(*) > 1
), starts AS (
  SELECT n, start, lag(start) OVER (PARTITION BY n ORDER BY start) AS before FROM windows SEMI JOIN known USING (mark)
), islands AS (
  SELECT n, start, sum(CASE WHEN before IS NULL OR start > before + 400 THEN 1 ELSE 0 END) OVER (PARTITION BY n ORDER BY start) AS island FROM starts
), spans AS (
  SELECT n, min(start) AS low, max(start) + 400 AS high FROM islands GROUP BY n, island
), gaps AS (
  SELECT n, coalesce(lag(high) OVER (PARTITION BY n ORDER BY low), 0) AS low, low AS high FROM spans
  UNION ALL SELECT n, max(high), NULL FROM spans GROUP BY n
), rest AS (
  SELECT n, string_agg(substring(x, CAST(2 * low + 1 AS BIGINT), CAST(2 * (coalesce(high, length(x) // 2) - low) AS BIGINT)), '' ORDER BY low) AS kept
  FROM gaps JOIN texts USING (n) GROUP BY n
), gone AS (
  SELECT n, sum(high - low) AS removed, count(*) AS spans FROM spans GROUP BY n
)
SELECT doc_id, CAST(length(x) // 2 AS BIGINT) AS n_bytes, CAST(coalesce(removed, 0) AS BIGINT) AS n_removed,
       CAST(coalesce(spans, 0) AS BIGINT) AS n_spans, sha256(unhex(CASE WHEN gone.n IS NULL THEN x ELSE kept END)) AS kept_sha256
FROM texts LEFT JOIN gone USING (n) LEFT JOIN rest USING (n)
"""
