import hashlib
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from headway.llm import repeats as R


def brute(texts, length):
    """Size, removed bytes, spans and checksum of the rest of each text, window by window."""
    raws = [(t or "").encode() for t in texts]
    seen = Counter(r[i : i + length] for r in raws for i in range(len(r) - length + 1))
    out = []
    for r in raws:
        gone = bytearray(len(r))
        for i in range(len(r) - length + 1):
            if seen[r[i : i + length]] > 1:
                gone[i : i + length] = b"\1" * length
        kept = bytes(x for x, g in zip(r, gone) if not g)
        starts = sum(1 for i, g in enumerate(gone) if g and (i == 0 or not gone[i - 1]))
        out.append((len(r), sum(gone), starts, hashlib.sha256(kept).hexdigest()))
    return out


def found(df):
    return sorted((tuple(r) for r in df.drop("kept").collect()), key=str)


def wanted(rows, length):
    return sorted(((r[0], *b) for r, b in zip(rows, brute([r[1] for r in rows], length))), key=str)


def test_common_prefixes_by_expansion():
    chance = random.Random(4)
    for n in range(200):
        length = chance.choice([1, 2, 3, 5, 8, 9, 24, 30])
        base = bytes(chance.choice(b"ab" if n % 2 else b"abcdefgh") for _ in range(chance.randint(1, 200)))
        strings = []
        for _ in range(chance.randint(1, 6)):
            a, b = sorted(chance.choices(range(len(base) + 1), k=2))
            strings.append(base[a:b] + bytes(chance.choice(b"abc") for _ in range(chance.randint(0, 20))))
        if n % 10 == 0:
            strings.append(b"a" * 300)
        seen = Counter(s[i : i + length] for s in strings for i in range(len(s) - length + 1))
        expected = [[i for i in range(len(s) - length + 1) if seen[s[i : i + length]] > 1] for s in strings]
        assert [x.tolist() for x in R.repeated(strings, length)] == expected


def test_strings_hold_every_window_once():
    chance = random.Random(5)
    texts = [bytes(chance.choice(b"abcd") for _ in range(chance.randint(40, 900))) for _ in range(30)]
    for length in (2, 7, 40):
        got = R.Strings(texts, length, [])
        windows = Counter((i, p) for i, a, b in zip(got.text.tolist(), got.first.tolist(), got.last.tolist()) for p in range(a, b + 1))
        assert windows == Counter((i, p) for i, t in enumerate(texts) for p in range(len(t) - length + 1))
        key_of = {}
        for k, i, a, b in zip(got.key.tolist(), got.text.tolist(), got.first.tolist(), got.last.tolist()):
            for p in range(a, b + 1):  # equal windows have equal keys
                assert key_of.setdefault(texts[i][p : p + length], k) == k


def test_slices_lose_no_window(monkeypatch):
    chance = random.Random(6)
    texts = [bytes(chance.choice(b"abcd") for _ in range(n)) for n in (5000, 39, 40, 41, 2500)]
    monkeypatch.setattr(R, "SLICE", 700)
    monkeypatch.setattr(R, "PIECES", 900)
    got = R.Strings([t for t in texts if len(t) >= 40], 40, [])
    windows = Counter((i, p) for i, a, b in zip(got.text.tolist(), got.first.tolist(), got.last.tolist()) for p in range(a, b + 1))
    assert set(windows.values()) == {1} and len(windows) == 4961 + 1 + 2 + 2461


@pytest.mark.parametrize("length,most", [(50, 1024), (50, 2), (9, 2)])
def test_against_brute_force(spark, length, most):
    """With ``most`` 2 nearly every repeated anchor is cut further."""
    chance = random.Random(7)
    words = ["alpha", "beta", "gamma", "delta", "épsilon", "ζ"]
    passages = [" ".join(chance.choice(words) for _ in range(chance.randint(5, 30))) for _ in range(6)]
    rows = []
    for i in range(60):
        parts = [chance.choice(passages) if chance.random() < 0.4 else "%030x" % chance.getrandbits(120) for _ in range(chance.randint(0, 6))]
        rows.append((i % 50, " ".join(parts)))
    rows += [(100, rows[3][1]), (101, "x" * 300), (102, ""), (103, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    assert found(R.without_repeats(df, length, most)) == wanted(rows, length)


def test_kept_bytes(spark):
    same = "one passage that stands in both of these texts, word by word"
    df = spark.createDataFrame([("a", "first " + same), ("b", same + " last"), ("c", "alone")], "doc_id string, text string")
    got = {r["doc_id"]: r["kept"] and bytes(r["kept"]).decode() for r in R.without_repeats(df, 20).collect()}
    assert got == {"a": "first ", "b": " last", "c": None}


def test_edges(spark, edges, empty):
    rows = [(r["doc_id"], r["text"]) for r in edges.collect()]
    got = found(R.without_repeats(edges))
    assert got == wanted(rows, 400)
    assert R.without_repeats(empty).count() == 0
    assert R.without_repeats(edges.where(F.col("text").isNull())).select("n_bytes", "n_spans").distinct().collect() == [(0, 0)]


def test_a_common_passage_under_the_length_is_no_repeat(spark):
    """A line in every text, other words around: one anchor with a string for each text, and nothing to remove."""
    rows = [(i, f"{i:040d}" + "the same line in every text " * 1 + f"{i * 7919:060d}") for i in range(300)]
    got = R.without_repeats(spark.createDataFrame(rows, "doc_id long, text string"), 50, 16)
    assert got.where("n_removed > 0").count() == len([w for w in wanted(rows, 50) if w[2]])
    assert found(got) == wanted(rows, 50)


def test_suffix_order_with_many_ends():
    strings = [b"ab", b"b", b"ab", b"", b"abab"]
    data = np.frombuffer(b"".join(s + b"\xff" for s in strings), dtype=np.uint8)
    order = R.suffixes(data, 400)
    ends = np.flatnonzero(data == 255)

    def key(i):
        end = np.searchsorted(ends, i)
        return data[i : ends[end]].tobytes() + b"\xff", end

    assert order.tolist() == sorted(range(len(data)), key=key)
