import re
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from headway.llm import divergence as D


def brute(rows, least=3, top=200):
    """Every term of every pair, with Python's integers."""
    found = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
    lower = str.maketrans(D.UPPER, D.LOWER)
    docs = [(lang or "", source or "", found.findall((text or "").translate(lower))) for text, lang, source in rows]
    out = []
    for lang in {d[0] for d in docs}:
        own = [d for d in docs if d[0] == lang]
        held = Counter(t for _, _, terms in own for t in set(terms))
        kept = sorted(t for t, n in held.items() if n >= least)
        counts = defaultdict(Counter)
        for _, source, terms in own:
            counts[source].update(t for t in terms if held[t] >= least)

        def shares(c):
            return {t: 1 + 10**9 * (c[t] + 1) // (sum(c.values()) + len(kept)) for t in kept}

        p = {s: shares(counts[s]) for s in {d[1] for d in own}}
        q = shares(sum(counts.values(), Counter()))
        for s in p:
            pairs = [(sum((p[s][t] - p[o][t]) ** 2 // p[o][t] for t in kept), o) for o in p if o != s]
            terms = [((p[s][t] - q[t]) ** 2 // q[t], t) for t in kept if counts[s][t] and p[s][t] > q[t]]
            for part, values in (("pair", pairs), ("term", terms)):
                values.sort(key=lambda x: (-x[0], x[1].encode()))
                out += [(lang, s, part, item, v, i + 1) for i, (v, item) in enumerate(values) if part == "pair" or i < top]
    return sorted(out)


def table(spark, rows):
    return spark.createDataFrame(rows, "text string, lang string, source string")


ROWS = [
    ("Alpha beta ALPHA it's", "en", "a"), ("alpha gamma beta", "en", "b"), ("alpha beta beta", "en", "c"), ("delta alpha gamma", "en", "b"),
    ("alpha gamma", "en", "a"), (None, "en", "silent"), ("Äpfel äpfel ÄPFEL", "de", "a"), ("äpfel Äpfel 12x", "de", "b"),
    ("äpfel", "de", None), ("Äpfel x", "de", "b"), ("x x", "de", ""), ("only twice", "fr", "a"), ("only twice", "fr", "b"),
    ("no lang here", None, "a"), ("no lang here", "", "b"), ("lang no", None, "b"), ("one two one", "it", "a"), ("one", "it", "a"), ("one two", "it", "a"),
]


@pytest.mark.parametrize("slice_terms,pairs", [(D.SLICE_TERMS, D.PAIRS), (3, 1)])
def test_against_brute_force(spark, monkeypatch, slice_terms, pairs):
    """With terms in several slices, and pairs evaluated one row at a time."""
    monkeypatch.setattr(D, "SAMPLED", 1.0)
    monkeypatch.setattr(D, "PAIRS", pairs)
    got = D.audit(table(spark, ROWS).repartition(3), slice_terms=slice_terms)
    assert sorted(map(tuple, got.collect())) == brute(ROWS)
    assert got.columns == ["lang", "source", "part", "item", "value", "rank"]


def test_ranks_end_at_the_top(spark):
    assert sorted(map(tuple, D.audit(table(spark, ROWS * 2), top=1).collect())) == brute(ROWS * 2, top=1)


def test_query_equals_sql(spark, sf):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{sf}/documents.parquet'")
    cur = con.execute(D.SQL)
    got = D.op13_source_divergence(spark, sf)
    assert got.columns == [d[0] for d in cur.description]
    assert sorted(map(tuple, got.collect())) == sorted(cur.fetchall())


def test_edges(spark, edges, empty):
    rows = [(r["text"], r["lang"], r["source"]) for r in edges.collect()]
    clash = edges.withColumn("term", F.lit("t")).withColumn("place", F.lit("p")).withColumn("lang_key", F.lit("k"))
    assert sorted(map(tuple, D.audit(clash).collect())) == brute(rows)
    assert D.audit(empty).collect() == []


def test_large_counts_do_not_overflow(spark):
    row = spark.createDataFrame([(9_000_000_000_000, 9_500_000_000_000, 10)], "c long, n long, v long")
    p = row.select(D.share(F.col("c"), F.col("n"), F.col("v"))).first()[0]
    assert p == 1 + 10**9 * (9_000_000_000_000 + 1) // (9_500_000_000_000 + 10)


def test_pairs_of_a_block_do_not_matter(monkeypatch):
    chance = np.random.default_rng(3)
    term = np.sort(chance.integers(0, 40, 300))
    at = np.concatenate([chance.permutation(25)[: (term == t).sum()] for t in range(40)])
    count = chance.integers(1, 50, 300)
    of = D.Sizes([str(i) for i in range(25)], chance.integers(100, 900, 25), 40)
    whole = [x.tolist() for x in D._both(of, term, at, count)]
    p0 = of.share(np.zeros(25, dtype=np.int64), np.arange(25))
    want = Counter()
    for t in range(40):
        own = [(int(s), int(c)) for s, c in zip(at[term == t], count[term == t])]
        f = lambda p, q: (p - q) ** 2 // q
        share = lambda s, c: 1 + 10**9 * (c + 1) // (int(of.sizes[s]) + 40)
        for a, m in own:
            for b, n in own:
                if a != b:
                    p, q, x, y = share(a, m), share(b, n), int(p0[a]), int(p0[b])
                    want[a, b] += f(p, q) - f(p, y) - f(x, q) + f(x, y)
    assert dict(zip(zip(*whole[:2]), whole[2])) == {k: v for k, v in want.items()}
    for pairs in (1, 7, 100):
        monkeypatch.setattr(D, "PAIRS", pairs)
        assert [x.tolist() for x in D._both(of, term, at, count)] == whole
    large = D.Sizes(["a"], np.array([3 * 10**13]), 40)
    assert large.share(np.array([10**13]), np.array([0]))[0] == 1 + 10**9 * (10**13 + 1) // (3 * 10**13 + 40)


@pytest.mark.parametrize("most,at_once", [(1, 2), (40, 5), (D.FOLD_BYTES, D.FOLD_TERMS)])
def test_vectorizers_are_given_folded_documents(monkeypatch, most, at_once):
    """However much is folded: documents to fit on keep who is held three times, those to transform every count, in few terms."""
    monkeypatch.setattr(D, "FOLD_TERMS", at_once)
    rows = [(t or "", lang or "", s or "") for t, lang, s in ROWS] + [("often " * 1000, "en", "a")] + [("Often É\x00é it's", "en", "b")] * 50
    batch = pa.record_batch([pa.array(x) for x in zip(*rows)], ["text", "lang", "source"])
    parts = [r for b in D._folder(3, most)(iter([batch.slice(0, 7), batch.slice(7)])) for r in b.to_pylist()]
    held, counts, want_held, want = Counter(), Counter(), Counter(), Counter()
    for r in parts:
        assert len(set(r["terms"])) == len(r["terms"]) <= at_once
        for t in r["terms"]:
            (counts if r["weight"] else held)[(r["lang"], r["source"], t) if r["weight"] else (r["lang"], t)] += r["weight"] or 1
    for text, lang, source in rows:
        terms = re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", text.translate(str.maketrans(D.UPPER, D.LOWER)))
        want.update((lang, source, t) for t in terms)
        want_held.update({(lang, t) for t in terms})
    assert counts == want
    assert {t for t, n in held.items() if n >= 3} == {t for t, n in want_held.items() if n >= 3}
    assert {(r["lang"], r["source"]) for r in parts if r["weight"]} == {r[1:] for r in rows}
    assert sum(r["documents"] for r in parts) == len(rows)
    if most == D.FOLD_BYTES:
        assert sum(len(r["terms"]) for r in parts) < sum(want.values()) / 4 and max(held.values()) == 3
