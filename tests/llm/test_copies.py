import random
from collections import defaultdict

import numpy as np
import pytest

from headway.llm import copies as C


def grams(text):
    words = (text or "").lower().split()
    n = min(5, len(words))
    return frozenset(tuple(words[i : i + n]) for i in range(len(words) - n + 1)) if n else frozenset()


def brute(rows):
    """Class and links of every row, by comparing all pairs; texts without words are equal to each other."""
    sets = [grams(t) for _, t in rows]
    parent = list(range(len(rows)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    links = [0] * len(rows)
    for i in range(len(rows)):
        for j in range(i):
            a, b = sets[i], sets[j]
            if a == b or len(a & b) >= 0.8 * len(a | b) - 1e-9:
                links[i] += 1
                links[j] += 1
                parent[find(i)] = find(j)
            if rows[i][0] == rows[j][0]:
                parent[find(i)] = find(j)
    least = defaultdict(lambda: 1 << 60)
    for i, (d, _) in enumerate(rows):
        least[find(i)] = min(least[find(i)], d)
    return sorted((d, least[find(i)], links[i]) for i, (d, _) in enumerate(rows))


def found(spark, rows, **more):
    out = C.near_copies(spark.createDataFrame(rows, "doc_id long, text string"), **more)
    return sorted((r["doc_id"], r["class_id"], r["n_links"]) for r in out.collect())


def family(chance, size, length, edits):
    words = [f"w{chance.randint(0, 5000)}" for _ in range(length)]
    out = []
    for _ in range(size):
        own = list(words)
        for _ in range(chance.randint(0, edits)):
            own[chance.randrange(length)] = f"x{chance.randint(0, 10**6)}"
        out.append(" ".join(own))
    return out


def test_all_documents(spark, sf):
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    got = C.op5_minhash_jaccard(spark, sf).collect()
    assert sorted((r["doc_id"], r["class_id"], r["n_links"]) for r in got) == brute(docs)


def test_families_and_exact_copies(spark):
    chance = random.Random(4)
    texts = [t for _ in range(12) for t in family(chance, 8, 120, 5)] + family(chance, 60, 200, 6) + ["the very same text of six words"] * 40
    chance.shuffle(texts)
    rows = list(enumerate(texts))
    assert found(spark, rows, recall=0.999999) == brute(rows)


def test_a_large_family_is_cut_into_blocks(spark, monkeypatch):
    chance = random.Random(5)
    rows = list(enumerate(family(chance, 300, 150, 6)))
    # Set for the driver, which plans the blocks.
    monkeypatch.setattr(C, "BLOCK_NODES", 40)
    assert found(spark, rows, recall=0.999999) == brute(rows)


def test_edges(spark, edges, empty):
    kept = edges.where("doc_id IS NOT NULL").collect()
    got = C.near_copies(edges).collect()
    assert sorted((r["doc_id"], r["class_id"], r["n_links"]) for r in got) == brute([(r["doc_id"], r["text"]) for r in kept])
    assert C.near_copies(empty).count() == 0
    assert found(spark, [(1, "same id one"), (1, "same id two other"), (2, "same id one")]) == [(1, 1, 0), (1, 1, 1), (2, 1, 1)]


def test_one_of_each_keeps_columns_and_rows_without_id(edges):
    out = C.one_of_each(edges)
    assert out.columns == edges.columns
    ids = sorted((r["doc_id"] for r in out.collect()), key=str)
    # -8 stands for 1, 1 and itself; 2 stands for 3 and 5, which have no words either.
    assert ids == sorted([-8, 2, 4, 6, 7, None, None], key=str)


def test_components_of_a_path(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(200)] + [(500, 501)], "a long, b long")
    roots = {r["node"]: r["root"] for r in C.components(edges).collect()}
    assert all(roots[i] == 0 for i in range(1, 201)) and roots[501] == 500


def test_band_count_reaches_the_recall():
    for rows in (3, 5, 8):
        n = C.band_count(0.8, 0.999, rows)
        assert 1 - (1 - 0.8**rows) ** n >= 0.999 > 1 - (1 - 0.8**rows) ** (n - 1)


def test_intersections_by_products():
    chance = np.random.default_rng(1)
    sets = [np.unique(chance.integers(0, 6000, n).astype(np.uint64)) for n in (0, 1, 50, 3000, 2999, 7)]
    left, right = np.array([0, 2, 4]), np.array([1, 3, 5])
    want = [[len(np.intersect1d(sets[i], sets[j])) for j in right] for i in left]
    assert C._common(sets, left, right).tolist() == want
    every = np.arange(6)
    square = C._common(sets, every, every)
    assert all(square[i, j] == len(np.intersect1d(sets[i], sets[j])) for i in every for j in every if i != j)


@pytest.mark.parametrize("text", ["", "a", "a b c d e f"])
def test_sets_of_short_texts(text):
    assert len(C.gram_sets([text])[0]) == len(grams(text))


def test_every_text_of_an_id_is_compared(spark):
    chance = random.Random(6)
    texts = [t for _ in range(12) for t in family(chance, 2, 80, 2)] + family(chance, 3, 60, 0)
    # One id for every other text; the rest have their own.
    rows = [(7 if i % 2 else 100 + i, t) for i, t in enumerate(texts)] + [(500, "some other words that stand alone here")]
    assert found(spark, rows, recall=0.999999) == brute(rows)


def test_rows_without_id_are_documents_of_the_query(spark):
    rows = [(3, "one two three four five six"), (None, "one two three four five six"), (None, "alone"), (None, "alone"), (None, None), (4, "four")]
    out = C.near_copies(spark.createDataFrame(rows, "doc_id long, text string"), without_id=True)
    got = sorted((tuple(r) for r in out.select("doc_id", "class_id", "n_links", "n_copies").collect()), key=str)
    assert got == sorted([(3, 3, 1, 2), (None, 3, 1, 2), (None, None, 1, 2), (None, None, 1, 2), (None, None, 0, 1), (4, 4, 0, 1)], key=str)


def test_one_of_each_judges_every_text(spark):
    chance = random.Random(7)
    (a, b), (c, d), e = family(chance, 2, 80, 0), family(chance, 2, 80, 1), "some words of their own"
    rows = [(1, a), (2, b), (1, c), (1, c), (3, d), (1, e), (None, a), (None, "no id here"), (None, "no id here"), (None, None), (None, ""), (9, "")]
    got = sorted(map(tuple, C.one_of_each(spark.createDataFrame(rows, "doc_id long, text string")).collect()), key=str)
    assert got == sorted([(1, a), (1, c), (1, e), (None, "no id here"), (None, None), (None, ""), (9, "")], key=str)
