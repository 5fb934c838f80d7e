import random

import numpy as np
import pytest

from headway.llm import leaks as L

WORDS = [f"zor{i}" for i in range(3000)]


def text(chance, n):
    return " ".join(chance.choices(WORDS, k=n))


def hits(texts, items):
    return L.overlaps(texts, L.Table(list(enumerate(items))))


def test_whole_items_are_found_and_nothing_else():
    chance = random.Random(1)
    items = [text(chance, n) for n in (5, 6, 8, 11, 12, 20, 60, 300)]
    for i, item in enumerate(items):
        before, after = text(chance, 40), text(chance, 40)
        got = hits([f"{before} {item.upper().replace(' ', ',  ')}. {after}", item, before + after], items)
        n = len(item.split())
        assert got[0] == {i: (40, 40 + n, n)} and got[1] == {i: (0, n, n)} and got[2] == {}


@pytest.mark.parametrize("n,changed", [(16, 2), (24, 4), (60, 9)])
def test_substitutions_are_tolerated(n, changed):
    chance = random.Random(2)
    found = 0
    for _ in range(100):
        item = text(chance, n).split()
        other = list(item)
        for i in chance.sample(range(1, n - 1), changed):
            other[i] = f"sub{i}"
        found += 0 in hits([text(chance, 30) + " " + " ".join(other) + " " + text(chance, 30)], [" ".join(item)])[0]
    assert found >= 90


def test_common_words_and_short_shared_runs_are_no_overlap():
    chance = random.Random(3)
    item = text(chance, 40)
    run = " ".join(item.split()[10:19])
    assert hits([f"{text(chance, 20)} {run} {text(chance, 20)}"], [item]) == [{}]


def test_items_too_short_name_nothing():
    assert hits(["a b c d e f"], ["a b c d", ""]) == [{}]
    assert hits([], ["a b c d e"]) == []


def test_a_window_over_two_texts_is_no_hit():
    item = " ".join(WORDS[:30])
    half = item.split()
    assert hits([" ".join(half[:11]), " ".join(half[11:22])], [item]) == [{}, {}]


def test_query_against_all_pairs(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").collect()
    items = spark.read.parquet(f"{sf}/benchmark.parquet").collect()
    grams = {}
    for r in items:
        w = r["text"].lower().split()
        for i in range(len(w) - 12):
            grams.setdefault(tuple(w[i : i + 13]), set()).add(r["item_id"])
    want = set()
    for r in docs:
        w = r["text"].lower().split()
        for i in range(len(w) - 12):
            want |= {(r["doc_id"], k) for k in grams.get(tuple(w[i : i + 13]), ())}
    got = {(r["doc_id"], r["item_id"]) for r in L.op1_spaced_seed_leaks(spark, sf).collect()}
    assert want and got >= want and len(got - want) <= 1 + len(want) // 10


def test_blocks_of_the_benchmark_give_the_same(spark, sf, monkeypatch):
    docs, items = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "benchmark"))
    whole = sorted(map(tuple, L.find_overlaps(docs, items).collect()))
    made = list(L.tables(items, 500))
    assert len(made) > 3 and sum(len(t.ids) for t in made) == items.count()
    monkeypatch.setattr(L, "tables", lambda b: iter(made))
    assert sorted(map(tuple, L.find_overlaps(docs, items).collect())) == whole


def test_edges(spark, edges, empty):
    items = spark.createDataFrame([(1, "one plain text with some words in it"), (None, None), (2, ""), (None, "wordy " * 20)], "item_id long, text string")
    got = sorted(map(tuple, L.find_overlaps(edges, items).select("doc_id", "item_id").collect()), key=str)
    assert got == sorted([(1, 1), (1, 1), (-8, 1), (4, None)], key=str)
    kept = L.without_overlaps(edges, items)
    assert kept.columns == edges.columns and kept.count() == edges.count() - 4
    assert L.without_overlaps(edges, items.limit(0)).count() == edges.count()
    assert L.find_overlaps(empty, items).count() == 0 and L.find_overlaps(edges, items.limit(0)).count() == 0


@pytest.mark.parametrize("n", range(5, 21))
def test_every_pattern_of_substitutions_is_found(n):
    from itertools import combinations, islice

    words, most = WORDS[:n], n - L.needed(n)
    table = L.Table([(7, " ".join(words))])
    patterns = list(combinations(range(n), most))
    if len(patterns) > 6000:
        patterns = random.Random(n).sample(patterns, 6000)
    texts = [" ".join(f"sub{i}" if i in p else w for i, w in enumerate(words)) for p in patterns]
    texts = [f"before it {t} and behind" if k % 2 else t for k, t in enumerate(texts)]
    assert all(f.get(7, (0, 0, 0))[2] == L.needed(n) for f in L.overlaps(texts, table))
    if most + 1 < n:
        fewer = [" ".join(f"sub{i}" if i in p else w for i, w in enumerate(words)) for p in islice(combinations(range(n), most + 1), 500)]
        assert L.overlaps(fewer, table) == [{}] * len(fewer)


def test_thirteen_of_eighteen_in_a_long_item_are_found():
    chance = random.Random(8)
    words = text(chance, 60).split()
    table = L.Table([(1, " ".join(words))])
    runs = 0
    for _ in range(600):
        inner = chance.sample(range(21, 37), 5)
        other = [w if 20 <= i < 38 and i not in inner else f"sub{i}" for i, w in enumerate(words)]
        run = L.best_run(np.array([v == w for v, w in zip(other, words)]))
        if run[2] == 13:
            runs += 1
            assert L.overlaps([" ".join(other)], table) == [{1: run}]
    assert runs > 300


def test_the_longest_of_equal_runs_counts():
    assert L.best_run(np.array([1, 1, 1, 0, 1], bool)) == (0, 5, 4) and L.best_run(np.array([1, 0, 1, 1, 1], bool)) == (0, 5, 4)


def test_signs_and_blanks_of_any_script_part_words():
    item = "the quick brown fox didn't jump over any lazy dogs today"
    other = "The\u00a0quick\u3000brown\u2014fox \u201cdidn\u2019t\u201d jump\u2009over\u2026any la\u00adzy dogs\uff0ctoday\u3002"
    assert hits([other, f"so\u00a0{other}\u00a0he said"], [item]) == [{0: (0, 12, 12)}, {0: (1, 13, 12)}]
    assert hits(["\u00e9t\u00e9 na\u00efve \u043c\u0438\u0440 e\u0301t \u0939\u093f\u0928\u094d\u0926\u0940"], ["\u00e9t\u00e9, na\u00efve. \u043c\u0438\u0440! e\u0301t? \u0939\u093f\u0928\u094d\u0926\u0940"]) == [{0: (0, 5, 5)}]


@pytest.mark.parametrize("item", ["\u4eca\u5929\u5929\u6c14\u5f88\u597d\u6211\u4eec\u53bb\u516c\u56ed", "\u6771\u4eac\u306b\u884c\u304d\u307e\u3057\u305f", "\u0e2a\u0e27\u0e31\u0e2a\u0e14\u0e35\u0e0a\u0e32\u0e27\u0e42\u0e25\u0e01"])
def test_scripts_without_blanks_are_taken_by_characters(item):
    n = len(item)
    got = hits([item, f"\u524d\u6587{item}\u3002\u540e", item[::-1]], [item])
    assert got == [{0: (0, n, n)}, {0: (2, 2 + n, n)}, {}]


def test_texts_that_are_a_short_item():
    assert hits(["Yes, it is!", "yes it is so", "\u4f60\u597d", ""], ["yes it is", "\u4f60\u597d", ""]) == [{0: (0, 3, 3)}, {}, {1: (0, 2, 2)}, {}]
