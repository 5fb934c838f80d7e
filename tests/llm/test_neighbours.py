import math

import numpy as np
import pytest

from headway.llm import neighbours as N


def brute(rows, k, ask):
    ids = np.array([i for i, _ in rows])
    x = np.array([v for _, v in rows], dtype=float)
    out = {}
    for i, v in rows:
        if ask(i):
            score = x @ np.array(v, dtype=float)
            order = [j for j in np.lexsort((ids, -score)) if ids[j] != i][:k]
            out.setdefault(i, [(int(ids[j]), float(score[j])) for j in order])
    return out


def searched(spark, rows, k, ask="vec_id % 20 = 0", **more):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    out = {}
    for r in sorted(N.search(df, df.where(ask), k, **more).collect(), key=lambda r: (r["query_id"], r["rank"])):
        out.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
        assert r["rank"] == len(out[r["query_id"]])
    return out


def test_recall_of_the_query(spark, sf):
    rows = [(r["vec_id"], r["embedding"]) for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()]
    want = brute(rows, 20, lambda i: i % 20 == 0)
    got = {}
    for r in N.op3_multi_index_hashing(spark, sf).collect():
        got.setdefault(r["query_id"], {})[r["vec_id"]] = r["score"]
    assert got.keys() == want.keys() and all(len(v) == 20 for v in got.values())
    right = sum(len(got[q].keys() & {i for i, _ in near}) for q, near in want.items())
    assert right >= 0.9 * 20 * len(want)
    for q, near in want.items():
        for i, score in near:
            assert i not in got[q] or math.isclose(got[q][i], score, abs_tol=1e-12)


def test_recall_with_blocks_and_unequal_lengths(spark):
    chance = np.random.default_rng(5)
    x = chance.normal(size=(3000, 24)) * chance.uniform(0.5, 2.0, (3000, 1))
    rows = [(i, [float(np.float32(a)) for a in v]) for i, v in enumerate(x)]
    want, got = brute(rows, 10, lambda i: i % 20 == 0), searched(spark, rows, 10, block=500)
    right = sum(len({i for i, _ in got[q]} & {i for i, _ in near}) for q, near in want.items())
    assert right >= 0.9 * 10 * len(want)


def test_every_code_within_the_radius_is_found():
    chance = np.random.default_rng(6)
    codes = chance.integers(0, 256, (700, 8), dtype=np.uint8)
    codes[100:400] = codes[0] ^ (1 << chance.integers(0, 8, (300, 8))).astype(np.uint8) * (chance.random((300, 8)) < 0.6)
    index = N.Index(codes)
    for q in (0, 50, 101):
        away = N.POPCOUNT[codes ^ codes[q]].sum(axis=1)
        for radius in (0, 1, 3, 7, 8, 9, 20, 64):
            assert index.within(codes[q], radius).tolist() == np.flatnonzero(away <= radius).tolist()


def test_ties_copies_and_few_rows(spark):
    rows = [(i, [1.0, 0.0, 0.0]) for i in range(300)] + [(1000, [0.0, 1.0, 0.0]), (1000, [0.0, 1.0, 0.0])]
    got = searched(spark, rows, 5)
    assert [i for i, _ in got[0]] == [1, 2, 3, 4, 5] and [i for i, _ in got[20]] == [0, 1, 2, 3, 4]
    assert len(searched(spark, rows[:3], 20)[0]) == 2
    assert searched(spark, rows[:1], 20) == {}


def test_what_takes_no_part(spark):
    nan, inf = float("nan"), float("inf")
    bad = [(40, None), (41, []), (42, [0.0, 0.0]), (43, [1.0, None]), (44, [nan, 1.0]), (45, [inf, 1.0]), (46, [1.0]), (None, [1.0, 1.0])]
    good = [(0, [1.0, 0.5]), (1, [0.5, 1.0]), (2, [-1.0, 0.0])]
    got = searched(spark, good + bad, 20)
    assert {q: [i for i, _ in v] for q, v in got.items()} == {0: [1, 2]}
    assert searched(spark, bad[:2], 20) == {}
    assert searched(spark, good, 20, ask="vec_id < 0") == {}


@pytest.mark.parametrize("n", [1, 2, 30])
def test_learning_from_few(n):
    x = np.random.default_rng(1).normal(size=(n, 4))
    coder = N.learn(x, float(np.linalg.norm(x, axis=1).max()), 20)
    assert 0 <= coder.radius <= N.BITS and coder.candidates(x).shape == (n, N.BITS // 8)


def test_a_repeated_query_has_all_its_neighbours(spark):
    rows = [(i, [1.0, i / 300, 0.0]) for i in range(1, 300)] + [(1000, [0.0, 1.0, 0.0])] * 3
    got = searched(spark, rows, 20, ask="vec_id = 1000")
    assert [i for i, _ in got[1000]] == list(range(299, 279, -1))


def test_other_vectors_under_one_query_id_have_their_own_neighbours(spark):
    rows = [(i, [1.0, i / 300, 0.0]) for i in range(1, 300)] + [(1000, [0.0, 1.0, 0.0]), (1000, [0.0, -1.0, 0.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = sorted((r["rank"], r["vec_id"]) for r in N.search(df, df.where("vec_id = 1000"), 5).collect())
    assert got == sorted((n + 1, i) for n in range(5) for i in (299 - n, 1 + n))


def test_a_third_of_the_rows_share_an_id(spark):
    """Other vectors and equal ones under one id are candidates row by row, and are spread over blocks."""
    chance = np.random.default_rng(8)
    rows = [(7 if i % 3 else i, [float(np.float32(a)) for a in v]) for i, v in enumerate(chance.normal(size=(600, 8)))]
    rows += [(7, rows[1][1])] * 50 + [(3001, rows[0][1])] * 4
    want = brute(rows, 10, lambda i: i % 20 == 0)
    got = searched(spark, rows, 10, block=100, sample=100)
    assert got.keys() == want.keys()
    right = sum(sum(a == b for a, b in zip(got[q], near)) for q, near in want.items())
    same = sum(len(set(got[q]) & set(near)) for q, near in want.items())
    assert all(len(v) == 10 for v in got.values()) and same >= 0.85 * sum(len(set(v)) for v in want.values()) and right
