import hashlib
import math

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from headway.llm import centroids as C


def brute(vectors, k, rounds):
    """Clusters and squared distances, and the final centroids, with Python's integers."""
    x = [[math.floor(1024 * v) for v in e] for _, e in vectors]
    order = sorted(range(len(x)), key=lambda i: (hashlib.sha256(f"3:{'' if vectors[i][0] is None else vectors[i][0]}".encode()).hexdigest(), x[i]))
    centres = [x[i] for i in order[:k]]

    def assign():
        out = []
        for p in x:
            d = [sum((a - b) ** 2 for a, b in zip(p, c)) for c in centres]
            out.append((d.index(min(d)), min(d)))
        return out

    for _ in range(rounds):
        done = assign()
        for c in range(len(centres)):
            own = [p for p, (a, _) in zip(x, done) if a == c]
            if own:
                centres[c] = [sum(v) // len(own) for v in zip(*own)]
    return assign(), centres


@pytest.mark.parametrize("span,leaf", [(2, 1), (5, 2), (3000, 2), (3000, 5)])
def test_search_equals_all_distances(span, leaf):
    chance = np.random.default_rng(span + leaf)
    for _ in range(30):
        d, k = int(chance.integers(1, 8)), int(chance.integers(1, 60))
        centres, x = chance.integers(-span, span + 1, (k, d)), chance.integers(-span, span + 1, (400, d))
        number, away = C.Search(centres, C.tree(centres, leaf)).nearest(x)
        every = ((x[:, None] - centres[None]) ** 2).sum(axis=2)
        assert (away == every.min(axis=1)).all() and (number == every.argmin(axis=1)).all()


def test_search_skips_what_is_too_far():
    """Centroids in far groups: a search visits a small part of the tree."""
    chance = np.random.default_rng(1)
    centres = np.concatenate([chance.integers(0, 50, (32, 4)) + 100_000 * g for g in range(16)])
    search, visits = C.Search(centres, C.tree(centres)), []
    plain = search._visit
    search.__class__._visit = lambda self, n, own, *rest: (visits.append(len(own)), plain.__func__(self, n, own, *rest))[1]
    try:
        x = centres[::7]
        number, away = search.nearest(x)
    finally:
        search.__class__._visit = plain.__func__
    assert (away == 0).all() and sum(visits) < 0.25 * len(x) * len(search.nodes)


def test_largest_numbers_stay_exact():
    centres = np.array([[C.MOST_UNITS] * 64, [-C.MOST_UNITS] * 64, [C.MOST_UNITS - 1] * 64])
    number, away = C.Search(centres, C.tree(centres, 1)).nearest(np.array([[C.MOST_UNITS] * 64, [-C.MOST_UNITS] * 64]))
    assert number.tolist() == [0, 1] and away.tolist() == [0, 0]
    assert C.distances(centres[:1], centres[1]).tolist() == [64 * (2 * C.MOST_UNITS) ** 2]


def vectors(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<double>")


def test_against_brute_force(spark):
    chance = np.random.default_rng(2)
    rows = [(i, (chance.normal(size=5) * 3).round(2).tolist()) for i in range(120)]
    rows += [(7, rows[7][1]), (None, [0.5] * 5), (None, [-0.25] * 5)] + [(1000 + i, [1.0, 1.0, 1.0, 1.0, 1.0]) for i in range(60)]
    done, centres = C.clustered(vectors(spark, rows).repartition(3), k=8, rounds=6, components=5)
    want, want_centres = brute(rows, 8, 6)
    assert centres.tolist() == want_centres
    assert sorted(map(str, map(tuple, done.collect()))) == sorted(str((r[0], *w)) for r, w in zip(rows, want))


def test_edges(spark):
    nan, inf = float("nan"), float("inf")
    bad = [(1, None), (2, []), (3, [1.0, None]), (4, [1.0, nan]), (5, [inf, 1.0]), (6, [1.0]), (7, [1.0, 2.0, 3.0])]
    done, centres = C.clustered(vectors(spark, bad), components=2)
    assert done.count() == 0 and done.columns == ["vec_id", "cluster", "distance"] and len(centres) == 0
    few = bad + [(8, [0.0, 0.0]), (9, [1.0, -1.0])]
    clash = vectors(spark, few).withColumn("cluster", F.lit("c")).withColumn("x", F.lit(1)).withColumn("n", F.lit(None).cast("int"))
    done, centres = C.clustered(clash, components=2)
    assert sorted((r["vec_id"], r["distance"]) for r in done.collect()) == [(8, 0), (9, 0)] and len(centres) == 2
    with pytest.raises(Exception, match="over 131072 in size"):
        C.clustered(vectors(spark, [(1, [1e9, 0.0])]), components=2)


def test_query_equals_sql(spark, sf):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{sf}/embeddings.parquet'")
    cur = con.execute(C.SQL)
    names = [d[0] for d in cur.description]
    assert sorted(map(tuple, C.op12_vantage_point_clusters(spark, sf).select(*names).collect())) == sorted(cur.fetchall())


def test_a_third_under_one_id(spark):
    rows = [(i if i % 3 else 0, [float(i % 11), float(i % 7)]) for i in range(300)]
    done, centres = C.clustered(vectors(spark, rows), components=2, rounds=3)
    want, want_centres = brute(rows, 8, 3)
    assert centres.tolist() == want_centres and sorted(r["distance"] for r in done.collect()) == sorted(d for _, d in want)
