import math
import random

import pytest
from pyspark.sql import functions as F

from headway.functions import geo, projection
from headway.operators import areas as A, overlay as O

PARTS = "array<array<array<struct<x double, y double>>>>"


def _frame(spark, shapes, key="community"):
    data = [(k, [[[{"x": float(x), "y": float(y)} for x, y in ring] for ring in part] for part in parts]) for k, parts in shapes.items()]
    return spark.createDataFrame(data, f"{key} string, parts {PARTS}")


def _edges(parts):
    return [(a, b) for part in parts for ring in part for a, b in zip(ring, ring[1:] + ring[:1])]


def _odd(parts, x, y):
    return sum((a[1] > y) != (b[1] > y) and x < (b[0] - a[0]) * (y - a[1]) / (b[1] - a[1]) + a[0] for a, b in _edges(parts)) % 2 == 1


def _meet(p, q):
    side = lambda a, b, c: (b[0] - a[0]) * (c[1] - a[1]) - (b[1] - a[1]) * (c[0] - a[0])
    for a, b in _edges(p):
        for c, d in _edges(q):
            if max(min(a[0], b[0]), min(c[0], d[0])) <= min(max(a[0], b[0]), max(c[0], d[0])) and max(min(a[1], b[1]), min(c[1], d[1])) <= min(max(a[1], b[1]), max(c[1], d[1])):
                s = lambda v: (v > 0) - (v < 0)
                if s(side(a, b, c)) * s(side(a, b, d)) <= 0 and s(side(c, d, a)) * s(side(c, d, b)) <= 0:
                    return True
    return any(_odd(p, *part[0][0]) for part in q) or any(_odd(q, *part[0][0]) for part in p)


def _star(chance, x, y, r, n):
    return [(x + r * (0.5 + 0.5 * chance.random()) * math.cos(2 * math.pi * i / n), y + r * (0.5 + 0.5 * chance.random()) * math.sin(2 * math.pi * i / n)) for i in range(n)]


@pytest.mark.parametrize("cell", [0.07, 0.5, 30.0])
def test_intersecting_areas(spark, cell):
    chance = random.Random(11)

    def shapes(n, most):
        out = {}
        for i in range(n):
            x, y, r = chance.uniform(0, 4), chance.uniform(0, 4), chance.uniform(0.05, most)
            out[f"{i}"] = [[_star(chance, x, y, r, 7), _star(chance, x, y, r * 0.3, 5)], [_star(chance, x + 3 * r, y, r * 0.5, 4)]]
        return out

    left, right = shapes(12, 1.5), shapes(60, 0.5)
    # One within a hole, one that is the other's outline, one that touches a corner.
    left["ring"] = [[[(10, 10), (14, 10), (14, 14), (10, 14)], [(11, 11), (13, 11), (13, 13), (11, 13)]]]
    right["in hole"] = [[[(11.5, 11.5), (12, 11.5), (12, 12)]]]
    right["same"] = [[[(10, 10), (14, 10), (14, 14), (10, 14)]]]
    right["touches"] = [[[(14, 14), (15, 14), (15, 15)]]]
    right["around"] = [[[(9, 9), (15.5, 9), (15.5, 15.5), (9, 15.5)]]]
    got = O.intersecting(_frame(spark, left), _frame(spark, right, "geoid"), cell=cell)
    want = sorted((a, b) for a, p in left.items() for b, q in right.items() if _meet(p, q))
    assert sorted(map(tuple, got.collect())) == want
    assert ("ring", "in hole") not in want and {("ring", "same"), ("ring", "touches"), ("ring", "around")} <= set(want)


def _cells_of(parts, n):
    """Unit cells whose middle lies inside."""
    return {(i, j) for i in range(n) for j in range(n) if _odd(parts, i + 0.5, j + 0.5)}


def test_dissolve_unions_of_rectangles(spark):
    """A board cut into rectangles at random, given to keys: the unions cover the same cells, without inner borders."""
    chance, n = random.Random(12), 12
    rectangles, todo = [], [(0, 0, n, n)]
    while todo:
        a, b, c, d = todo.pop()
        if c - a > 1 and (d - b <= 1 or chance.random() < 0.5) and chance.random() < 0.9:
            m = chance.randrange(a + 1, c)
            todo += [(a, b, m, d), (m, b, c, d)]
        elif d - b > 1 and chance.random() < 0.9:
            m = chance.randrange(b + 1, d)
            todo += [(a, b, c, m), (a, m, c, d)]
        else:
            rectangles.append((a, b, c, d))
    keys, shapes = {}, {}
    for i, (a, b, c, d) in enumerate(rectangles):
        ring = [(a, b), (c, b), (c, d), (a, d)]
        shapes[str(i)] = [[ring if i % 2 else ring[::-1]]]  # either way round
        keys[str(i)] = f"k{chance.randrange(3)}"
    named = _frame(spark, shapes, "id").join(spark.createDataFrame(list(keys.items()), "id string, k string"), "id")
    got = {r["k"]: r["parts"] for r in O.dissolve(named, "k", snap=1e-6, cell=2.0).collect()}
    for k in set(keys.values()):
        want = {(i, j) for r, (a, b, c, d) in enumerate(rectangles) if keys[str(r)] == k for i in range(a, c) for j in range(b, d)}
        parts = [[[(p["x"], p["y"]) for p in ring] for ring in part] for part in got[k]]
        assert _cells_of(parts, n) == want
        # As many sides as cells have neighbours that are not in the union, and no corner that does not turn.
        sides = sum((i + x, j + y) not in want for i, j in want for x, y in ((1, 0), (-1, 0), (0, 1), (0, -1)))
        assert round(sum(math.dist(a, b) for a, b in _edges(parts))) == sides
        for part in parts:
            for ring in part:
                for a, b, c in zip(ring, ring[1:] + ring[:1], ring[2:] + ring[:2]):
                    assert abs((b[0] - a[0]) * (c[1] - b[1]) - (b[1] - a[1]) * (c[0] - b[0])) > 0.5
        # Holes lie within the outline they go with; cells of a part are those of its outline without its holes.
        assert sum(len(_cells_of([part], n)) for part in parts) == len(want)


def test_dissolve_keeps_single_areas_and_touching_corners(spark):
    square = lambda x, y: [[[(x, y), (x + 1, y), (x + 1, y + 1), (x, y + 1)]]]
    shapes = {"a": square(0, 0), "b": square(1, 1), "c": square(0, 0), "d": [[[(5, 5), (8, 5), (6, 9)]]]}
    got = O.dissolve(_frame(spark, shapes).withColumn("k", F.when(F.col("community") == "d", "two").otherwise("one")), "k", 1e-6, 1.0)
    parts = {r["k"]: r["parts"] for r in got.collect()}
    assert sorted(len(part[0]) for part in parts["one"]) == [4, 4] and len(parts["two"]) == 1
    assert O.dissolve(_frame(spark, shapes).limit(0).withColumn("k", F.lit("x")), "k").count() == 0


def test_covered_area_against_a_fine_grid(spark):
    chance = random.Random(13)
    shapes = {"a": [[_star(chance, 0.0, 0.0, 900.0, 11), _star(chance, 0.0, 0.0, 150.0, 5)], [_star(chance, 2500.0, 300.0, 500.0, 6)]], "far": [[[(9e4, 0.0), (9.1e4, 0.0), (9e4, 1e3)]]]}
    stops = [(chance.uniform(-1500, 3500), chance.uniform(-1500, 1500)) for _ in range(25)]
    points = spark.createDataFrame([(*s,) for s in stops + stops[:5]], "x_m double, y_m double")
    for tile in (400.0, 1e5):
        got = {r["community"]: r for r in A.covered_area(_frame(spark, shapes), points, step_m=2.0, tile_m=tile).collect()}
        assert got["far"]["percent_4b"] == 0.0 and abs(got["far"]["area_m2"] - 5e5) < 500
        step, cells, hits = 5.0, 0, [0, 0, 0, 0]
        for i in range(-200, 620):
            for j in range(-200, 200):
                x, y = (i + 0.5) * step, (j + 0.5) * step
                if _odd(shapes["a"], x, y):
                    cells += 1
                    near = min(math.dist((x, y), s) for s in stops)
                    for b in range(4):
                        hits[b] += near <= (b + 1) * 1609.34 / 8
        assert abs(got["a"]["area_m2"] / (cells * step * step) - 1) < 1e-3
        for b in range(4):
            assert abs(got["a"][f"percent_{b + 1}b"] - hits[b] / cells) < 1e-3


def test_projections_agree_and_go_back(spark):
    chance = random.Random(14)
    points = spark.createDataFrame([(chance.uniform(37, 43), chance.uniform(-91, -86)) for _ in range(500)], "lat double, lon double")
    both = projection.STATE_PLANE.project(geo.with_xy(points, x="e", y="n"))
    assert both.agg(F.max(F.hypot(F.col("x_m") - F.col("e"), F.col("y_m") - F.col("n")))).first()[0] < 1e-3
    for zone in (projection.STATE_PLANE, projection.utm(16), projection.utm(15, south=True)):
        back = zone.unproject(zone.project(points), lat="lat2", lon="lon2")
        metres = F.hypot((F.col("lat2") - F.col("lat")) * 111e3, (F.col("lon2") - F.col("lon")) * 85e3)
        assert back.agg(F.max(metres)).first()[0] < 1e-4


def test_prj():
    text = (
        'PROJCS["NAD_1983_StatePlane_Illinois_East_FIPS_1201_Feet",GEOGCS["GCS_North_American_1983",DATUM["D_North_American_1983",'
        'SPHEROID["GRS_1980",6378137.0,298.257222101]],PRIMEM["Greenwich",0.0],UNIT["Degree",0.0174532925199433]],'
        'PROJECTION["Transverse_Mercator"],PARAMETER["False_Easting",984250.0],PARAMETER["False_Northing",0.0],'
        'PARAMETER["Central_Meridian",-88.33333333333333],PARAMETER["Scale_Factor",0.999975],PARAMETER["Latitude_Of_Origin",36.66666666666666],UNIT["Foot_US",0.3048006096012192]]'
    )
    got = projection.of_prj(text)
    assert got.k0 == 0.999975 and abs(got.false_easting - 300000.0) < 1e-6 and got.lon0 == -88.33333333333333
    with pytest.raises(ValueError):
        projection.of_prj('GEOGCS["x"]')
