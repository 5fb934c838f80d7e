import datetime as dt

import pytest
from pyspark.sql import functions as F

from headway.operators import areas as A, audit, qc, reach as RC
from tests.conftest import rows

PARTS = "array<array<array<struct<x double, y double>>>>"


def _areas(spark):
    square = lambda x0: [[{"x": x0 + dx, "y": dy} for dx, dy in ((0.0, 0.0), (0.02, 0.0), (0.02, 0.02), (0.0, 0.02))]]
    return spark.createDataFrame([("west", [square(0.0)]), ("east", [square(0.05)]), ("empty", [square(9.0)])], f"community string, parts {PARTS}")


def test_points_in_areas_keep_empty_areas(spark):
    stops = spark.createDataFrame([("a", 0.01, 0.01), ("b", 0.06, 0.001), ("c", 0.03, 0.01)], "stop_id string, lon double, lat double")
    for cell in (0.003, 0.01, 5.0):
        got = A.stops_in_areas(_areas(spark), stops, cell).select("community", "stop_id")
        assert rows(got) == [("east", "b"), ("empty", None), ("west", "a")]


def _random_areas(spark, chance):
    """Stars with holes and second parts, and a plain test for points."""
    import math

    def star(x, y, r, n):
        return [(x + r * (0.5 + 0.5 * chance.random()) * math.cos(2 * math.pi * i / n), y + r * (0.5 + 0.5 * chance.random()) * math.sin(2 * math.pi * i / n)) for i in range(n)]

    areas = {}
    for i in range(6):
        x, y = chance.uniform(0, 3), chance.uniform(0, 3)
        areas[f"a{i}"] = [[star(x, y, 1.0, 9 + i), star(x, y, 0.2, 5)], [star(x + 3.0, y, 0.6, 7)]]
    data = [(k, [[[{"x": p, "y": q} for p, q in ring] for ring in part] for part in parts]) for k, parts in areas.items()]

    def inside(parts, px, py):
        odd = False
        for part in parts:
            for ring in part:
                for (x0, y0), (x1, y1) in zip(ring, ring[1:] + ring[:1]):
                    if (y0 > py) != (y1 > py) and px < (x1 - x0) * (py - y0) / (y1 - y0) + x0:
                        odd = not odd
        return odd

    return spark.createDataFrame(data, f"community string, parts {PARTS}"), areas, inside


def test_points_in_areas_of_several_parts(spark):
    import random

    chance = random.Random(8)
    df, areas, inside = _random_areas(spark, chance)
    pts = [(i, chance.uniform(-1, 8), chance.uniform(-1, 5)) for i in range(3000)]
    points = spark.createDataFrame(pts, "id long, lon double, lat double")
    want = sorted((k, i) for k, parts in areas.items() for i, x, y in pts if inside(parts, x, y))
    for cell in (0.05, 0.3, 20.0):
        got = sorted((r.community, r.id) for r in A.points_in_areas(df, points, cell=cell).select("community", "id").collect())
        assert got == want
    near = A.points_near_areas(df, points.withColumnsRenamed({"lon": "x_m", "lat": "y_m"}), 0.1, cell=0.4)

    def close(parts, px, py):
        def leg(a, b):
            (x0, y0), (x1, y1) = a, b
            l2 = (x1 - x0) ** 2 + (y1 - y0) ** 2
            t = max(0.0, min(1.0, ((px - x0) * (x1 - x0) + (py - y0) * (y1 - y0)) / l2))
            return ((px - x0 - t * (x1 - x0)) ** 2 + (py - y0 - t * (y1 - y0)) ** 2) ** 0.5

        return min(leg(a, b) for part in parts for ring in part for a, b in zip(ring, ring[1:] + ring[:1])) <= 0.1

    want = sorted((k, i) for k, parts in areas.items() for i, x, y in pts if inside(parts, x, y) or close(parts, x, y))
    assert sorted((r.community, r.id) for r in near.select("community", "id").collect()) == want


def test_sizes_add_up_over_parts(spark):
    square = lambda x, s: [{"x": x, "y": 0.0}, {"x": x + s, "y": 0.0}, {"x": x + s, "y": s}, {"x": x, "y": s}]
    parts = [[square(0.0, 2.0), square(0.5, 1.0)], [square(10.0, 1.0)]]
    r = A.area_sizes(spark.createDataFrame([("c", parts)], f"community string, parts {PARTS}")).first()
    assert (r.area_m2, r.centroid_x, r.centroid_y) == (4.0, (4 * 1.0 + 10.5) / 5, (4 * 1.0 + 0.5) / 5)


def test_cells_within_an_area_carry_no_edges(spark):
    big = spark.createDataFrame([("c", [[[{"x": x, "y": y} for x, y in ((0.0, 0.0), (50.0, 0.0), (50.0, 50.0), (0.0, 50.0))]]])], f"community string, parts {PARTS}")
    cells = A._cells(big, 1.0)
    assert cells.filter(F.size("__edges") == 0).count() > 2000
    assert cells.agg(F.sum(F.size("__edges"))).first()[0] < 1000


def test_coverage_counts_cells_near_a_stop(spark):
    ring = [[{"x": float(x), "y": float(y)} for x, y in ((0, 0), (1000, 0), (1000, 1000), (0, 1000))]]
    areas = spark.createDataFrame([("c", [ring])], f"community string, parts {PARTS}")
    stops = spark.createDataFrame([(50.0, 50.0)] * 3, "x_m double, y_m double")
    got = A.coverage_share(areas, stops, blocks=(1, 2), block_m=100.0, cell_m=100.0).first()
    brute = lambda r: sum(((x * 100) ** 2 + (y * 100) ** 2) ** 0.5 <= r for x in range(10) for y in range(10)) / 100
    assert (got.cells, got.percent_1b, got.percent_2b) == (100, brute(100), brute(200))


def _path(spark):
    """Stops 0..9, 150 s apart, stop s3 passed twice."""
    names = ["s0", "s1", "s2", "s3", "s4", "s5", "s3", "s7", "s8", "s9"]
    data = [("R", "1", n, i, 150.0 * (i + 1), i) for i, n in enumerate(names)]
    return spark.createDataFrame(data, "rt string, pid string, stop_id string, stop_sequence int, elapsed double, path_index int")


def test_budgets_against_pairs(spark):
    got = {(r.origin_stop, r.minutes): (r.last_stop, r.stops_reached, r.seconds_used) for r in RC.reach_budgets(_path(spark), (5, 10)).collect()}
    assert got[("s0", 5)] == ("s2", 3, 300.0)
    assert got[("s0", 10)] == ("s4", 5, 600.0)
    assert got[("s3", 5)] == ("s5", 3, 300.0)  # the first passing counts
    assert got[("s9", 10)] == ("s9", 1, 0.0)
    assert len(got) == 18


def test_minutes_cover_the_rest_of_the_pattern(spark):
    origins = spark.createDataFrame([("s7",), ("s3",)], "stop_id string")
    got = RC.reach_minutes(_path(spark), origins)
    assert rows(got.filter("origin_stop = 's7'").select("stop_id", "minutes"), "stop_id") == [("s7", 0), ("s8", 2), ("s9", 5)]
    assert got.filter("origin_stop = 's3'").count() == 7


def test_paths_take_waypoints_along(spark):
    pts = [("1", i, float(i), 0.0, f"s{i // 2}" if i % 2 == 0 else None) for i in range(8)]
    points = spark.createDataFrame(pts, "pid string, seq int, lon double, lat double, stpid string")
    reach = spark.createDataFrame([("1", "s1", "s2")], "pid string, origin_stop string, last_stop string")
    assert [p.lon for p in RC.reach_paths(reach, points).first().path] == [2.0, 3.0, 4.0, 5.0]


def _st(spark, trips):
    t0 = dt.datetime(2024, 1, 1)
    data = []
    for trip, minutes in trips.items():
        for i, m in enumerate(minutes):
            data.append(("1", trip, "S", float(i), None if m is None else t0 + dt.timedelta(minutes=m), 30.0))
    return spark.createDataFrame(data, "pid string, unique_trip_vehicle_day string, typ string, seg_combined double, bus_stop_time timestamp_ntz, speed_mph double")


def test_quality_flags(spark):
    checks = qc.trip_checks(_st(spark, {
        "good": [0, 5, 10], "same": [0, 5, 5], "late": [0, 60, 481], "order": [5, 0, 10], "gap": [0, None, 10], "none": [None, None],
    }))
    flags = {r.unique_trip_vehicle_day: {c for c in qc.CHECKS if r[c]} for r in checks.collect()}
    assert flags == {
        "good": set(), "same": {"same_time_trips"}, "late": {"very_long_trips"}, "order": {"min_max_time_issue_trips"},
        "gap": {"na_times_trips"}, "none": {"na_times_trips", "same_time_trips", "min_max_time_issue_trips"},
    }
    assert qc.qc_summary(checks).first().na_times_trips == 2
    assert qc.qc_error_rate(checks).first().perc == pytest.approx(7 / 6 * 100)


def test_examples_are_limited_before_the_shuffle(spark):
    checks = qc.trip_checks(_st(spark, {f"t{i:02d}": [0, None] for i in range(9)}))
    examples = qc.qc_examples(checks)
    assert "WindowGroupLimit" in examples._jdf.queryExecution().toString()
    got = examples.filter("issue = 'na_times_trips'").orderBy("example")
    assert [r.unique_trip_vehicle_day for r in got.collect()] == [f"t{i:02d}" for i in range(5)]


def test_actual_without_schedule(spark):
    df = spark.createDataFrame(
        [(1, None), (1, 2), (None, None)], "median_actual_x int, median_schedule_x int"
    )
    got = qc.qc_metrics(df).select("actual_nulls_not_in_schedule")
    assert [r[0] for r in got.collect()] == [True, False, False]


def test_mean_gap_equals_mean_of_steps(spark):
    t0 = dt.datetime(2024, 1, 1)
    data = [("R", "1", "t", i, t0 + dt.timedelta(seconds=s)) for i, s in enumerate((0, 300, 900))]
    df = spark.createDataFrame(data, "rt string, pid string, unique_trip_vehicle_day string, ping_id int, data_time timestamp_ntz")
    assert audit.ping_gaps(df).first().avg_time == 450.0
    assert [r.gap_seconds for r in audit.step_gaps(df).orderBy("ping_id").collect()] == [None, 300, 600]
