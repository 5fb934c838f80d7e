import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from headway.functions import clock, geo, keys, measures



def values(spark, data, schema, *exprs):
    df = spark.createDataFrame(data, schema)
    return [tuple(r) for r in df.select(*exprs).collect()]


def test_trip_key_skips_nulls(spark):
    got = values(spark, [("9", 95.0, None, 7)], "rt string, pid double, t string, vid long", keys.trip_key("rt", "pid", "t", "vid"))
    assert got == [("995.07",)]


def test_pid_forms(spark):
    got = values(spark, [("95.0",), ("x",), (None,)], "p string", keys.normal_pid("p"))
    assert got == [("95",), (None,), (None,)]
    got = values(spark, [("643000095",)], "s string", keys.shape_pid("s"), keys.bare_pid(keys.shape_pid("s")), keys.padded_pid(F.lit("95")))
    assert got == [("00095", "95", "00095")]
    got = values(spark, [("95", "12"), ("95", None)], "p string, s string", keys.pattern_stop_id("p", "s"))
    assert got == [("95-12",), (None,)]


def test_feed_time(spark):
    got = values(spark, [("20240310 02:30",), ("2024-03-10",), ("20241399 99:99",), (None,)], "t string", clock.parse_feed_time("t"))
    assert got == [(dt.datetime(2024, 3, 10, 2, 30),), (None,), (None,), (None,)]


@pytest.mark.parametrize("strict", [False, True])
def test_service_clock(spark, strict):
    texts = ["23:59:59", "24:05:09", "24:24:10", "25:10:00", "bad", None]
    got = values(
        spark, [("2024-01-31", t) for t in texts], "d string, t string",
        clock.service_time(F.col("d").cast("date"), "t", strict),
    )
    feb = lambda h, m, s: dt.datetime(2024, 2, 1, h, m, s)
    want = [dt.datetime(2024, 1, 31, 23, 59, 59), feb(0, 5, 9), feb(0, 24, 10), feb(1, 10, 0), None, None]
    if strict:
        want[2], want[3] = feb(0, 0, 10), None
    assert [g[0] for g in got] == want


def test_last_full_month_and_weekday(spark):
    days = [dt.datetime(2024, 1, 31, 23), dt.datetime(2024, 2, 1), dt.datetime(2023, 12, 31), dt.datetime(2024, 1, 1)]
    got = values(spark, [(d,) for d in days], "t timestamp_ntz", clock.in_last_full_month("t", "2024-02-10"), clock.iso_weekday("t"))
    assert got == [(True, 3), (False, 4), (False, 7), (True, 1)]


def test_round_to_second(spark):
    base = dt.datetime(2024, 1, 1, 0, 0, 1)
    micro = [400000, 500000, 500001, 999999]
    got = values(spark, [(base.replace(microsecond=m),) for m in micro], "t timestamp_ntz", clock.round_to_second("t"))
    assert [g[0].second for g in got] == [1, 2, 2, 2]
    even = values(spark, [(dt.datetime(2024, 1, 1, 0, 0, 2, 500000),)], "t timestamp_ntz", clock.round_to_second("t"))
    assert even[0][0].second == 2


def test_projection_scale(spark):
    """One hundredth of a degree at 41.8781, -87.6298, against the ellipsoid."""
    df = spark.createDataFrame([(41.8781, -87.6298), (41.8881, -87.6298), (41.8781, -87.6198)], "lat double, lon double")
    p = [(r.x_m, r.y_m) for r in geo.with_xy(df).collect()]
    d = lambda a, b: math.hypot(a[0] - b[0], a[1] - b[1])
    assert d(p[0], p[1]) == pytest.approx(1110.73, abs=0.05)
    assert d(p[0], p[2]) == pytest.approx(830.10, abs=0.05)


def test_distance_to_leg(spark):
    rows = [(0.0, 3.0, 0.0, 0.0, 10.0, 0.0), (-3.0, 4.0, 0.0, 0.0, 10.0, 0.0), (13.0, 4.0, 0.0, 0.0, 10.0, 0.0), (3.0, 4.0, 0.0, 0.0, 0.0, 0.0)]
    got = values(spark, rows, "px double, py double, x0 double, y0 double, x1 double, y1 double", geo.distance_to_leg("px", "py", "x0", "y0", "x1", "y1"))
    assert [g[0] for g in got] == [3.0, 5.0, 5.0, 5.0]


def _poly(spark, *rings):
    data = [([[{"x": float(x), "y": float(y)} for x, y in ring] for ring in rings],)]
    return spark.createDataFrame(data, "rings array<array<struct<x double, y double>>>")


def test_concave_polygon_and_hole(spark):
    ell = [(0, 0), (4, 0), (4, 2), (2, 2), (2, 4), (0, 4)]
    df = _poly(spark, ell, [(0.5, 0.5), (1, 0.5), (1, 1), (0.5, 1)]).withColumn("e", geo.ring_edges("rings"))
    test = lambda x, y: df.select(geo.inside(F.lit(x), F.lit(y), "e")).first()[0]
    assert test(1.5, 3.0) and test(3.0, 1.0)
    assert not test(3.0, 3.0)  # the notch
    assert not test(0.7, 0.7)  # the hole
    assert df.select(geo.distance_to_edges(F.lit(5.0), F.lit(1.0), "e")).first()[0] == 1.0


def test_area_and_centroid(spark):
    df = _poly(spark, [(0, 0), (4, 0), (4, 2), (0, 2), (0, 0)])
    area, centre = df.select(geo.ring_area(F.col("rings")[0]), geo.ring_centroid(F.col("rings")[0])).first()
    assert area == 8.0 and (centre.x, centre.y) == (2.0, 1.0)


def test_measures(spark):
    got = values(
        spark, [(1609.0, 3600.0), (100.0, 0.0)], "m double, s double",
        measures.speed_mph("m", "s"), measures.plausible_speed(measures.speed_mph("m", "s")),
    )
    assert got[0] == (1.0, 1.0) and got[1][1] is None
    got = values(spark, [(10,), (7,)], "m int", measures.budget_label("m"), measures.budget_rank("m"))
    assert got == [("10 minutes", 1), (None, None)]
    got = values(spark, [(5, 0), (5, 1000)], "n int, pop int", measures.per_capita("n", "pop"))
    assert got == [(None,), (5.0,)]


def test_null_position_meets_nothing(spark):
    got = values(spark, [(None,), (1.0,)], "x double", geo.cell("x", 10.0))
    assert got == [(geo.NO_CELL,), (0,)]


def test_one_day_and_text_columns(spark):
    from headway.operators.visits import as_strings

    days = [dt.datetime(2024, 1, 1, 23, 59, 59), dt.datetime(2024, 1, 2), dt.datetime(2024, 1, 3)]
    assert values(spark, [(d,) for d in days], "t timestamp_ntz", clock.on_day("t", "2024-01-02")) == [(False,), (True,), (False,)]
    df = spark.createDataFrame([(1, 2.5, days[0])], "a int, b double, bus_stop_time timestamp_ntz")
    assert as_strings(df).dtypes == [("a", "string"), ("b", "string"), ("bus_stop_time", "timestamp_ntz")]


def test_malformed_clocks_are_null(spark):
    texts = ["10:20", "1:2:3:4", "10:60:00", "10:00:61", "-1:00:00", "", "x:y:z"]
    got = values(spark, [(t,) for t in texts], "t string", clock.service_time(F.lit("2024-01-01").cast("date"), "t"))
    assert [g[0] for g in got] == [None] * len(texts)


def test_naive_times_ignore_the_session_zone(spark):
    """02:30 does not exist in New York on this day, but naive times know no zone."""
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        got = values(
            spark, [("2024-03-10 02:30:15.25",)], "s string",
            *[
                e.cast("string")
                for t in [F.col("s").cast("timestamp_ntz")]
                for e in (
                    clock.floor_to("hour", t), clock.floor_to("day", t), clock.floor_to("month", t),
                    clock.round_to_second(t), clock.clock_text(t), F.hour(t), clock.add_seconds(t, F.lit(0.75)),
                )
            ],
            clock.parse_feed_time(F.lit("20240310 02:30")).cast("string"),
        )
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    assert got == [(
        "2024-03-10 02:00:00", "2024-03-10 00:00:00", "2024-03-01 00:00:00", "2024-03-10 02:30:15",
        "02:30:15", "2", "2024-03-10 02:30:16", "2024-03-10 02:30:00",
    )]
