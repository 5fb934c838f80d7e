import datetime as dt

from pyspark.sql import functions as F

from headway.operators import schedule as S, visits as V
from tests.conftest import rows

DAYS = "monday tuesday wednesday thursday friday saturday sunday".split()


def _calendar(spark, weekdays, start="20240101", end="20240107"):
    flags = ["1" if d in weekdays else "0" for d in DAYS]
    return spark.createDataFrame([("A", *flags, start, end)], "service_id string, " + ", ".join(f"{d} string" for d in DAYS) + ", start_date string, end_date string")


def _exceptions(spark, *data):
    return spark.createDataFrame(list(data), "service_id string, date string, exception_type string")


def test_service_days_with_exceptions(spark):
    days = S.service_days(
        _calendar(spark, {"monday", "sunday"}),
        _exceptions(spark, ("A", "20240103", "1"), ("A", "20240107", "2"), ("A", "20240101", "1"), ("B", "20240105", "1")),
    )
    assert rows(days.withColumn("date", F.col("date").cast("string"))) == [("A", "2024-01-01"), ("A", "2024-01-03"), ("B", "2024-01-05")]


def test_expand_and_clean(spark):
    trips = spark.createDataFrame(
        [("1", "A", "t1", "643000095", "9"), ("X", "A", "t2", "643000096", "9")],
        "route_id string, service_id string, trip_id string, shape_id string, schd_trip_id string",
    )
    times = spark.createDataFrame(
        [("t1", "s", "1", "24:05:00", "24:05:00"), ("t2", "s", "1", "10:00:00", "10:00:00")],
        "trip_id string, stop_id string, stop_sequence string, arrival_time string, departure_time string",
    )
    routes = spark.createDataFrame([("1", "one"), ("X", None)], "route_id string, route_short_name string")
    out = S.expand_schedule(trips, times, _calendar(spark, {"monday"}), _exceptions(spark, ("A", "20240102", "1")), routes, "f", "d")
    assert out.columns == [*S.TIMETABLE, "sha1", "fetched_date"]
    clean = S.clean_schedule(out).orderBy("bus_stop_time").collect()
    assert [(r.route_id, r.pid, r.bus_stop_time) for r in clean] == [
        ("1", "00095", dt.datetime(2024, 1, 2, 0, 5)), ("1", "00095", dt.datetime(2024, 1, 3, 0, 5)),
    ]


def _feeds(spark):
    data = []
    for v, first in (("v1", 1), ("v2", 10), ("v3", 20)):
        data += [("R", v, f"2024-01-{first:02d}", f"202401{d:02d}", "08:00:00") for d in range(first, 31)]
    return spark.createDataFrame(data, "route_id string, sha1 string, fetched_date string, date string, arrival_time string")


def test_feed_versions_keep_the_open_one(spark):
    kept = S.dedupe_feed_versions(_feeds(spark))
    got = {r.sha1: (r.n, r.a, r.b) for r in kept.groupBy("sha1").agg(F.count("*").alias("n"), F.min("date").alias("a"), F.max("date").alias("b")).collect()}
    assert got == {"v1": (9, "20240101", "20240109"), "v2": (10, "20240110", "20240119"), "v3": (11, "20240120", "20240130")}


def test_reused_ids_split_whatever_the_bucket(spark):
    start = dt.datetime(2024, 1, 1, 6)
    data = [("R", "7", f"s{k}", k + 1, start + dt.timedelta(days=d, minutes=k)) for d in range(40) for k in range(3)]
    df = spark.createDataFrame(data, "rt string, schd_trip_id string, stop_id string, stop_sequence int, bus_stop_time timestamp_ntz")
    for bucket in ("day", "month", "year"):
        out = V.split_reused_trips(df, bucket=bucket)
        got = out.groupBy("trip_id").agg(F.count("*").alias("n"), F.countDistinct(F.to_date("bus_stop_time")).alias("days"))
        assert got.count() == 40 and {(r.n, r.days) for r in got.collect()} == {(3, 1)}


def test_scheduled_visits_drop_rows_without_time(spark):
    df = spark.createDataFrame(
        [("R", "00095", "7", "s", "1.0", dt.datetime(2024, 1, 1)), ("R", "95", "7", "s", "2", None)],
        "route_id string, pid string, schd_trip_id string, stop_id string, stop_sequence string, bus_stop_time timestamp_ntz",
    )
    assert [(r.pid, r.stop_sequence, r.trip_id) for r in V.scheduled_visits(df).collect()] == [("95", 1, "7-0")]


def test_two_buses_in_one_second(spark):
    t = dt.datetime(2024, 1, 1, 8)
    later = t + dt.timedelta(minutes=10)
    df = spark.createDataFrame(
        [("R", "1", "s", "b", 1, t), ("R", "1", "s", "a", 1, t), ("R", "1", "s", "c", 1, later)],
        "rt string, pid string, stop_id string, trip_id string, stop_sequence int, bus_stop_time timestamp_ntz",
    )
    got = {r.trip_id: r.time_till_next_bus for r in V.headways(df).collect()}
    assert got == {"a": 0, "b": 600, "c": None}


def test_clocks_are_read_before_days_are_unpacked(spark):
    trips = spark.createDataFrame(
        [("1", "A", "t1", "643000095", "9"), ("1", "A", "t1", "643000095", "9")],
        "route_id string, service_id string, trip_id string, shape_id string, schd_trip_id string",
    )
    times = spark.createDataFrame(
        [("t1", "s", "1", "24:05:00", ""), ("t1", "u", "2.0", "25:61:00", ""), ("t1", None, "3", None, ""), ("t1", "w", "x", "7:05:09", "")],
        "trip_id string, stop_id string, stop_sequence string, arrival_time string, departure_time string",
    )
    feed = (trips, times, _calendar(spark, {"monday", "friday"}), _exceptions(spark, ("A", "20240102", "1"), ("A", "20240101", "2")))
    packed, plain = S.expand_schedule(*feed, packed=True), S.expand_schedule(*feed)
    for strict in (False, True):
        assert rows(S.clean_schedule(packed, strict)) == rows(S.clean_schedule(plain, strict))
    assert rows(V.scheduled_visits(S.clean_schedule(packed, packed=True))) == rows(V.scheduled_visits(S.clean_schedule(plain)))
    plan = S.clean_schedule(packed)._jdf.queryExecution().optimizedPlan().toString()
    above, below = plan.split("Generate explode", 1)
    assert "substring_index" not in above and "substring_index" in below
