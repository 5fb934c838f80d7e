import datetime as dt
import json

from headway.operators import matching as M, pings as P
from tests.conftest import rows


def test_snapshots(spark):
    vehicle = {"vid": "7", "tmstmp": "20240105 10:05", "lat": "41.9", "lon": "-87.6", "pid": "95", "rt": "9", "dly": "false"}
    doc = {
        "chunk_0": {"bustime-response": {"vehicle": [vehicle, {**vehicle, "vid": "8", "tmstmp": "junk"}]}},
        "chunk_1": {"bustime-response": {"error": [{"rt": "11", "msg": "No data"}]}},
    }
    docs = spark.createDataFrame([(json.dumps(doc), "a.json"), ("not json", "b.json"), ("{}", "c.json")], "value string, scrape_file string")
    pings, errors = P.explode_snapshots(docs)
    got = {r.vid: r for r in pings.collect()}
    assert got["7"].data_time == dt.datetime(2024, 1, 5, 10, 5) and got["7"].data_hour == 10
    assert got["7"].lat == 41.9 and got["7"].dly is False and got["7"].scrape_file == "a.json"
    assert got["8"].data_time is None
    assert rows(errors) == [("11", "No data", "a.json")]
    assert [r.scrape_file for r in P.unreadable_snapshots(docs).orderBy("scrape_file").collect()] == ["b.json", "c.json"]


def _trip(name, points):
    start = dt.datetime(2024, 1, 1)
    return [
        (f"{name}-{i}", "1", name, start + dt.timedelta(minutes=5 * i), lat, lon)
        for i, (lat, lon) in enumerate(points)
    ]


def test_cleaning(spark):
    far = [(41.90 + 0.01 * i, -87.60 + 0.01 * i) for i in range(3)]
    data = (
        _trip("still", [(41.9, -87.6)] * 4)
        + _trip("waits", [far[0], far[0], far[0], far[1], far[1], far[2]])
        + _trip("moves", far)
        + _trip("alone", [far[0]])
        + _trip("stuck", [far[0], far[0], far[0]])
    )
    df = spark.createDataFrame(data, "ping_id string, pid string, unique_trip_vehicle_day string, data_time timestamp_ntz, lat double, lon double")
    got = {r.ping_id: r.drop_reason for r in P.clean_pings(df, only_kept=False).collect()}
    assert {got[f"still-{i}"] for i in range(4)} == {"stationary_trip"}
    assert [got[f"waits-{i}"] for i in range(6)] == ["leading_standstill"] * 2 + [None] * 4
    assert [got[f"moves-{i}"] for i in range(3)] == [None] * 3
    assert got["alone-0"] == "stationary_trip"
    two = P.clean_pings(df, min_box_m2=-1.0, only_kept=False).collect()
    assert {r.ping_id: r.drop_reason for r in two}["alone-0"] == "one_ping"
    assert {r.ping_id: r.drop_reason for r in two}["stuck-2"] == "one_ping"


def _candidates(spark, data):
    at = lambda m: dt.datetime(2024, 1, 1) + dt.timedelta(minutes=m)
    return spark.createDataFrame(
        [("1", t, i, at(m), s) for t, i, m, s in data],
        "pid string, unique_trip_vehicle_day string, ping_id long, data_time timestamp_ntz, seg_combined double",
    )


def test_greedy_walk(spark):
    data = [("a", 0, 0, 0.5), ("a", 0, 0, 1.5), ("a", 1, 1, 1.5), ("a", 2, 2, 1.5), ("a", 2, 2, 2.5), ("b", 3, 0, -0.5), ("b", 4, 1, 3.5), ("b", 5, 2, 2.5)]
    got = M.greedy_positions(_candidates(spark, data)).select("ping_id", "seg_combined")
    assert rows(got, "ping_id") == [(0, 0.5), (1, 1.5), (2, 2.5), (4, 3.5)]


def test_long_trips_are_walked_like_short_ones(spark):
    import random

    rnd = random.Random(3)
    data, number = [], 0
    for trip, n in (("long", 5000), ("short", 12), ("other", 40)):
        for i in range(n):
            number += 1
            for s in sorted(rnd.sample(range(max(0, i // 40 - 3), i // 40 + 5), 3)):
                data.append((trip, number, i // 2, s + 0.5))
    c = _candidates(spark, data)
    want, at, done = [], {}, set()
    for trip, ping, _, s in sorted(data, key=lambda r: (r[0], r[2], r[1], r[3])):
        if ping not in done and s > at.get(trip, 0.0):
            at[trip] = s
            done.add(ping)
            want.append((ping, s))
    got = M.greedy_positions(c)
    assert rows(got.select("ping_id", "seg_combined")) == sorted(want, key=lambda r: tuple((v is None, str(v)) for v in r))
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Pandas" not in plan
    per_trip = {}
    for r in M.greedy_positions(c).orderBy("data_time", "ping_id").collect():
        per_trip.setdefault(r.unique_trip_vehicle_day, []).append(r.seg_combined)
    assert all(a < b for p in per_trip.values() for a, b in zip(p, p[1:]))


def test_pings_are_told_apart_by_trip_and_time(spark):
    at = dt.datetime(2024, 1, 1)
    cols = "pid string, unique_trip_vehicle_day string, ping_id long, data_time timestamp_ntz, seg_combined double"
    c = spark.createDataFrame([("1", "a", 7, at, 1.5), ("1", "b", 7, at, 2.5), ("1", "b", 7, None, 3.5)], cols)
    pings = spark.createDataFrame(
        [("1", "a", 7, at), ("1", "b", 7, at), ("1", "b", 7, None), ("1", "c", 7, at)], cols.rsplit(",", 1)[0]
    )
    assert [r[1] for r in M.off_route(pings, c).collect()] == ["c"]
    assert M.first_candidate(c).count() == 3


def test_repeated_pings_stay_two(spark):
    from headway.plans.process import with_ping_id

    at = dt.datetime(2024, 1, 1)
    p = spark.createDataFrame([(1, at, 1.0, 2.0, "1", "t")] * 3, "vid int, data_time timestamp_ntz, lat double, lon double, pid string, unique_trip_vehicle_day string")
    assert with_ping_id(p).select("ping_id").distinct().count() == 3


def test_chunks_of_a_trip_walk_like_the_whole(spark):
    """Trips cut into chunks of any size, over several levels of step functions."""
    import random

    from pyspark.sql import functions as F

    rnd = random.Random(4)
    data, number = [], 0
    for trip, n in (("a", 700), ("b", 90), ("c", 3), ("d", 260)):
        for i in range(n):
            number += 1
            for s in rnd.sample(range(-1, 30), rnd.randint(1, 3)):
                data.append((trip, number, rnd.randrange(3 * n) if trip != "d" else i // 9, s - 0.5 if trip == "b" else s + 0.5))
    c = _candidates(spark, data)
    c = c.join(c.groupBy("ping_id").agg(F.min("data_time").alias("t")), "ping_id").withColumn("data_time", F.col("t")).drop("t")
    c = c.withColumn("data_time", F.when(F.col("ping_id") != 5, F.col("data_time"))).select(*_candidates(spark, []).columns)
    cols = ["unique_trip_vehicle_day", "ping_id", "data_time", "seg_combined"]
    want = rows(M.greedy_positions(c, chunk=10**6).select(cols))
    assert want
    for chunk, fan_in in ((256, 64), (10, 64), (3, 4), (1, 2)):
        M.FAN_IN = fan_in
        try:
            assert rows(M.greedy_positions(c, chunk=chunk, bucket="hour").select(cols)) == want
        finally:
            M.FAN_IN = 64
