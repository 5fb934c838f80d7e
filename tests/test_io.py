import json

import pytest
from pyspark.sql import functions as F

from headway.operators import patterns as P
from headway.plans import stand_ins as T, update
from headway.sources import readers, writers
from headway.streaming import feed
from headway.operators.pings import key_trips
from tests.conftest import rows


def test_ping_csv_has_declared_types(spark, tmp_path):
    (tmp_path / "2024-01-01.csv").write_text(
        "vid,tmstmp,lat,lon,hdg,pid,rt,des,pdist,dly,tatripid,origtatripno,tablockid,zone,scrape_file,data_time,data_hour,data_date\n"
        "7,20240101 10:00,41.9,-87.6,90,95.0,9,D,1,false,12,1,b,,f,2024-01-01 10:00:00,10,2024-01-01\n"
    )
    df = key_trips(readers.read_ping_days(spark, str(tmp_path)))
    r = df.first()
    assert (r.vid, r.pid, r.dly, r.unique_trip_vehicle_day) == (7, "95", False, "995.01272024-01-01")


def test_gtfs_of_many_feeds_by_header_name(spark, tmp_path):
    files = {"f1": "trip_id,route_id,extra\nt1,9,z\n", "f 2": "\ufeffroute_id,trip_id,shape_id\r\n7,t2,s\r\n", "f3": "trip_id,route_id,extra\nt3,8,y\n"}
    for feed_id, text in files.items():
        (tmp_path / feed_id).mkdir()
        (tmp_path / feed_id / "trips.txt").write_text(text)
    got = readers.read_gtfs(spark, str(tmp_path), "trips").select("feed_id", "route_id", "trip_id", "shape_id")
    assert rows(got) == [("f%202", "7", "t2", "s"), ("f1", "9", "t1", None), ("f3", "8", "t3", None)] or rows(got) == [
        ("f 2", "7", "t2", "s"), ("f1", "9", "t1", None), ("f3", "8", "t3", None)
    ]
    with pytest.raises(Exception):
        readers.read_gtfs(spark, str(tmp_path), "stops")


def test_incomplete_feeds(spark, tmp_path):
    for feed_id, tables in {"good": ("shapes", "stops", "trips"), "bad": ("stops",)}.items():
        (tmp_path / feed_id).mkdir()
        for t in tables:
            (tmp_path / feed_id / f"{t}.txt").write_text("a\n")
    got = readers.incomplete_feeds(readers.feed_tables(spark, str(tmp_path)))
    assert rows(got) == [("bad", ["shapes", "trips"])]


def test_feed_catalogue_and_inventory(spark, tmp_path):
    (tmp_path / "v.json").write_text(json.dumps({"feed_versions": [
        {"sha1": "a", "fetched_at": "x", "earliest_calendar_date": "2022-01-01"},
        {"sha1": "b", "fetched_at": "y", "earliest_calendar_date": "2023-06-01"},
    ]}))
    assert [r.sha1 for r in readers.read_feed_versions(spark, str(tmp_path / "v.json"), "2022-05-01").collect()] == ["b"]
    keys = tmp_path / "keys"
    keys.mkdir()
    for n in ("pid_95_stop.parquet", "pid_95_segment.parquet", "pid_7_stop.parquet", "notes.md"):
        (keys / n).write_text("x")
    assert rows(readers.file_inventory(spark, str(keys))) == [("7",), ("95",)]


def test_geojson_polygons(spark, tmp_path):
    square = [[[0, 0], [1, 0], [1, 1], [0, 0]]]
    features = [
        {"type": "Feature", "properties": {"community": "A"}, "geometry": {"type": "Polygon", "coordinates": square}},
        {"type": "Feature", "properties": {"community": "B"}, "geometry": {"type": "MultiPolygon", "coordinates": [square, square]}},
    ]
    (tmp_path / "a.geojson").write_text(json.dumps({"type": "FeatureCollection", "features": features}))
    got = readers.read_areas(spark, str(tmp_path / "a.geojson"))
    assert sorted((r.community, len(r.parts)) for r in got.collect()) == [("A", 1), ("B", 2)]
    assert [(p.x, p.y) for p in got.filter("community = 'A'").first().parts[0][0]] == [(0, 0), (1, 0), (1, 1), (0, 0)]


def test_snapshot_files(spark, tmp_path):
    (tmp_path / "1.json").write_text('{"c":\n {"bustime-response": {}}}')
    r = readers.read_snapshots(spark, str(tmp_path)).collect()
    assert len(r) == 1 and r[0].scrape_file.endswith("1.json")


def test_partitioned_write_is_idempotent(spark, tmp_path):
    path = str(tmp_path / "t")
    first = spark.range(100).withColumn("day", (F.col("id") % 4).cast("int"))
    writers.write_partitioned(first, path, ["day"])
    batch = first.filter("day = 2").withColumn("id", F.col("id") + 1000)
    for _ in range(2):
        writers.write_partitioned(batch, path, ["day"])
        got = spark.read.parquet(path)
        assert got.count() == 100 and got.filter("id >= 1000").count() == 25


def test_append_merge_twice(spark):
    old = spark.createDataFrame([(1, "a"), (2, "b")], "day int, v string")
    batch = spark.createDataFrame([(2, "c"), (3, "d")], "day int, v string")
    once = writers.append_merge(old, batch, ["day"])
    twice = writers.append_merge(once, batch, ["day"])
    assert rows(once) == rows(twice) == [(1, "a"), (2, "c"), (3, "d")]
    assert rows(writers.append_merge(None, batch, ["day"])) == rows(batch)


def test_publish_rotates(spark, tmp_path):
    path = str(tmp_path / "m")
    writers.publish(spark.range(1), path, "2024-01-01")
    assert writers.versions(spark, path).first().previous is None
    writers.publish(spark.range(2), path, "2024-02-01")
    got = writers.versions(spark, path).first()
    assert (got.latest, got.previous) == ("2024-02-01", "2024-01-01")
    assert writers.read_latest(spark, path).count() == 2


def test_text_sinks(spark, tmp_path):
    writers.write_csv(spark.range(3), str(tmp_path / "c"))
    writers.write_json(spark.range(3), str(tmp_path / "j"))
    assert spark.read.option("header", True).csv(str(tmp_path / "c")).count() == 3
    assert spark.read.json(str(tmp_path / "j")).count() == 3


def test_incremental_run(spark, sf, tmp_path):
    """Days arrive one after the other; a repeated run changes nothing."""
    path = str(tmp_path / "st")
    keyed = key_trips(T.pings(spark, sf))
    points = T.pattern_points(spark, sf)
    early = keyed.filter("data_date < '2024-01-15'")
    one = update.append_stop_times(spark, early, points, path).first()
    held = spark.read.parquet(path)
    rest = update.new_days(keyed, held)
    assert rest.filter("data_date < '2024-01-14'").count() == 0
    update.append_stop_times(spark, rest, points, path)
    full = update.append_stop_times(spark, keyed, points, path).first()
    again = update.append_stop_times(spark, keyed, points, path).first()
    assert one.total_rows < full.total_rows == again.total_rows
    # Text dates of another form, and ids that end in no date, find the same days.
    other = str(tmp_path / "other")
    texted = keyed.withColumns({
        "data_date": F.date_format("data_date", "yyyyMMdd"),
        "unique_trip_vehicle_day": F.concat(F.col("unique_trip_vehicle_day"), F.lit("-x")),
    })
    for part in ("data_date < '20240115'", "data_date >= '20240115'"):
        update.append_stop_times(spark, texted.filter(part), points, other)
    days = lambda p: rows(spark.read.parquet(p).groupBy(F.col("service_date").cast("string")).count())
    assert days(other) == days(path)
    with pytest.raises(Exception, match="no service date"):
        update.append_stop_times(spark, keyed.withColumn("data_date", F.lit(None).cast("date")), points, other)
    state = update.update_metrics(
        spark, path, T.dated_timetable(spark, sf).select(
            "route_id", "pid", "schd_trip_id", "stop_id", "stop_sequence",
            F.lit(None).cast("timestamp_ntz").alias("bus_stop_time"),
        ), str(tmp_path / "m"), "2024-02-01", "2024-02-10",
    ).first()
    assert state.max_month == state.max_month_actual == "2024-01-01"


def test_stream_equals_batch(spark, tmp_path):
    """Files out of order, repeats across files, a run that goes on from the last one."""
    landing, base = tmp_path / "in", str(tmp_path / "out")
    landing.mkdir()
    vehicle = lambda v, h, m: {"vid": v, "tmstmp": f"202401{5 + h // 24:02d} {h % 24:02d}:{m:02d}", "lat": "41.9", "lon": "-87.6", "pid": "95", "rt": "9"}

    def land(name, *polls):
        doc = {"c": {"bustime-response": {"vehicle": [vehicle(v, h, m) for h, m in polls for v in ("1", "2")]}}}
        (landing / f"{name}.json").write_text(json.dumps(doc))

    def run():
        feed.run_once(feed.keyed_pings(feed.snapshot_stream(spark, str(landing), files_per_batch=1)), base).awaitTermination()
        stream = spark.read.parquet(f"{base}/hours").select("hour", "rt", "pings")
        batch = feed.hourly_pings(feed.keyed_pings(readers.read_snapshots(spark, str(landing)))).select("hour", "rt", "pings")
        assert rows(stream) == rows(batch)
        return {r.hour: r.pings for r in stream.collect()}

    for n, h in enumerate((12, 18, 13, 19, 14, 30)):
        land(n, (h, 0), (h, 5))
    assert run() == {"2024-01-05 12": 4, "2024-01-05 18": 4, "2024-01-05 13": 4, "2024-01-05 19": 4, "2024-01-05 14": 4, "2024-01-06 06": 4}
    land("late", (12, 5), (12, 10), (1, 0))
    got = run()
    assert got["2024-01-05 12"] == 6 and got["2024-01-05 01"] == 2
    assert run() == got


def test_missing_pattern_and_versions(spark):
    mk = lambda *p: spark.createDataFrame([(x, v) for x, v in p], "pid string, v string")
    current, historic = mk(("1", "c")), mk(("1", "h"), ("2", "h"))
    assert rows(P.current_or_historic(current, historic)) == [("1", "c"), ("2", "h")]
    assert rows(P.missing_patterns(mk(("3", "x"), ("1", "x")), historic)) == [("3",)]


def test_pull_adds_to_its_days_once(spark, tmp_path):
    import datetime as dt

    path = str(tmp_path / "p")
    pull = lambda *hours: spark.createDataFrame([(h, dt.datetime(2024, 1, 1 + h // 24, h % 24)) for h in hours], "id long, data_time timestamp_ntz")
    writers.write_pull(pull(1, 2, 30), path, "2024-02-01")
    for _ in range(2):
        writers.write_pull(pull(5, 31), path, "2024-02-02")
    assert rows(spark.read.parquet(path).groupBy("day").count().select(F.col("day").cast("string"), "count")) == [("2024-01-01", 3), ("2024-01-02", 2)]


def test_late_pings_are_counted_once(spark, tmp_path):
    """Vehicles whose minutes have left the state, seen again and seen for the first time."""
    import datetime as dt
    import random

    chance, base = random.Random(9), str(tmp_path / "out")
    seen = [(str(chance.randrange(4)), chance.randrange(20), chance.randrange(6), chance.randrange(60), f"r{chance.randrange(2)}") for _ in range(600)]
    rows_ = [(v, f"202401{1 + d:02d} {h:02d}:{m:02d}", dt.datetime(2024, 1, 1 + d, h, m), dt.date(2024, 1, 1 + d), "r" + v) for v, d, h, m, _ in seen]
    schema = "vid string, tmstmp string, data_time timestamp_ntz, data_date date, rt string"
    for i in range(4):
        spark.createDataFrame(rows_[150 * i : 150 * i + 200], schema).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    feed.run_once(stream, base, keep_days=3).awaitTermination()
    want = feed.hourly_pings(spark.createDataFrame(rows_, schema)).select("data_date", "hour", "rt", "pings")
    assert rows(spark.read.parquet(f"{base}/hours").select("data_date", "hour", "rt", "pings")) == rows(want)
    assert spark.read.parquet(f"{base}/pings").filter("late = 'true'").count() > 0


def test_minutes_in_state():
    import pandas as pd

    days = {}
    row = lambda *p: pd.DataFrame([{"day": d, "minute": m} for d, m in p])
    assert feed.remember(days, row((10, 0), (10, 0), (10, 1439), (12, 5)), 3)["late"].tolist() == [False] * 3
    assert feed.remember(days, row((10, 0), (16, 5), (11, 1)), 3)["late"].tolist() == [True, False, True]
    assert list(days) == [16]


def test_headers_are_first_lines(spark, tmp_path):
    """A line of data that holds names of columns is data."""
    folder = tmp_path / "feed"
    folder.mkdir()
    (folder / "trips.txt").write_text("trip_id,route_id\nt1,r1\ntrip_id,route_id\n")
    got = readers.read_gtfs(spark, str(tmp_path), "trips").select("trip_id", "route_id")
    assert rows(got) == [("t1", "r1"), ("trip_id", "route_id")]


def test_tables_by_stop_need_no_shuffle(spark, tmp_path):
    from headway.operators import visits as V

    import datetime as dt
    import random

    chance = random.Random(3)
    data = [(f"R{i % 3}", "1", str(i % 7), f"t{i}", i, dt.datetime(2024, 1, 1) + dt.timedelta(seconds=chance.randrange(10**6))) for i in range(400)]
    schema = "rt string, pid string, stop_id string, trip_id string, stop_sequence long, bus_stop_time timestamp_ntz"
    df = spark.createDataFrame(data, schema)
    writers.write_by_stop(df, str(tmp_path / "v"), "visits_here", buckets=8)
    stored = V.headways_by_stop(spark.table("visits_here"))
    plan = stored._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Window" in plan
    names = ["stop_sequence", "time_till_next_bus"]
    assert rows(stored.select(names)) == rows(V.headways(df).select(names))
    spark.sql("DROP TABLE visits_here")
    again = writers.table_by_stop(spark, str(tmp_path / "v"), "visits_there", schema, buckets=8)
    plan = V.headways_by_stop(again)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and rows(V.headways_by_stop(again).select(names)) == rows(V.headways(df).select(names))
    joined = again.join(again.groupBy("rt", "stop_id").count(), ["rt", "stop_id"])
    assert "Exchange hashpartitioning" not in joined._jdf.queryExecution().executedPlan().toString()


def test_inventory_of_folders(spark, tmp_path):
    writers.write_partitioned(spark.range(9).selectExpr("id", "cast(id % 3 as string) as pid"), str(tmp_path / "p"), ["pid"])
    assert rows(readers.file_inventory(spark, str(tmp_path / "p"), folder="pid")) == [("0",), ("1",), ("2",)]
