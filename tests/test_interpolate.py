"""Stop times against a plain Python reading of the method."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from headway.operators import interpolate as I

T0 = dt.datetime(2024, 1, 1, 8)
#: (position, x) of stops 0..5 on a straight line; a waypoint at 3.
POINTS = [(0, 0.0, "S"), (1, 300.0, "S"), (2, 600.0, "S"), (3, 800.0, "W"), (4, 1100.0, "S"), (5, 1500.0, "S")]


def run(spark, pings, anchor="next", points=POINTS):
    stops = spark.createDataFrame(
        [("1", k, typ, f"s{k}" if typ == "S" else None, f"1-s{k}" if typ == "S" else None, x, 0.0) for k, x, typ in points],
        "pid string, segment int, typ string, stpid string, p_stp_id string, x_m double, y_m double",
    )
    matched = spark.createDataFrame(
        [("1", "t", "R", 7, seg, x, 0.0, T0 + dt.timedelta(seconds=s)) for seg, x, s in pings],
        "pid string, unique_trip_vehicle_day string, rt string, vid long, seg_combined double, x_m double, y_m double, data_time timestamp_ntz",
    )
    out = I.interpolate_stop_times(matched, stops, anchor).orderBy("seg_combined").collect()
    return {r.stpid: ((r.bus_stop_time - T0).total_seconds() if r.bus_stop_time else None) for r in out}, out


def test_between_pings_both_anchors(spark):
    pings = [(1.5, 400.0, 0), (4.5, 1200.0, 80)]
    ref, out = run(spark, pings)
    # 800 m in 80 s; the reference counts up to the following row.
    assert ref["s2"] == pytest.approx(40.0) and ref["s4"] == pytest.approx(80.0)
    own, _ = run(spark, pings, "self")
    assert own["s2"] == pytest.approx(20.0) and own["s4"] == pytest.approx(70.0)
    assert [r.stop_sequence for r in out] == [1, 2, 3, 4, 5] and out[0].vid == "7" and out[0].p_stp_id == "1-s0"


def test_outside_pings_chain_at_known_speed(spark):
    ref, out = run(spark, [(1.5, 400.0, 0), (4.5, 1200.0, 80)])
    mph = (800 / 1609) / (80 / 3600)
    mps = mph / 2.23694
    # Steps of s0 and s1 reach the next stop; the last stop takes over the step before it.
    assert ref["s1"] == pytest.approx(-300 / mps, abs=1e-3)
    assert ref["s0"] == pytest.approx(-600 / mps, abs=1e-3)
    assert ref["s5"] == pytest.approx(80 + 400 / mps, abs=1e-3)
    assert all(r.speed_mph == pytest.approx(mph) for r in out)


def test_zero_length_group_has_no_time(spark):
    points = [(0, 0.0, "S"), (1, 300.0, "S"), (2, 300.0, "S"), (3, 900.0, "S")]
    got, _ = run(spark, [(0.5, 300.0, 0), (2.5, 300.0, 60), (3.5, 900.0, 120)], points=points)
    assert got["s1"] is None and got["s2"] is None
    assert got["s3"] == pytest.approx(120.0)


def test_speed_clamped_then_filled(spark):
    points = [(k, 1000.0 * k, "S") for k in range(6)]
    # Paces between pings: far too slow, fine, far too fast.
    pings = [(0.5, 500.0, 0), (1.5, 1500.0, 7200), (2.5, 2500.0, 7300), (3.5, 3500.0, 7301), (4.5, 4500.0, 7401)]
    _, out = run(spark, pings, points=points)
    fine = (1000 / 1609) / (100 / 3600)
    assert [r.speed_mph for r in out] == pytest.approx([fine] * 6)


def test_single_ping_gives_nothing(spark):
    got, _ = run(spark, [(1.5, 400.0, 0)])
    assert got == {}
    with pytest.raises(ValueError):
        run(spark, [(1.5, 400.0, 0)], anchor="x")


def test_times_never_fall_with_corrected_anchor(spark):
    pings = [(0.5, 150.0, 0), (1.5, 450.0, 30), (4.5, 1300.0, 100)]
    got, _ = run(spark, pings, "self")
    times = [got[s] for s in ("s0", "s1", "s2", "s4", "s5")]
    assert times == sorted(times)


def test_windows_do_not_sit_on_the_pattern_join(spark):
    """A pattern with a third of all trips must not be one task: rows are dealt by trip behind the join."""
    import datetime as dt
    import re

    matched = spark.createDataFrame(
        [("1", f"t{i}", "R", 1, dt.datetime(2024, 1, 1), k + 0.5, 0.0, 1.0 * k) for i in range(4) for k in range(3)],
        "pid string, unique_trip_vehicle_day string, rt string, vid int, data_time timestamp_ntz, seg_combined double, x_m double, y_m double",
    )
    stops = spark.createDataFrame(
        [("1", k, "S", f"s{k}", f"1-s{k}", 0.0, 1.0 * k) for k in range(4)],
        "pid string, segment int, typ string, stpid string, p_stp_id string, x_m double, y_m double",
    )
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = I.interpolate_stop_times(matched, stops)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    top = plan[: plan.index("SortMergeJoin")]
    assert re.search(r"Exchange hashpartitioning\(pid#\d+, unique_trip_vehicle_day#\d+", top)
    assert top.count("Exchange") == 1 and top.index("Window") < top.index("Exchange")


def test_rows_reach_the_windows_in_order(spark):
    """Pings and points of a trip are sorted before the windows sort all rows."""
    from headway.operators.interpolate import trip_rows

    at = "2024-01-01 08:00:00"
    matched = spark.createDataFrame(
        [("1", f"t{t}", "R", "v", at, float(-k), 0.0, k + 0.5) for t in range(30) for k in (7, 2, 5)],
        "pid string, unique_trip_vehicle_day string, rt string, vid string, data_time string, x_m double, y_m double, seg_combined double",
    ).withColumn("data_time", F.col("data_time").cast("timestamp_ntz"))
    stops = spark.createDataFrame(
        [("1", k, "S", str(k), f"1-{k}", float(k), 0.0) for k in (3, 9, 0, 6, 1)],
        "pid string, segment int, typ string, stpid string, p_stp_id string, x_m double, y_m double",
    )
    parts = trip_rows(matched, stops).select("unique_trip_vehicle_day", "seg_combined").rdd.glom().collect()
    assert sum(map(len, parts)) == 30 * 8
    assert all([tuple(r) for r in p] == sorted(tuple(r) for r in p) for p in parts)


def test_service_dates_in_all_forms(spark):
    from headway.plans.update import service_date

    forms = spark.createDataFrame([("20240131",), ("2024-01-31",)], "d string")
    assert {str(r[0]) for r in forms.select(service_date(F.col("d"))).collect()} == {"2024-01-31"}
    for bad in ("20240231", "2024-1-31", "2024-01-31 ", "x", None):
        with pytest.raises(Exception, match="no service date"):
            spark.createDataFrame([(bad,)], "d string").select(service_date(F.col("d"))).collect()
