"""The engine's input tables, derived from the general test tables.

Every stand-in reads a whole table and grows with it; the formulas are in
FIXTURES.md. A third of all trips run on pattern 100, so plans meet a hot key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

POINTS_PER_PATTERN = 24
AS_OF = "2024-02-10"


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def _visits(events: DataFrame, time: Column, patterns: int) -> DataFrame:
    group = F.expr("user_id div 15")
    return events.withColumn("__t", time).select(
        F.col("event_type").alias("rt"),
        (group % patterns).cast("string").alias("pid"),
        (F.col("user_id") % 25).cast("string").alias("stop_id"),
        F.concat_ws("-", "event_type", group.cast("string"), F.to_date("__t").cast("string")).alias("trip_id"),
        F.col("event_id").alias("stop_sequence"),
        F.col("__t").alias("bus_stop_time"),
    )


def visits_actual(spark: SparkSession, sf: str) -> DataFrame:
    return _visits(table(spark, sf, "events"), F.col("ts"), 4)


def visits_scheduled(spark: SparkSession, sf: str) -> DataFrame:
    shift = ((F.col("event_id") % 7) - 3) * 17
    return _visits(table(spark, sf, "events"), F.timestamp_add("MINUTE", shift.cast("int"), F.col("ts")), 5)


def _pattern_number(trip: Column) -> Column:
    return F.when(trip % 3 == 0, F.lit(0).cast("long")).otherwise(F.floor(trip / 20) + 1)


def _base_lat(p: Column) -> Column:
    return F.lit(41.0) + F.lit(0.0137) * (p % 50)


def _base_lon(p: Column) -> Column:
    return F.lit(-88.5) + F.lit(0.01) * F.floor(p / 50)


def pings(spark: SparkSession, sf: str) -> DataFrame:
    """Keyed-ping input: eight events make a trip along its pattern."""
    return pings_of(table(spark, sf, "events"))


def pings_of(events: DataFrame) -> DataFrame:
    e = events.select(
        "event_id", "ts", F.expr("event_id div 8").alias("t"), (F.col("event_id") % 8).alias("k")
    )
    u = (
        F.when(F.col("t") % 60 == 7, F.lit(0.0))
        .when((F.col("t") % 10 == 1) & (F.col("k") == 1), F.lit(0.3) * (F.col("t") % 4))
        .otherwise(F.lit(2.9) * F.col("k") + F.lit(0.3) * (F.col("t") % 4))
    )
    e = e.withColumns({"p": _pattern_number(F.col("t")), "u": u})
    j = F.floor("u")
    fr = F.col("u") - j
    zigzag = (j % 4) + fr * (((j + 1) % 4) - (j % 4))
    jitter = F.lit(0.0001) * ((F.expr("event_id div 2") % 3) - 1)
    lat = _base_lat(F.col("p")) + F.lit(0.002) * F.col("u") + jitter
    astray = (F.col("t") % 35 == 3) & (F.col("k") >= F.col("t") % 2)
    off = F.when((F.col("event_id") % 97 == 0) | astray, F.lit(0.01)).otherwise(F.lit(0.0))
    lon = _base_lon(F.col("p")) + F.lit(0.001) * zigzag + off
    alone = F.when(F.col("t") % 50 == 0, F.concat(F.lit("-"), F.col("k").cast("string"))).otherwise(F.lit(""))
    return e.select(
        F.col("event_id").alias("ping_id"),
        (F.lit(1000) + F.col("t") % 40).alias("vid"),
        F.date_format("ts", "yyyyMMdd HH:mm").alias("tmstmp"),
        lat.alias("lat"),
        lon.alias("lon"),
        (F.lit(100.0) + F.col("p")).alias("pid"),
        F.concat(F.lit("R"), (F.col("p") % 3).cast("string")).alias("rt"),
        (F.col("event_id") % 11 == 0).alias("dly"),
        F.concat(F.col("t").cast("string"), alone).alias("tatripid"),
        F.date_trunc("minute", F.col("ts")).cast("timestamp_ntz").alias("data_time"),
        F.to_date("ts").alias("data_date"),
    )


def long_trip(spark: SparkSession, sf: str) -> DataFrame:
    """All pings of pattern 100 as one trip, a second apart, slowly along the path and back to its start every 4096."""
    e = table(spark, sf, "events").filter(F.expr("event_id div 8") % 3 == 0)
    u = F.lit(0.0055) * (F.col("event_id") % 4096)
    fr, j = u - F.floor(u), F.floor(u)
    zigzag = (j % 4) + fr * (((j + 1) % 4) - (j % 4))
    return e.select(
        F.col("event_id").alias("ping_id"), F.lit(1).cast("long").alias("vid"),
        (_base_lat(F.lit(0)) + F.lit(0.002) * u).alias("lat"), (_base_lon(F.lit(0)) + F.lit(0.001) * zigzag).alias("lon"),
        F.lit(100.0).alias("pid"), F.lit("R0").alias("rt"), F.lit("long").alias("tatripid"),
        F.timestamp_add("SECOND", F.col("event_id").cast("int"), F.lit("2024-01-01").cast("timestamp_ntz")).alias("data_time"),
        F.lit("2024-01-01").cast("date").alias("data_date"),
    )


def pattern_numbers(spark: SparkSession, sf: str) -> DataFrame:
    e = table(spark, sf, "events").select(F.expr("event_id div 8").alias("t"))
    return e.select(_pattern_number(F.col("t")).alias("p")).distinct()


def pattern_points(spark: SparkSession, sf: str) -> DataFrame:
    """24 points for each pattern that occurs in the pings."""
    j, p = F.col("j"), F.col("p")
    stop = j % 3 != 2
    stpid = F.when(stop, (F.lit(1000) + p * 100 + j).cast("string"))
    return (
        pattern_numbers(spark, sf)
        .withColumn("j", F.explode(F.sequence(F.lit(0), F.lit(POINTS_PER_PATTERN - 1))))
        .select(
            (F.lit(100) + p).cast("string").alias("pid"),
            (j + 1).cast("int").alias("seq"),
            (_base_lat(p) + F.lit(0.002) * j).alias("lat"),
            (_base_lon(p) + F.lit(0.001) * (j % 4)).alias("lon"),
            F.when(stop, "S").otherwise("W").alias("typ"),
            stpid.alias("stpid"),
            F.concat(F.lit("stop "), stpid).alias("stpnm"),
            (j * 700.0).alias("pdist"),
        )
    )


def known_patterns(spark: SparkSession, sf: str) -> DataFrame:
    """Pattern ids on file, which cover only part of those that occur."""
    c = table(spark, sf, "customer")
    return c.select((F.lit(100) + F.col("c_nationkey") * 2).cast("string").alias("pid")).distinct()


def calendar(spark: SparkSession, sf: str) -> DataFrame:
    r = F.col("r_regionkey")
    days = ("monday", "tuesday", "wednesday", "thursday", "friday", "saturday", "sunday")
    return table(spark, sf, "region").select(
        r.cast("string").alias("service_id"),
        *[((r + d) % 3 != 0).cast("int").cast("string").alias(n) for d, n in enumerate(days, 1)],
        F.lit("20240101").alias("start_date"),
        F.lit("20240114").alias("end_date"),
    )


def calendar_dates(spark: SparkSession, sf: str) -> DataFrame:
    r = F.col("r_regionkey")
    return table(spark, sf, "region").select(
        r.cast("string").alias("service_id"),
        F.date_format(F.date_add(F.lit("2024-01-01").cast("date"), r * 3), "yyyyMMdd").alias("date"),
        (r % 2 + 1).cast("string").alias("exception_type"),
    )


def gtfs_trips(spark: SparkSession, sf: str) -> DataFrame:
    o = F.col("o_orderkey")
    return table(spark, sf, "orders").select(
        F.concat(F.lit("R"), (F.col("o_custkey") % 25).cast("string")).alias("route_id"),
        (o % 5).cast("string").alias("service_id"),
        o.cast("string").alias("trip_id"),
        F.concat(F.lit("6430"), F.lpad((o % 60 + 100).cast("string"), 5, "0")).alias("shape_id"),
        (o % 600).cast("string").alias("schd_trip_id"),
    )


def gtfs_routes(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "nation").select(
        F.concat(F.lit("R"), F.col("n_nationkey").cast("string")).alias("route_id"),
        F.when(F.col("n_regionkey") != 2, F.col("n_name")).alias("route_short_name"),
    )


def _arrival() -> Column:
    seconds = (F.col("l_orderkey") % 50) * 1860 + F.col("l_linenumber") * 127
    part = lambda c: F.lpad(c.cast("string"), 2, "0")
    return F.concat_ws(
        ":", part(F.floor(seconds / 3600)), part(F.floor(seconds / 60) % 60), part(seconds % 60)
    )


def gtfs_stop_times(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "lineitem").select(
        F.col("l_orderkey").cast("string").alias("trip_id"),
        (F.col("l_partkey") % 40).cast("string").alias("stop_id"),
        F.col("l_linenumber").cast("string").alias("stop_sequence"),
        _arrival().alias("arrival_time"),
        _arrival().alias("departure_time"),
    )


def dated_timetable(spark: SparkSession, sf: str) -> DataFrame:
    """``timetable_raw`` of three feed versions, each shifted 700 days from the one before."""
    v = F.col("l_linenumber") % 3
    return table(spark, sf, "lineitem").select(
        F.concat(F.lit("R"), (F.col("l_suppkey") % 10).cast("string")).alias("route_id"),
        (F.col("l_partkey") % 7).cast("string").alias("pid"),
        F.col("l_suppkey").cast("string").alias("schd_trip_id"),
        (F.col("l_partkey") % 40).cast("string").alias("stop_id"),
        F.col("l_linenumber").cast("string").alias("stop_sequence"),
        F.date_format(F.date_add(F.to_date("l_shipdate"), v * 700), "yyyyMMdd").alias("date"),
        _arrival().alias("arrival_time"),
        _arrival().alias("departure_time"),
        F.lit("1").alias("service_id"),
        F.col("l_orderkey").cast("string").alias("trip_id"),
        F.concat(F.lit("v"), v.cast("string")).alias("sha1"),
        F.concat(F.lit("2024-0"), (v + 1).cast("string"), F.lit("-01")).alias("fetched_date"),
    )


def reused_timetable(spark: SparkSession, sf: str) -> DataFrame:
    """Scheduled rows whose trip id is a supplier, so each id is used over and over."""
    return table(spark, sf, "lineitem").select(
        F.concat(F.lit("R"), (F.col("l_suppkey") % 3).cast("string")).alias("rt"),
        F.col("l_suppkey").alias("schd_trip_id"),
        F.col("l_partkey").alias("stop_id"),
        F.col("l_linenumber").alias("stop_sequence"),
        F.timestamp_add("SECOND", (F.col("l_orderkey") % 86400).cast("int"), F.col("l_shipdate")).alias("bus_stop_time"),
    )


def areas(spark: SparkSession, sf: str) -> DataFrame:
    """One area per nation on a 5 x 5 grid: an L (n % 3 = 0), a frame with a hole (1) or two strips apart (2)."""
    n = F.col("n_nationkey")
    x0 = F.lit(-87.8) + F.lit(0.05) * (n % 5)
    y0 = F.lit(41.7) + F.lit(0.05) * F.floor(n / 5)
    at = lambda dx, dy: F.struct((F.col("x0") + dx).alias("x"), (F.col("y0") + dy).alias("y"))
    full = F.array(at(0.0, 0.0), at(0.05, 0.0), at(0.05, 0.05), at(0.0, 0.05))
    ell = F.array(at(0.0, 0.0), at(0.05, 0.0), at(0.05, 0.025), at(0.025, 0.025), at(0.025, 0.05), at(0.0, 0.05))
    hole = F.array(at(0.0125, 0.0125), at(0.0375, 0.0125), at(0.0375, 0.0375), at(0.0125, 0.0375))
    strip = lambda a, b: F.array(at(a, 0.0), at(b, 0.0), at(b, 0.05), at(a, 0.05))
    parts = (
        F.when(n % 3 == 0, F.array(F.array(ell)))
        .when(n % 3 == 1, F.array(F.array(full, hole)))
        .otherwise(F.array(F.array(strip(0.0, 0.02)), F.array(strip(0.03, 0.05))))
    )
    based = table(spark, sf, "nation").select(n, F.col("n_name"), x0.alias("x0"), y0.alias("y0"))
    return based.select(F.col("n_name").alias("community"), parts.alias("parts"))


def _scatter(key: str) -> tuple[Column, Column]:
    k = F.col(key)
    return (
        F.lit(-87.8197) + F.lit(0.001) * ((k * 53) % 290),
        F.lit(41.6903) + F.lit(0.001) * ((k * 37) % 270),
    )


def area_stops(spark: SparkSession, sf: str) -> DataFrame:
    lon, lat = _scatter("s_suppkey")
    return table(spark, sf, "supplier").select(
        F.col("s_suppkey").cast("string").alias("stop_id"), lon.alias("lon"), lat.alias("lat")
    )


def tracts(spark: SparkSession, sf: str) -> DataFrame:
    lon, lat = _scatter("c_custkey")
    return table(spark, sf, "customer").select(
        F.col("c_custkey").cast("string").alias("geoid"), (F.col("c_custkey") % 1000).alias("pop"),
        lon.alias("lon"), lat.alias("lat"),
    )


def tract_areas(spark: SparkSession, sf: str) -> DataFrame:
    """One area per customer: a diamond (k % 3 = 0), one with a hole (1) or two apart (2); every fiftieth is large."""
    k = F.col("c_custkey")
    lon, lat = _scatter("c_custkey")
    size = F.when(k % 50 == 0, F.lit(0.0831)).otherwise(F.lit(0.0031) + F.lit(0.0002) * (k % 7))
    at = lambda dx, dy: F.struct((F.col("lon") + F.col("r") * dx).alias("x"), (F.col("lat") + F.col("r") * dy).alias("y"))
    diamond = lambda dx, s: F.array(at(dx + s, 0.0), at(dx, s), at(dx - s, 0.0), at(dx, -s))
    parts = (
        F.when(k % 3 == 0, F.array(F.array(diamond(0.0, 1.0))))
        .when(k % 3 == 1, F.array(F.array(diamond(0.0, 1.0), diamond(0.0, 0.5))))
        .otherwise(F.array(F.array(diamond(0.0, 1.0)), F.array(diamond(3.0, 1.0))))
    )
    based = table(spark, sf, "customer").select(k, lon.alias("lon"), lat.alias("lat"), size.alias("r"))
    return based.select(k.cast("string").alias("geoid"), (k % 1000).alias("pop"), parts.alias("parts"))


def snapshots(spark: SparkSession, sf: str) -> DataFrame:
    """One JSON document per ping: its vehicle in the first chunk, an error in the second now and then."""
    return snapshots_of(table(spark, sf, "events"))


def snapshots_of(events: DataFrame) -> DataFrame:
    p = pings_of(events)
    vehicle = F.struct(
        F.col("vid").cast("string").alias("vid"), "tmstmp", F.col("lat").cast("string").alias("lat"),
        F.col("lon").cast("string").alias("lon"), F.col("pid").cast("string").alias("pid"), "rt",
        F.col("dly").cast("string").alias("dly"), "tatripid",
    )
    error = F.when(
        F.col("ping_id") % 113 == 0, F.array(F.struct("rt", F.lit("No data found for parameter").alias("msg")))
    )
    response = lambda v, e: F.struct(F.struct(v.alias("vehicle"), e.alias("error")).alias("bustime-response"))
    none_v = F.lit(None).cast(
        "array<struct<vid:string,tmstmp:string,lat:string,lon:string,pid:string,rt:string,dly:string,tatripid:string>>"
    )
    none_e = F.lit(None).cast("array<struct<rt:string,msg:string>>")
    doc = F.create_map(
        F.lit("chunk_0"), response(F.array(vehicle), none_e), F.lit("chunk_1"), response(none_v, error)
    )
    return p.select(F.to_json(doc).alias("value"), F.concat(F.lit("poll-"), F.col("ping_id").cast("string")).alias("scrape_file"))


def gtfs_shapes(spark: SparkSession, sf: str) -> DataFrame:
    """Two points near every pattern point, some of them exactly on it."""
    pts = pattern_points(spark, sf).withColumn("j", F.col("seq") - 1)
    copies = F.array(
        F.struct(F.lit(0).alias("c"), (F.lit(0.00002) * (F.col("j") % 4)).alias("d")),
        F.struct(F.lit(1).alias("c"), (F.lit(0.00001) * (F.col("j") % 3)).alias("d")),
    )
    return pts.select("pid", "j", "lat", "lon", F.inline(copies)).select(
        F.concat(F.lit("6430"), F.lpad("pid", 5, "0")).alias("shape_id"),
        (F.col("lat") + F.col("d")).cast("string").alias("shape_pt_lat"),
        F.col("lon").cast("string").alias("shape_pt_lon"),
        (F.col("j") * 2 + F.col("c") + 1).cast("string").alias("shape_pt_sequence"),
        (F.col("j") * 700.0).cast("string").alias("shape_dist_traveled"),
    )


def gtfs_stops(spark: SparkSession, sf: str) -> DataFrame:
    """The patterns' stops; every ninth point has a second stop in the same spot."""
    pts = pattern_points(spark, sf).filter(F.col("typ") == "S")
    here = F.struct(F.col("stpid").alias("id"), F.col("stpnm").alias("name"))
    twin = F.struct(F.concat("stpid", F.lit("b")).alias("id"), F.concat("stpnm", F.lit("b")).alias("name"))
    both = F.when(F.col("seq") % 9 == 4, F.array(here, twin)).otherwise(F.array(here))
    return pts.withColumn("both", both).select("*", F.explode("both").alias("one")).select(
        F.col("one.id").alias("stop_id"), F.col("one.name").alias("stop_name"),
        F.col("lat").cast("string").alias("stop_lat"), F.col("lon").cast("string").alias("stop_lon"),
        F.when(F.col("seq") == 1, "1").otherwise("0").alias("location_type"),
        F.when(F.col("seq") == 2, F.lit("hub")).alias("parent_station"),
    )
