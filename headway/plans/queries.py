"""The registered queries: one per operator or public figure of the engine.

Doubles are rounded here, and only here, so that two engines can be compared.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from headway import constants as K, schemas
from headway.functions import geo, keys, projection
from headway.functions.clock import on_day, service_time
from headway.operators import (
    areas as A, audit, exports, interpolate, leg_speed, matching, metrics as M, overlay, patterns as P,
    pings as PG, qc, ranks, reach, rollup as R, schedule as S, visits as V,
)
from headway.operators.periods import OLDER_PERIODS
from headway.plans import stand_ins as T
from headway.plans.incremental import MetricStore
from headway.plans.update import append_stop_times, new_days
from headway.session import run_folder, staged
from headway.sources import readers, writers
from headway.streaming import feed

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def rounded(df: DataFrame, places: int = 6, **more: int) -> DataFrame:
    """Round double columns; ``more`` sets other places for single columns."""
    cols = [
        F.round(c, more.get(c, places)).alias(c) if t == "double" else F.col(c) for c, t in df.dtypes
    ]
    return df.select(*cols)


def to_second(c: str) -> F.Column:
    """Text of the second a time falls in, moved off the natural halves before cutting."""
    return F.date_format(F.timestamp_add("MILLISECOND", F.lit(370), F.col(c)), "yyyy-MM-dd HH:mm:ss")


# --- keys and clocks ---------------------------------------------------------


@query
def trip_keys(spark, sf):
    p = T.pings(spark, sf)
    old = keys.trip_key("rt", "pid", "tatripid", "vid", "data_date", sep="_")
    return PG.key_trips(p.withColumn("key_sep", old)).select(
        "ping_id", "pid", "unique_trip_vehicle_day", "key_sep"
    )


@query
def trip_keys_null_parts(spark, sf):
    o = T.table(spark, sf, "orders").select(
        "o_orderkey", F.when(F.col("o_orderstatus") != "F", F.col("o_orderstatus")).alias("a"),
        F.col("o_custkey").cast("string").alias("b"),
    )
    return o.select("o_orderkey", keys.trip_key("a", "b").alias("k"))


@query
def pid_normalised(spark, sf):
    e = T.table(spark, sf, "events")
    u = F.col("user_id").cast("string")
    text = (
        F.when(F.col("event_id") % 5 == 0, F.concat(u, F.lit(".0")))
        .when(F.col("event_id") % 5 == 1, u)
        .when(F.col("event_id") % 5 == 2, F.concat(F.lit("x"), u))
        .when(F.col("event_id") % 5 == 3, F.concat(u, F.lit(".7")))
    )
    pid = keys.normal_pid(text)
    return e.select("event_id", pid.alias("pid"), keys.padded_pid(pid).alias("padded"))


@query
def shape_pids(spark, sf):
    t = T.gtfs_trips(spark, sf)
    pid = keys.shape_pid("shape_id")
    return t.select("trip_id", pid.alias("pid"), keys.bare_pid(pid).alias("bare"))


@query
def schedule_clock(spark, sf):
    raw = T.dated_timetable(spark, sf).select(
        "trip_id", "stop_id", "stop_sequence", "schd_trip_id", "arrival_time",
        F.regexp_replace("date", r"^(\d{4})(\d{2})(\d{2})$", "$1-$2-$3").cast("date").alias("d"),
    )
    text = lambda c: F.date_format(c, "yyyy-MM-dd HH:mm:ss")
    return raw.select(
        "trip_id", "stop_id", "stop_sequence", "schd_trip_id",
        text(service_time(F.col("d"), "arrival_time")).alias("bus_stop_time"),
        text(service_time(F.col("d"), "arrival_time", strict_reference=True)).alias("strict_time"),
    )


# --- visits and metrics ------------------------------------------------------


@query
def visit_metrics(spark, sf):
    m = V.stop_event_metrics(T.visits_actual(spark, sf))
    return m.select(
        "rt", "pid", "stop_id", "trip_id", F.col("stop_sequence").alias("event_id"),
        "time_till_next_bus", "time_to_previous_stop", "cum_trip_time", "hour", "month", "year", "day",
    )


@query
def headway_within_day(spark, sf):
    v = V.daytime(T.visits_actual(spark, sf))
    return V.headways(v, bucket="hour", within_day=True).select("stop_sequence", "time_till_next_bus")


@query
def segment_times_bucketed(spark, sf):
    v = V.segment_times(V.daytime(T.visits_actual(spark, sf)), bucket="hour")
    return v.select("rt", "trip_id", "stop_sequence", "time_to_previous_stop", "cum_trip_time")


def _one_period(name: str, period: str, metric: str, value: str | None) -> None:
    def run(spark, sf):
        v = V.daytime(T.visits_actual(spark, sf))
        if metric == "time_till_next_bus":
            v = V.headways(v)
        elif value is not None:
            v = V.segment_times(v)
        return rounded(M.period_metrics(v, metric, value, periods=[period], as_of=T.AS_OF))

    run.__name__ = name
    query(run)


for _p in ("hour", "weekday", "year_hour", "month_abs", "last_full_month"):
    _one_period(f"headway_by_{_p}", _p, "time_till_next_bus", "time_till_next_bus")
_one_period("segment_time_by_weekday", "weekday", "time_to_previous_stop", "time_to_previous_stop")
_one_period("cum_trip_time_by_year_weekday", "year_weekday", "cum_trip_time", "cum_trip_time")
_one_period("bus_counts_by_hour", "hour", "num_buses", None)
_one_period("bus_counts_by_weekday", "weekday", "num_buses", None)


@query
def bus_counts_two_level(spark, sf):
    return rounded(M.period_metrics(V.daytime(T.visits_actual(spark, sf)), "num_buses", as_of=T.AS_OF))


@query
def stop_metrics_actual(spark, sf):
    return rounded(M.stop_metrics(T.visits_actual(spark, sf), "actual", as_of=T.AS_OF))


@query
def stop_metrics_schedule(spark, sf):
    return rounded(M.stop_metrics(T.visits_scheduled(spark, sf), "schedule", as_of=T.AS_OF))


@query
def stop_metrics_compare(spark, sf):
    return rounded(
        M.stop_metrics_both(T.visits_actual(spark, sf), T.visits_scheduled(spark, sf), as_of=T.AS_OF)
    )


@query
def stop_metrics_joined(spark, sf):
    a = M.stop_metrics(T.visits_actual(spark, sf), "actual", periods=["weekday"])
    s = M.stop_metrics(T.visits_scheduled(spark, sf), "schedule", periods=["weekday"])
    return rounded(M.compare_stop_metrics(a, s))


@query
def trip_durations(spark, sf):
    return M.trip_durations(T.visits_actual(spark, sf)).select("trip_id", "rt", "pid", "trip_duration")


@query
def trip_metrics_actual(spark, sf):
    return rounded(M.trip_metrics(T.visits_actual(spark, sf), "actual", as_of=T.AS_OF))


@query
def trip_duration_compare(spark, sf):
    return rounded(
        M.compare_trip_metrics(T.visits_actual(spark, sf), T.visits_scheduled(spark, sf), as_of=T.AS_OF)
    )


@query
def long_metric_pack(spark, sf):
    v = V.headways(V.daytime(T.visits_actual(spark, sf)))
    return rounded(
        M.period_metrics(v, "time_till_next_bus", "time_till_next_bus", periods=OLDER_PERIODS, stats=ranks.LONG_PACK),
        4,
    )


@query
def hourly_counts_both(spark, sf):
    h = M.hourly_counts_both(T.visits_actual(spark, sf), T.visits_scheduled(spark, sf))
    return h.withColumn("hour", F.date_format("hour", "yyyy-MM-dd HH"))


@query
def metrics_state(spark, sf):
    return M.metrics_state(
        M.stop_metrics_both(
            T.visits_actual(spark, sf), T.visits_scheduled(spark, sf), periods=["month_abs", "hour"]
        )
    )


@query
def reused_trip_split(spark, sf):
    rows = V.split_reused_trips(T.reused_timetable(spark, sf))
    return rows.select("rt", "schd_trip_id", "stop_id", "stop_sequence", "trip_id")


# --- roll-ups ----------------------------------------------------------------


def _stop_table(spark, sf, periods):
    return M.stop_metrics_both(
        T.visits_actual(spark, sf), T.visits_scheduled(spark, sf), periods=periods,
        stats=("count", "median", "std"),
    )


def _stop_areas(spark, sf):
    n = T.table(spark, sf, "nation")
    r = T.table(spark, sf, "region")
    return n.join(r, n.n_regionkey == r.r_regionkey).select(
        F.col("r_name").alias("community"), F.col("n_nationkey").cast("string").alias("stop_id")
    )


@query
def weighted_median_rt(spark, sf):
    m = _stop_table(spark, sf, ["month_abs"])
    return rounded(
        R.weighted_median_by(m, "rt", "month_abs", "median_actual_time_till_next_bus", "count_actual_time_till_next_bus")
    )


@query
def weighted_median_area(spark, sf):
    m = _stop_table(spark, sf, ["hour"]).join(_stop_areas(spark, sf), "stop_id")
    return rounded(
        R.weighted_median_by(
            m, "community", "hour", "median_actual_cum_trip_time", "count_actual_cum_trip_time",
            drop_periods=("6",),
        )
    )


@query
def weight_shares(spark, sf):
    m = _stop_table(spark, sf, ["weekday"]).select(
        "rt", "pid", "stop_id", "period_value", F.col("count_actual_num_buses").alias("n")
    )
    return rounded(ranks.with_weights(m.filter("n > 0"), ["rt", "period_value"], "n"))


@query
def summary_by_rt(spark, sf):
    m = R.without_routes(_stop_table(spark, sf, ["weekday"]), ["error"])
    t = M.compare_trip_metrics(T.visits_actual(spark, sf), T.visits_scheduled(spark, sf), periods=["weekday"])
    return rounded(R.summary_by(m, t, "rt", "weekday"), 4)


@query
def summary_by_area(spark, sf):
    m = _stop_table(spark, sf, ["hour"]).join(_stop_areas(spark, sf), "stop_id")
    return rounded(R.summary_by(m, None, "community", "hour"), 4)


@query
def summary_one_value(spark, sf):
    m = _stop_table(spark, sf, ["dayofyear"])
    return rounded(R.summary_by(m, None, "rt", "one_value"), 4)


@query
def summary_one_year(spark, sf):
    m = _stop_table(spark, sf, ["year"])
    t = M.compare_trip_metrics(T.visits_actual(spark, sf), T.visits_scheduled(spark, sf), periods=["year"])
    return rounded(R.summary_by(m, t, "rt", 2024), 4)


@query
def buses_per_hour_wait(spark, sf):
    b = R.buses_per_hour(T.visits_actual(spark, sf))
    return rounded(b.withColumn("hour", F.date_format("hour", "yyyy-MM-dd HH")))


@query
def average_service_by_route(spark, sf):
    b = R.buses_per_hour(T.visits_actual(spark, sf))
    return rounded(R.average_service(b, F.col("stop_id"), F.col("rt"), F.col("year")))


@query
def average_service_by_day(spark, sf):
    b = R.buses_per_hour(T.visits_actual(spark, sf))
    return rounded(
        R.average_service(b, F.date_format("hour", "yyyy-MM-dd").alias("day"), F.hour("hour").alias("clock_hour"))
    )


@query
def area_service(spark, sf):
    b = R.buses_per_hour(T.visits_actual(spark, sf))
    per_stop = R.average_service(b, "stop_id", "rt", "year")
    return rounded(R.area_service(per_stop, _stop_areas(spark, sf)))


@query
def busiest_pattern(spark, sf):
    return R.busiest_pattern(T.visits_actual(spark, sf))


@query
def trip_profiles(spark, sf):
    p = R.trip_profiles(V.daytime(T.visits_actual(spark, sf)))
    return p.select("rt", "pid", "trip_id", "stop_id", "stop_sequence", "cum_trip_time")


@query
def sampled_trip_profiles(spark, sf):
    p = R.trip_profiles(V.daytime(T.visits_actual(spark, sf)), n=100, seed=7)
    return p.select("rt", "pid", "trip_id", "stop_id", "stop_sequence", "cum_trip_time")


@query
def median_profile(spark, sf):
    return rounded(R.median_profile(_stop_table(spark, sf, ["year"]), "2024"))


# --- schedule ----------------------------------------------------------------


@query
def service_days(spark, sf):
    # Days of each service with the trips they put on the road.
    d = S.service_days(T.calendar(spark, sf), T.calendar_dates(spark, sf))
    n = T.gtfs_trips(spark, sf).groupBy("service_id").agg(F.count(F.lit(1)).alias("trips"))
    return d.join(n, "service_id").withColumn("date", F.col("date").cast("string"))


@query
def active_trips(spark, sf):
    d = S.service_days(T.calendar(spark, sf), T.calendar_dates(spark, sf))
    t = S.active_trips(T.gtfs_trips(spark, sf), d)
    return t.select("trip_id", "route_id", F.col("date").cast("string").alias("date"))


@query
def trips_on_date(spark, sf):
    d = S.service_days(T.calendar(spark, sf), T.calendar_dates(spark, sf))
    return S.trips_on(T.gtfs_trips(spark, sf), d, "2024-01-04").select("trip_id", "service_id", "shape_id")


def _expanded(spark, sf, packed=False):
    return S.expand_schedule(
        T.gtfs_trips(spark, sf), T.gtfs_stop_times(spark, sf), T.calendar(spark, sf),
        T.calendar_dates(spark, sf), T.gtfs_routes(spark, sf), "v1", "2024-01-01", packed,
    )


@query
def expand_schedule(spark, sf):
    e = _expanded(spark, sf)
    return e.select(
        "route_id", "pid", "schd_trip_id", "stop_id", "stop_sequence", F.col("date").cast("string").alias("date"),
        "arrival_time", "departure_time", "service_id", "trip_id", "sha1",
    )


@query
def clean_schedule(spark, sf):
    c = S.clean_schedule(_expanded(spark, sf, packed=True))
    return c.select(
        "route_id", "pid", "schd_trip_id", "stop_id", "stop_sequence", "service_id", "trip_id",
        F.date_format("bus_stop_time", "yyyy-MM-dd HH:mm:ss").alias("bus_stop_time"),
    )


@query
def metrics_from_schedule(spark, sf):
    """The schedule's whole way: feed tables, expansion, clock times, reused ids, metrics beside the actual ones."""
    scheduled = V.scheduled_visits(S.clean_schedule(_expanded(spark, sf, packed=True), packed=True))
    return rounded(M.stop_metrics_both(T.visits_actual(spark, sf), scheduled, periods=["hour"]))


@query
def schedule_merge(spark, sf):
    raw = T.dated_timetable(spark, sf)
    newest = raw.filter(F.col("sha1") == "v2")
    # The history is a stored table in a real run.
    older = staged(S.clean_schedule(raw.filter(F.col("sha1") != "v2")))
    out = S.merge_schedule(newest, older)
    return out.select(
        "route_id", "schd_trip_id", "stop_id", "stop_sequence", "trip_id",
        F.date_format("bus_stop_time", "yyyy-MM-dd HH:mm:ss").alias("bus_stop_time"),
    )


@query
def feed_windows(spark, sf):
    w = S.feed_windows(T.dated_timetable(spark, sf))
    return w.select(
        "route_id", "sha1", F.col("min_date").cast("string").alias("min_date"),
        F.col("valid_to").cast("string").alias("valid_to"),
    )


@query
def feed_version_dedupe(spark, sf):
    return S.dedupe_feed_versions(T.dated_timetable(spark, sf)).select(
        "route_id", "sha1", "date", "trip_id", "stop_id", "stop_sequence", "schd_trip_id"
    )


@query
def schedule_state(spark, sf):
    s = S.schedule_state(S.clean_schedule(T.dated_timetable(spark, sf)))
    return s.withColumn("max_day", F.col("max_day").cast("string"))


# --- geometry, pings to stop times -------------------------------------------


def _keyed(spark, sf):
    return PG.key_trips(T.pings(spark, sf))


def _geometry(spark, sf):
    return P.build_patterns(T.pattern_points(spark, sf))


def _matched(spark, sf, **kw):
    cleaned = PG.clean_pings(_keyed(spark, sf))
    return cleaned, matching.match_to_legs(cleaned, _geometry(spark, sf)[1], **kw)


@query
def project_points(spark, sf):
    return rounded(geo.with_xy(T.pings(spark, sf)).select("ping_id", "x_m", "y_m"), 3)


@query
def pattern_legs(spark, sf):
    _, legs = _geometry(spark, sf)
    return rounded(legs.select("pid", F.col("segments").cast("long").alias("segments"), "length_ft"), 3)


@query
def pattern_stops(spark, sf):
    stops, _ = _geometry(spark, sf)
    return rounded(
        stops.select("pid", F.col("segment").cast("long").alias("segment"), "typ", "stpid", "p_stp_id", "x_m", "y_m"), 3
    )


@query
def stops_per_pattern(spark, sf):
    return P.stops_per_pattern(T.pattern_points(spark, sf))


@query
def current_or_historic(spark, sf):
    pts = T.pattern_points(spark, sf)
    current = pts.join(T.known_patterns(spark, sf), "pid", "left_semi").withColumn("version", F.lit("current"))
    historic = pts.withColumn("version", F.lit("historic"))
    return P.current_or_historic(current, historic).select("pid", F.col("seq").cast("long").alias("seq"), "version")


@query
def clean_pings(spark, sf):
    c = PG.clean_pings(_keyed(spark, sf), only_kept=False)
    return c.select("ping_id", "unique_trip_vehicle_day", "drop_reason")


@query
def ping_candidates(spark, sf):
    xy = geo.with_xy(_keyed(spark, sf))
    c = matching.candidate_legs(xy, _geometry(spark, sf)[1])
    return c.select("ping_id", "seg_combined")


@query
def first_candidates(spark, sf):
    xy = geo.with_xy(_keyed(spark, sf))
    first = matching.first_candidate(matching.candidate_legs(xy, _geometry(spark, sf)[1]))
    return first.select("ping_id", "seg_combined")


@query
def off_route_pings(spark, sf):
    xy = geo.with_xy(_keyed(spark, sf))
    c = matching.candidate_legs(xy, _geometry(spark, sf)[1])
    return matching.off_route(xy, c).select("ping_id")


@query
def match_legs(spark, sf):
    _, m = _matched(spark, sf)
    return m.select("ping_id", "pid", "unique_trip_vehicle_day", "seg_combined")


@query
def match_long_trip(spark, sf):
    """A third of all pings as one trip that never ends."""
    keyed = geo.with_xy(PG.key_trips(T.long_trip(spark, sf)))
    m = matching.match_to_legs(keyed, _geometry(spark, sf)[1])
    return m.select("ping_id", "pid", "unique_trip_vehicle_day", "seg_combined")


@query
def match_status(spark, sf):
    c, m = _matched(spark, sf)
    return matching.match_status(c, m)


def _stop_times(spark, sf, leg_offset=0.5, anchor="next"):
    stops, _ = _geometry(spark, sf)
    _, m = _matched(spark, sf, leg_offset=leg_offset)
    return interpolate.interpolate_stop_times(m, stops, anchor)


def _readable(st):
    return rounded(
        st.select(
            "unique_trip_vehicle_day", "rt", "pid", "vid", "stpid", "p_stp_id",
            F.col("stop_sequence").cast("long").alias("stop_sequence"),
            to_second("bus_stop_time").alias("bus_stop_time"), "speed_mph",
        ),
        4,
    )


@query
def interpolate_stops(spark, sf):
    return _readable(_stop_times(spark, sf))


@query
def interpolate_corrected(spark, sf):
    return _readable(_stop_times(spark, sf, leg_offset=-0.5, anchor="self"))


@query
def metrics_from_pings(spark, sf):
    """The whole way: pings, keys, cleaning, matching, interpolation, visits, metrics."""
    st = _stop_times(spark, sf).withColumn("bus_stop_time", to_second("bus_stop_time").cast("timestamp_ntz"))
    v = V.actual_visits(st.filter(F.col("bus_stop_time").isNotNull()))
    return rounded(M.stop_metrics(v, "actual", periods=["hour"]))


@query
def trip_stop_geometry(spark, sf):
    stops, _ = _geometry(spark, sf)
    st = _keyed(spark, sf).select(
        "ping_id", "pid", (F.col("pid").cast("long") * 100 - 9000 + F.col("ping_id") % 26).cast("string").alias("stpid")
    )
    return rounded(exports.trip_stop_geometry(st, stops).select("ping_id", "stpid", "lat", "lon"))


@query
def reject_report(spark, sf):
    keyed = _keyed(spark, sf)
    c, m = _matched(spark, sf)
    return interpolate.reject_report(keyed, matching.match_status(c, m))


@query
def rejected_trips(spark, sf):
    c, m = _matched(spark, sf)
    return interpolate.rejects(matching.match_status(c, m))


@query
def leg_times(spark, sf):
    _, legs = _geometry(spark, sf)
    _, m = _matched(spark, sf)
    out = leg_speed.leg_times(m, legs).withColumn("segments", F.col("segments").cast("long"))
    return rounded(out, 3)


@query
def patterns_from_gtfs(spark, sf):
    g = P.patterns_by_coordinates(T.gtfs_shapes(spark, sf), T.gtfs_stops(spark, sf), T.gtfs_trips(spark, sf))
    return g.select("pid", F.col("seq").cast("long").alias("seq"), "typ", "stpid", "pdist")


@query
def nearest_stop_points(spark, sf):
    g = P.patterns_by_distance(
        T.gtfs_shapes(spark, sf), P.bus_stops_only(T.gtfs_stops(spark, sf)), T.gtfs_trips(spark, sf)
    )
    return g.select("pid", F.col("seq").cast("long").alias("seq"), "typ", "stpid", "stpnm")


@query
def stop_pattern_catalogue(spark, sf):
    return P.stop_pattern_catalogue(T.gtfs_trips(spark, sf), T.gtfs_stop_times(spark, sf))


# --- areas -------------------------------------------------------------------


@query
def stops_in_areas(spark, sf):
    return A.stops_in_areas(T.areas(spark, sf), T.area_stops(spark, sf)).select("community", "stop_id")


@query
def community_stops(spark, sf):
    inside = A.stops_in_areas(T.areas(spark, sf), T.area_stops(spark, sf))
    return A.community_stops(inside)


@query
def stops_of_one_community(spark, sf):
    inside = A.stops_in_areas(T.areas(spark, sf), T.area_stops(spark, sf))
    return A.community_stops(inside, "NATION_7")


@query
def area_counts_buffer(spark, sf):
    areas = T.areas(spark, sf)
    return A.area_counts(areas, geo.with_xy(T.area_stops(spark, sf)), A.project_rings(areas))


@query
def population_by_area(spark, sf):
    return A.population_by_area(T.areas(spark, sf), T.tracts(spark, sf))


@query
def tracts_meeting_areas(spark, sf):
    return overlay.intersecting(T.areas(spark, sf), T.tract_areas(spark, sf))


@query
def population_by_overlap(spark, sf):
    return overlay.population_by_overlap(T.areas(spark, sf), T.tract_areas(spark, sf))


@query
def dissolved_areas(spark, sf):
    """Corners of the unions of each region's areas, with the size of the ring they are on."""
    nation = T.table(spark, sf, "nation").select(F.col("n_name").alias("community"), F.col("n_regionkey").alias("region"))
    whole = overlay.dissolve(T.areas(spark, sf).join(nation, "community"), "region")
    rings = whole.select("region", F.explode("parts").alias("part")).select("region", F.posexplode("part").alias("n", "ring"))
    units = lambda c: F.round(F.col(f"corner.{c}") / overlay.SNAP_DEG).cast("long").alias(c)
    return rings.select("region", (F.col("n") > 0).alias("hole"), F.size("ring").alias("ring_size"), F.explode("ring").alias("corner")).select(
        "region", "hole", "ring_size", units("x"), units("y")
    )


@query
def stops_per_capita(spark, sf):
    return rounded(A.stops_per_capita(T.areas(spark, sf), T.area_stops(spark, sf), T.tracts(spark, sf)))


@query
def area_sizes(spark, sf):
    # Sizes of the areas beside the number of people the scan of all tracts puts there.
    areas = T.areas(spark, sf)
    sizes = A.area_sizes(A.project_rings(areas))
    return rounded(sizes.join(A.population_by_area(areas, T.tracts(spark, sf)), "community"), 1)


@query
def coverage_share(spark, sf):
    stops = geo.with_xy(T.area_stops(spark, sf))
    return rounded(A.coverage_share(A.project_rings(T.areas(spark, sf)), stops))


@query
def coverage_by_lines(spark, sf):
    stops = geo.with_xy(T.area_stops(spark, sf))
    return rounded(A.covered_area(A.project_rings(T.areas(spark, sf)), stops), 6, area_m2=1)


@query
def projected_both_ways(spark, sf):
    """Pings in another zone than the engine's own, and back from there."""
    zone = projection.utm(16)
    there = zone.project(T.pings(spark, sf).select("ping_id", "lat", "lon"))
    back = zone.unproject(there.select("ping_id", "x_m", "y_m"))
    return back.select(
        "ping_id", F.round("x_m", 3).alias("x_m"), F.round("y_m", 3).alias("y_m"),
        F.round("lat", 8).alias("lat"), F.round("lon", 8).alias("lon"),
    )


@query
def stored_headways(spark, sf):
    """Headways of visits stored by stop, which need no shuffle."""
    base = run_folder(spark)
    name = f"visits_{base.rsplit('/', 1)[-1]}"
    writers.write_by_stop(V.daytime(T.visits_actual(spark, sf)), f"{base}/visits", name)
    return V.headways_by_stop(spark.table(name)).select(
        "rt", "pid", "stop_id", "trip_id", F.col("stop_sequence").alias("event_id"), "time_till_next_bus"
    )


# --- reach -------------------------------------------------------------------


def _times(spark, sf):
    v = T.visits_actual(spark, sf)
    m = M.stop_metrics(v, "actual", periods=["year"])
    sequence = v.select("pid", "stop_id", F.col("stop_id").cast("int").alias("stop_sequence"))
    return reach.pattern_times(m, sequence, "2024")


@query
def reach_budgets(spark, sf):
    return rounded(reach.reach_budgets(_times(spark, sf)))


@query
def reach_minutes(spark, sf):
    origins = A.community_stops(A.stops_in_areas(T.areas(spark, sf), T.area_stops(spark, sf)))
    return rounded(reach.reach_minutes(_times(spark, sf), origins))


def _visit_points(spark, sf):
    """Pattern points for the patterns and stops of the visits."""
    n = F.col("stop_id").cast("int")
    return T.visits_actual(spark, sf).select("pid", "stop_id").distinct().select(
        "pid", n.alias("seq"), (n * 0.002 + 41.8).alias("lat"), (n * -0.001 - 87.6).alias("lon"),
        F.lit("S").alias("typ"), F.col("stop_id").alias("stpid"), F.col("stop_id").alias("stpnm"),
        (n * 700.0).alias("pdist"),
    )


@query
def reach_with_catalogue(spark, sf):
    """Routes come from the published schedule, NULL where it does not know the stop."""
    trips = T.gtfs_trips(spark, sf).withColumn("shape_id", F.concat(F.lit("0000"), F.col("service_id")))
    catalogue = P.stop_pattern_catalogue(trips, T.gtfs_stop_times(spark, sf))
    return rounded(reach.reach_budgets(_times(spark, sf), (15,), catalogue)).select("rt", "pid", "origin_stop", "last_stop", "route")


@query
def reach_segments(spark, sf):
    stops, legs = P.build_patterns(_visit_points(spark, sf))
    origins = A.community_stops(A.stops_in_areas(T.areas(spark, sf), T.area_stops(spark, sf)))
    out = reach.reach_segments(reach.reach_minutes(_times(spark, sf), origins), legs, stops)
    return rounded(out.select("rt", "pid", "origin_stop", "stop_id", "minutes", "length_ft"), 2)


@query
def reach_paths(spark, sf):
    pts = _visit_points(spark, sf)
    r = reach.reach_paths(reach.reach_budgets(_times(spark, sf)), pts)
    return r.select(
        "rt", "pid", "origin_stop", "minutes",
        # Every point of the path, as its place on the grid the stand-in lays stops on.
        F.array_join(
            F.transform(
                "path",
                lambda p: F.concat_ws(
                    "/", F.round((p["lat"] - 41.8) / 0.002).cast("int").cast("string"),
                    F.round((p["lon"] + 87.6) / -0.001).cast("int").cast("string"),
                ),
            ), ",",
        ).alias("path"),
    )


# --- quality and audits ------------------------------------------------------


def _qc_input(spark, sf):
    """Stop times out of visits, with some times missing, doubled and out of order."""
    v = T.visits_actual(spark, sf)
    e = F.col("stop_sequence")
    t = (
        F.when(e % 41 == 0, F.lit(None).cast("timestamp_ntz"))
        .when(e % 3 == 0, F.date_trunc("day", F.col("bus_stop_time")).cast("timestamp_ntz"))
        .otherwise(F.col("bus_stop_time"))
    )
    return v.select(
        "pid", F.col("trip_id").alias("unique_trip_vehicle_day"), F.lit("S").alias("typ"),
        e.cast("double").alias("seg_combined"), t.alias("bus_stop_time"),
        (e % 160).cast("double").alias("speed_mph"),
    )


@query
def qc_trips(spark, sf):
    return qc.trip_checks(_qc_input(spark, sf))


@query
def qc_summary(spark, sf):
    return qc.qc_summary(qc.trip_checks(_qc_input(spark, sf)))


@query
def qc_examples(spark, sf):
    return qc.qc_examples(qc.trip_checks(_qc_input(spark, sf))).withColumn("example", F.col("example").cast("long"))


@query
def qc_error_rate(spark, sf):
    return rounded(qc.qc_error_rate(qc.trip_checks(_qc_input(spark, sf))))


@query
def qc_stop_times(spark, sf):
    return qc.trip_checks(_stop_times(spark, sf), max_speed=K.MAX_SPEED_MPH - 40)


@query
def qc_actual_without_schedule(spark, sf):
    m = qc.qc_metrics(
        M.stop_metrics_both(T.visits_actual(spark, sf), T.visits_scheduled(spark, sf), periods=["year_hour"])
    )
    return m.select("rt", "pid", "stop_id", "period_value", "actual_nulls_not_in_schedule")


@query
def one_ping_share(spark, sf):
    return audit.one_ping_share(audit.pings_per_trip(_keyed(spark, sf)))


@query
def one_ping_by_pattern(spark, sf):
    return rounded(audit.one_ping_share_by_pattern(audit.pings_per_trip(_keyed(spark, sf))))


@query
def pings_per_pattern(spark, sf):
    stops = P.stops_per_pattern(T.pattern_points(spark, sf))
    return rounded(audit.pings_per_pattern(audit.pings_per_trip(_keyed(spark, sf)), stops))


@query
def ping_gap(spark, sf):
    return rounded(audit.ping_gaps(_keyed(spark, sf)))


@query
def ping_steps(spark, sf):
    return audit.step_gaps(_keyed(spark, sf)).select("ping_id", "gap_seconds")


@query
def missing_patterns(spark, sf):
    return P.missing_patterns(_keyed(spark, sf), T.known_patterns(spark, sf))


@query
def pattern_sets(spark, sf):
    trips = T.gtfs_trips(spark, sf)
    historic = trips.select(keys.bare_pid(keys.shape_pid("shape_id")).alias("pid")).distinct()
    return audit.pattern_sets(_keyed(spark, sf).select("pid").distinct(), T.known_patterns(spark, sf), historic)


@query
def pings_without_pattern(spark, sf):
    return audit.pings_without_pattern(_keyed(spark, sf), T.known_patterns(spark, sf)).select("ping_id", "pid")


@query
def trip_reconciliation(spark, sf):
    keyed = _keyed(spark, sf)
    kept = PG.clean_pings(keyed.join(T.known_patterns(spark, sf), "pid", "left_semi"))
    return audit.trip_reconciliation(keyed, kept)


@query
def losses_by_route(spark, sf):
    keyed = _keyed(spark, sf)
    kept = PG.clean_pings(keyed.join(T.known_patterns(spark, sf), "pid", "left_semi"))
    by_route = audit.losses_by_route(audit.trip_reconciliation(keyed, kept))
    return rounded(by_route.withColumn("pids", F.concat_ws(",", "pids")))


@query
def worst_routes(spark, sf):
    keyed = _keyed(spark, sf)
    kept = PG.clean_pings(keyed.join(T.known_patterns(spark, sf), "pid", "left_semi"))
    rec = audit.trip_reconciliation(keyed, kept)
    # Top-k report: the limit is the feature.
    return rec.orderBy(F.desc("missing_trips_errors"), "rt", "pid").limit(20)


@query
def run_stats(spark, sf):
    s = audit.run_stats(_qc_input(spark, sf))
    return s.withColumn("max_date", F.col("max_date").cast("string"))


@query
def rt_pid_xwalk(spark, sf):
    existing = T.visits_scheduled(spark, sf).select("rt", "pid")
    return audit.route_pattern_xwalk(_keyed(spark, sf), existing)


@query
def trips_per_pattern(spark, sf):
    return audit.value_counts(audit.pings_per_trip(_keyed(spark, sf)), "pid")


# --- sources, sinks, exports -------------------------------------------------


@query
def snapshot_explode(spark, sf):
    p, _ = PG.explode_snapshots(T.snapshots(spark, sf))
    return p.select(
        "vid", "tmstmp", "lat", "lon", "pid", "rt", "dly", "tatripid", "scrape_file",
        F.date_format("data_time", "yyyy-MM-dd HH:mm:ss").alias("data_time"),
        F.col("data_hour").cast("long").alias("data_hour"), F.col("data_date").cast("string").alias("data_date"),
    )


@query
def unreadable_snapshots(spark, sf):
    docs = T.snapshots(spark, sf)
    cut = F.when(F.col("scrape_file").endswith("77"), F.substring("value", 1, 40)).otherwise(F.col("value"))
    return PG.unreadable_snapshots(docs.withColumn("value", cut))


@query
def visits_on_day(spark, sf):
    v = T.visits_actual(spark, sf)
    return V.as_strings(v.filter(on_day("bus_stop_time", "2024-01-18")), keep=()).drop("bus_stop_time")


@query
def snapshot_errors(spark, sf):
    return PG.explode_snapshots(T.snapshots(spark, sf))[1]


@query
def points_json(spark, sf):
    j = exports.ping_points(T.pings(spark, sf))
    return j.select(
        F.col("id"), F.date_format("tmstmp", "yyyy-MM-dd HH:mm:ss").alias("tmstmp"), "delayed",
        F.round(F.col("position")[0], 6).alias("lat"), F.round(F.col("position")[1], 6).alias("lon"),
    )


@query
def trip_trace(spark, sf):
    v = T.visits_actual(spark, sf).select(
        "rt", "pid", F.col("stop_id").alias("stpid"), F.col("trip_id").alias("unique_trip_vehicle_day"), "bus_stop_time"
    )
    out = exports.trip_trace(_keyed(spark, sf), v)
    return out.withColumn("bus_stop_date", F.col("bus_stop_date").cast("string"))


@query
def append_merge(spark, sf):
    """A second batch of days, corrected, replaces the days it covers."""
    v = T.visits_actual(spark, sf).withColumn("day", F.to_date("bus_stop_time"))
    batch = T.visits_scheduled(spark, sf).withColumn("day", F.to_date("bus_stop_time")).filter("day >= '2024-01-16'")
    out = writers.append_merge(v, batch, ["day"])
    return out.groupBy(F.col("day").cast("string").alias("day"), "rt").agg(
        F.count(F.lit(1)).alias("rows"), F.countDistinct("trip_id").alias("trips"),
        F.max(F.col("pid")).alias("max_pid"),
    )


@query
def union_all_append(spark, sf):
    a, b = T.visits_actual(spark, sf), T.visits_scheduled(spark, sf)
    return writers.append_all(a, b).groupBy("rt", "pid").agg(F.count(F.lit(1)).alias("rows"))


@query
def split_by_pattern(spark, sf):
    s = writers.split_by_pattern(T.pings(spark, sf))
    day = writers.with_day(s)
    return day.groupBy("pid", F.col("day").cast("string").alias("day")).agg(F.count(F.lit(1)).alias("pings"))


@query
def missing_days(spark, sf):
    held = T.pings(spark, sf).select("data_date")
    wanted = readers.wanted_days(spark, "2023-12-25", "2024-02-03")
    return readers.missing_days(wanted, held).select(F.col("data_date").cast("string").alias("data_date"))


@query
def day_report(spark, sf):
    wanted = readers.wanted_days(spark, "2023-12-25", "2024-02-03")
    r = readers.day_report(wanted, T.pings(spark, sf))
    return r.withColumn("data_date", F.col("data_date").cast("string"))


@query
def high_water_mark(spark, sf):
    h = readers.high_water_mark(T.pings(spark, sf))
    return h.select(F.col("max_date").cast("string").alias("max_date"), F.col("next_date").cast("string").alias("next_date"))


@query
def incomplete_feeds(spark, sf):
    """Feeds (here: shapes of the schedule) against the tables they came with."""
    trips = T.gtfs_trips(spark, sf).select(F.col("shape_id").alias("feed_id"), F.lit("trips").alias("table"))
    shapes = T.gtfs_shapes(spark, sf).select(F.col("shape_id").alias("feed_id"), F.lit("shapes").alias("table"))
    out = readers.incomplete_feeds(trips.union(shapes), required=("shapes", "trips"))
    return out.withColumn("missing", F.concat_ws(",", "missing"))


@query
def streamed_hourly_pings(spark, sf):
    """The feed as a stream: pings per route and hour once all files are in."""
    return feed.replay_hourly(spark, T.table(spark, sf, "events"), T.snapshots_of)


# --- what is written comes back -----------------------------------------------


@query
def pings_csv(spark, sf):
    """Daily CSV files written and read with their declared schema."""
    path = f"{run_folder(spark)}/pings"
    p = T.pings(spark, sf).withColumn("data_date", F.col("data_date").cast("string"))
    have = [F.col(f.name) if f.name in p.columns else F.lit(None).cast(f.dataType).alias(f.name) for f in schemas.PINGS]
    writers.write_csv(p.select(*have), path)
    return readers.read_ping_days(spark, path).select(
        "vid", "tmstmp", "lat", "lon", F.col("pid").cast("long").alias("pid"), "rt", "dly", "tatripid", "data_date"
    )


@query
def pings_by_pattern(spark, sf):
    """Pings written as one partition per pattern, twice, and read back."""
    path = f"{run_folder(spark)}/patterns"
    rows = writers.split_by_pattern(T.pings(spark, sf)).select("pid", "ping_id", "vid")
    for _ in range(2):
        writers.write_partitioned(rows, path, ["pid"])
    return spark.read.parquet(path).select("ping_id", "vid", F.col("pid").cast("string").alias("pid"))


@query
def pulls_by_day(spark, sf):
    """Two pulls of the same days, the second one repeated."""
    path = f"{run_folder(spark)}/pulls"
    p = T.pings(spark, sf).select("ping_id", "data_time")
    for half, day in ((0, "2024-02-01"), (1, "2024-02-02"), (1, "2024-02-02")):
        writers.write_pull(p.filter(F.col("ping_id") % 2 == half), path, day)
    return spark.read.parquet(path).select(
        "ping_id", F.col("day").cast("string").alias("day"), F.col("pull_date").cast("string").alias("pull_date")
    )


@query
def published_versions(spark, sf):
    """The newest version of a table that was published twice."""
    path = f"{run_folder(spark)}/table"
    stops = T.area_stops(spark, sf)
    writers.publish(stops.withColumn("lon", F.lit(0.0)), path, "2024-01-01")
    writers.publish(stops, path, "2024-02-01")
    marks = writers.versions(spark, path).first()
    return writers.read_latest(spark, path).select(
        "stop_id", "lon", "lat", F.lit(marks["latest"]).alias("latest"), F.lit(marks["previous"]).alias("previous")
    )


@query
def gtfs_feeds(spark, sf):
    """Five extracted feeds with columns in different orders, read as one table."""
    root = run_folder(spark)
    trips = T.gtfs_trips(spark, sf)
    for n in range(5):
        cols = ["trip_id", "route_id", "shape_id", "service_id"] if n % 2 else ["shape_id", "service_id", "trip_id", "route_id"]
        writers.write_csv(trips.filter(F.col("service_id") == str(n)).select(*cols), f"{root}/feed{n}/trips.txt")
    return readers.read_gtfs(spark, root, "trips").select("feed_id", "trip_id", "route_id", "shape_id", "service_id", "schd_trip_id")


@query
def feed_catalogue(spark, sf):
    """Catalogues of feed versions as JSON documents, one for each order, with two versions each."""
    path = f"{run_folder(spark)}/catalogue"
    key = F.col("o_orderkey")

    def entry(name: str, days: F.Column) -> F.Column:
        start = F.date_format(F.date_add(F.lit("2022-01-01").cast("date"), days.cast("int")), "yyyy-MM-dd")
        return F.struct(
            F.concat(key.cast("string"), F.lit(name)).alias("sha1"), F.lit("2024-01-01T00:00:00Z").alias("fetched_at"),
            start.alias("earliest_calendar_date"),
        )

    versions = F.array(entry("a", key % 700), entry("b", key % 700 + 90))
    T.table(spark, sf, "orders").select(F.to_json(F.struct(versions.alias("feed_versions")))).write.text(path)
    return readers.read_feed_versions(spark, path, "2023-01-01", one_document=False).select("sha1", "earliest_calendar_date")


@query
def pattern_inventory(spark, sf):
    """Patterns held, out of the names of the files they were written to."""
    path = f"{run_folder(spark)}/patterns"
    writers.write_partitioned(writers.split_by_pattern(T.pings(spark, sf)).select("pid", "ping_id"), path, ["pid"])
    return readers.file_inventory(spark, path, folder="pid")


@query
def points_json_file(spark, sf):
    """Points written as JSON lines and read back."""
    path = f"{run_folder(spark)}/points"
    points = exports.ping_points(T.pings(spark, sf))
    writers.write_json(points, path)
    read = spark.read.schema(points.schema).json(path)
    return read.select(
        "id", F.date_format("tmstmp", "yyyy-MM-dd HH:mm:ss").alias("tmstmp"), "delayed",
        F.round(F.col("position")[0], 6).alias("lat"), F.round(F.col("position")[1], 6).alias("lon"),
    )


@query
def areas_geojson(spark, sf):
    """Boundaries of one or several parts as GeoJSON, read back, with their stops."""
    path = f"{run_folder(spark)}/areas"
    corners = F.transform("parts", lambda part: F.transform(part, lambda ring: F.transform(ring, lambda p: F.array(p["x"], p["y"]))))
    kind = F.when(F.size("parts") > 1, "MultiPolygon").otherwise("Polygon")
    text = F.when(F.size("parts") > 1, F.to_json(corners)).otherwise(F.to_json(F.get(corners, F.lit(0))))
    feature = F.concat(
        F.lit('{"type": "Feature", "properties": {"community": "'), F.col("community"), F.lit('"}, "geometry": {"type": "'),
        kind, F.lit('", "coordinates": '), text, F.lit("}}"),
    )
    # One boundary document: as many features as there are areas.
    doc = T.areas(spark, sf).agg(
        F.concat(F.lit('{"type": "FeatureCollection", "features": ['), F.array_join(F.collect_list(feature), ", "), F.lit("]}")).alias("value")
    )
    doc.write.text(path)
    read = readers.read_areas(spark, path)
    stops = A.stops_in_areas(read, T.area_stops(spark, sf)).select("community", "stop_id")
    return stops.join(read.select("community", F.size("parts").alias("parts")), "community")


@query
def stops_csv(spark, sf):
    path = f"{run_folder(spark)}/stops"
    writers.write_csv(T.area_stops(spark, sf).withColumnRenamed("stop_id", "SYSTEMSTOP"), path)
    return readers.read_stops(spark, path, "SYSTEMSTOP")


@query
def file_keys(spark, sf):
    """Pattern ids out of the names their files have."""
    names = F.concat(F.lit("/data/v2/pid_"), F.col("pid"), F.when(F.col("seq") % 2 == 0, "_stop.parquet").otherwise("_segment.parquet"))
    return T.pattern_points(spark, sf).select(readers.key_from_file_name(names).alias("pid"), "seq").withColumn(
        "seq", F.col("seq").cast("long")
    )


@query
def incremental_append(spark, sf):
    """Stop times added in two runs and a repeated one, by text dates in a form that ids do not hold."""
    path = f"{run_folder(spark)}/stop_times"
    keyed = _keyed(spark, sf).withColumn("data_date", F.date_format("data_date", "yyyyMMdd"))
    early = keyed.filter("data_date < '20240115'")
    points = T.pattern_points(spark, sf)
    append_stop_times(spark, early, points, path)
    append_stop_times(spark, new_days(keyed, spark.read.parquet(path)), points, path)
    append_stop_times(spark, early, points, path)
    st = spark.read.parquet(path)
    day = st.select("unique_trip_vehicle_day", "p_stp_id", F.col("service_date").cast("string").alias("service_date"), "bus_stop_time", "speed_mph")
    return rounded(day.withColumn("bus_stop_time", to_second("bus_stop_time")), 4)


@query
def incremental_metrics(spark, sf):
    """Metrics kept up to date by runs: first days, corrected and further days, and those again."""
    dated = lambda v: v.withColumn("service_date", F.to_date("bus_stop_time"))
    first, second = dated(T.visits_actual(spark, sf)), dated(T.visits_scheduled(spark, sf))
    day = F.col("service_date")
    corrected = second.filter(day >= "2024-01-16")
    store = MetricStore(spark, f"{run_folder(spark)}/metrics")
    for batch in (first.filter(day < "2024-01-20"), corrected, corrected):
        store.add(batch)
    return rounded(store.metrics(T.AS_OF))
