"""Published timetables: service days, expansion, clock times, feed versions."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window as W, functions as F

from headway.functions.clock import after, clock_seconds, parse_service_date, service_time
from headway.functions.keys import shape_pid

_WEEKDAYS = ("monday", "tuesday", "wednesday", "thursday", "friday", "saturday", "sunday")

TIMETABLE = (
    "route_id", "pid", "schd_trip_id", "stop_id", "stop_sequence", "date", "arrival_time",
    "departure_time", "service_id", "trip_id",
)


def service_days(calendar: DataFrame, calendar_dates: DataFrame) -> DataFrame:
    """``(service_id, date)`` for each day a service runs.

    Days of the weekly pattern, plus added dates (type 1), minus removed dates (type 2).
    """
    runs = F.array(*[F.col(d).cast("int") for d in _WEEKDAYS])
    weekly = (
        calendar.select(
            "service_id",
            runs.alias("__runs"),
            F.explode(
                F.sequence(parse_service_date("start_date"), parse_service_date("end_date"))
            ).alias("date"),
        )
        .filter(F.element_at("__runs", F.weekday("date") + 1) == 1)
        .select("service_id", "date")
    )
    dates = calendar_dates.select(
        "service_id", parse_service_date("date").alias("date"),
        F.col("exception_type").cast("int").alias("__type"),
    )
    added = dates.filter(F.col("__type") == 1).drop("__type")
    removed = dates.filter(F.col("__type") == 2).drop("__type")
    return weekly.union(added).join(removed, ["service_id", "date"], "left_anti").distinct()


def trip_days(trips: DataFrame, days: DataFrame) -> DataFrame:
    """Trips with the array of dates they run on; trips that never run are left out.

    A service's dates are bounded by its calendar, and the array rides along with
    the trip until the stop times are joined: rows multiply last, without a shuffle.
    """
    per_service = days.groupBy("service_id").agg(F.array_sort(F.collect_set("date")).alias("dates"))
    return trips.join(per_service, "service_id")


def active_trips(trips: DataFrame, days: DataFrame) -> DataFrame:
    """``(trip_id, ..., date)`` one row per trip and active date."""
    with_days = trip_days(trips, days)
    return with_days.select(*trips.columns, F.explode("dates").alias("date"))


def trips_on(trips: DataFrame, days: DataFrame, date: str) -> DataFrame:
    """Trips active on one date."""
    on = days.filter(F.col("date") == F.lit(date).cast("date")).select("service_id")
    return trips.join(on, "service_id", "left_semi")


def named_routes(routes: DataFrame) -> DataFrame:
    return routes.filter(F.col("route_short_name").isNotNull())


def expand_schedule(
    trips: DataFrame, stop_times: DataFrame, calendar: DataFrame, calendar_dates: DataFrame,
    routes: DataFrame | None = None, sha1: str | None = None, fetched_date: str | None = None, packed: bool = False,
) -> DataFrame:
    """Dated stop times (``timetable_raw``) of one feed.

    ``packed``: one row a stop time, with the array ``dates`` of its days in place of ``date``, for operators that do their
    work before rows multiply.
    """
    kept = trips if routes is None else trips.join(named_routes(routes).select("route_id"), "route_id", "left_semi")
    dated = trip_days(kept, service_days(calendar, calendar_dates))
    rows = (
        stop_times.select("trip_id", "stop_id", "stop_sequence", "arrival_time", "departure_time")
        .join(dated, "trip_id")
        .withColumn("pid", shape_pid("shape_id"))
    )
    if not packed:
        rows = rows.withColumn("date", F.explode("dates"))
    return rows.select(
        *["dates" if packed and c == "date" else c for c in TIMETABLE], F.lit(sha1).cast("string").alias("sha1"),
        F.lit(fetched_date).cast("string").alias("fetched_date"),
    )


def on_days(timetable: DataFrame) -> DataFrame:
    """Rows with ``dates`` and ``clock`` (seconds) to one row a day with its ``bus_stop_time``."""
    rows = timetable.withColumn("__date", F.explode("dates"))
    return rows.withColumn("bus_stop_time", after(F.col("__date"), F.col("clock"))).drop("dates", "clock", "__date")


def clean_schedule(timetable: DataFrame, strict_reference: bool = False, packed: bool = False) -> DataFrame:
    """``timetable_clean``: one timestamp in place of the date and clock texts.

    A packed timetable's clocks are read once a row, before its days are unpacked; ``packed`` leaves them so, as ``dates`` and
    ``clock``.
    """
    if "dates" in timetable.columns and not strict_reference:
        rows = timetable.select(
            "route_id", "pid", "schd_trip_id", "stop_id",
            F.col("stop_sequence").cast("string").alias("stop_sequence"), "service_id", "trip_id", "dates",
            clock_seconds("arrival_time").alias("clock"),
        )
        return rows if packed else on_days(rows)
    if packed:
        raise ValueError("a packed result needs a packed timetable and the full clock")
    if "dates" in timetable.columns:
        timetable = timetable.withColumn("date", F.explode("dates"))
    day = F.col("date") if dict(timetable.dtypes)["date"] == "date" else parse_service_date("date")
    return timetable.select(
        "route_id", "pid", "schd_trip_id", "stop_id",
        F.col("stop_sequence").cast("string").alias("stop_sequence"), "service_id", "trip_id",
        service_time(day, "arrival_time", strict_reference).alias("bus_stop_time"),
    )


def merge_schedule(current_raw: DataFrame, historic: DataFrame, strict_reference: bool = False) -> DataFrame:
    """Clean current timetable plus what the history holds before the current one begins, per route.

    Routes without a current timetable are left out, as only current routes are rewritten.
    """
    day = F.col("date") if dict(current_raw.dtypes)["date"] == "date" else parse_service_date("date")
    starts = current_raw.groupBy("route_id").agg(F.min(day).alias("__from"))
    older = historic.join(starts, "route_id").filter(
        F.col("bus_stop_time") < F.col("__from").cast("timestamp_ntz")
    )
    return clean_schedule(current_raw, strict_reference).unionByName(older.drop("__from"))


def feed_windows(timetables: DataFrame) -> DataFrame:
    """``(route_id, sha1, valid_to)``: a feed is in force until the next fetched one begins.

    The newest feed has no end.
    """
    begins = timetables.groupBy("route_id", "sha1", "fetched_date").agg(
        F.min(parse_service_date("date")).alias("min_date")
    )
    newest_first = W.partitionBy("route_id").orderBy(F.desc("fetched_date"), F.desc("sha1"))
    return begins.select(
        "route_id", "sha1", "min_date", F.lag("min_date").over(newest_first).alias("valid_to")
    )


def dedupe_feed_versions(timetables: DataFrame) -> DataFrame:
    """Keep a feed's rows only while that feed was in force.

    The windows are one row per (route, feed), so the interval test rides on an equi-join.
    """
    windows = feed_windows(timetables).select("route_id", "sha1", "valid_to")
    in_force = F.col("valid_to").isNull() | (parse_service_date("date") < F.col("valid_to"))
    return timetables.join(windows, ["route_id", "sha1"]).filter(in_force).drop("valid_to")


def schedule_state(timetable: DataFrame) -> DataFrame:
    """Rows, days and last day of a clean timetable."""
    by_day = timetable.groupBy(F.to_date("bus_stop_time").alias("d")).agg(F.count(F.lit(1)).alias("n"))
    return by_day.agg(
        F.sum("n").alias("total_rows"), F.count("d").alias("total_days"), F.max("d").alias("max_day")
    )
