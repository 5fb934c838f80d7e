"""Stop times between pings, and the report of what could not be timed."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window as W, functions as F

from headway import constants as K
from headway.functions import geo
from headway.functions.clock import add_seconds, exact_seconds_between
from headway.functions.measures import plausible_speed, plausible_step, speed_mph
from headway.operators.pings import TRIP
from headway.session import dealt


def trip_rows(matched: DataFrame, stops: DataFrame) -> DataFrame:
    """Placed pings (typ B) and all points of the pattern (S and W) of each trip with two or more.

    A trip's placed pings sit on different legs, so they are no more than its
    pattern has legs. They and the pattern's points travel as arrays and are
    unpacked behind the shuffle: one row per trip is moved, not one per stop.
    Joined rows are dealt by trip before they are unpacked. Without that the windows
    that follow would sit on the partitions of the join, where one pattern is one task.
    Trips are sorted while they are one row each, and their rows in the array: the windows'
    own sort of all rows then finds them in order.
    """
    none = F.lit(None)
    row = lambda at, typ, stpid, p_stp_id, time: F.struct(
        at.cast("double").alias("seg_combined"), typ.alias("typ"), stpid.cast("string").alias("stpid"),
        p_stp_id.cast("string").alias("p_stp_id"), F.col("x_m"), F.col("y_m"),
        time.cast("timestamp_ntz").alias("data_time"),
    )
    ping = row(F.col("seg_combined"), F.lit("B"), none, none, F.col("data_time"))
    point = row(F.col("segment"), F.col("typ"), F.col("stpid"), F.col("p_stp_id"), none)
    day = ["data_date"] if "data_date" in matched.columns else []
    trips = matched.groupBy(*TRIP).agg(
        F.min("rt").alias("rt"), F.min("vid").alias("vid"), *[F.min(c).alias(c) for c in day],
        F.collect_list(ping).alias("__pings"),
    )
    patterns = stops.groupBy("pid").agg(F.collect_list(point).alias("__points"))
    return (
        dealt(trips.filter(F.size("__pings") > 1).join(patterns, "pid"), *TRIP)
        .sortWithinPartitions(*TRIP)
        .select(*TRIP, "rt", "vid", *day, F.inline(F.array_sort(F.concat("__pings", "__points"))))
    )


def interpolate_stop_times(matched: DataFrame, stops: DataFrame, anchor: str = "next") -> DataFrame:
    """One row per trip and stop with its estimated time, and the trip's ``data_date`` where pings have one.

    Between two pings time is shared out by distance. ``anchor="next"`` counts
    the distance up to the following row, as the published method does;
    ``"self"`` counts up to the stop itself. Stops before the first or after the
    last ping are reached by chaining step times at the nearest known speed.

    All figures are differences of running sums along the trip, so the whole
    computation is three sorts (forth, back, forth) of rows that are dealt by trip once.
    """
    if anchor not in ("next", "self"):
        raise ValueError(f"anchor must be 'next' or 'self', not {anchor!r}")
    forth = W.partitionBy(*TRIP).orderBy("seg_combined")
    back = W.partitionBy(*TRIP).orderBy(F.desc("seg_combined"))
    first, last = W.unboundedPreceding, W.unboundedFollowing
    here, past, whole = forth.rowsBetween(first, 0), forth.rowsBetween(first, -1), forth.rowsBetween(first, last)
    coming, here_back = back.rowsBetween(first, -1), back.rowsBetween(first, 0)
    is_ping, is_stop = F.col("typ") == "B", F.col("typ") == "S"
    at_ping = lambda c: F.when(is_ping, F.col(c))
    latest = lambda c, frame: F.last(c, ignorenulls=True).over(frame)

    rows = trip_rows(matched, stops).withColumns({
        "__x": F.lead("x_m").over(forth), "__y": F.lead("y_m").over(forth),
        "ping_no": F.sum(is_ping.cast("int")).over(here),
        "stop_sequence": F.sum(is_stop.cast("int")).over(here),
    })
    rows = rows.withColumn("__next", F.coalesce(geo.distance("x_m", "y_m", "__x", "__y"), F.lit(0.0)))
    # Distance from the start of the pattern, and of the whole of it.
    rows = rows.withColumns({
        "__at": F.coalesce(F.sum("__next").over(past), F.lit(0.0)), "__length": F.sum("__next").over(whole),
    })
    rows = rows.withColumns({
        "__from_at": latest(at_ping("__at"), here), "__from": latest(at_ping("data_time"), here),
        "__pings": F.max("ping_no").over(whole), "__start": F.min("data_time").over(whole),
    })
    rows = rows.withColumns({
        "__to_at": latest(at_ping("__at"), coming), "__to": latest(at_ping("data_time"), coming),
        "__stop_at": latest(F.when(is_stop, F.col("__at")), coming),
    })
    # Between two pings; before the first and after the last the gap is zero.
    rows = rows.filter(is_ping | is_stop).withColumns({
        "__gap": F.coalesce(exact_seconds_between("__from", "__to"), F.lit(0.0)),
        "__span": F.coalesce("__to_at", "__length") - F.coalesce("__from_at", F.lit(0.0)),
        "__done": F.col("__at") + (F.col("__next") if anchor == "next" else F.lit(0.0)) - F.col("__from_at"),
        "__step": F.when(is_stop, plausible_step(F.coalesce("__stop_at", "__length") - F.col("__at"))),
    })
    rows = rows.withColumn("__speed", F.when(is_stop, plausible_speed(speed_mph("__span", "__gap"))))
    rows = rows.withColumn("__speed_back", latest("__speed", here_back))
    rows = rows.withColumns({
        "speed_mph": F.coalesce(latest("__speed", here), F.col("__speed_back")),
        "__step": latest("__step", here),
    })
    # Seconds of each stop's own step, and running sums to chain them.
    rows = rows.withColumn(
        "__td", F.when(is_stop, F.col("__step") / (F.col("speed_mph") / K.MPH_PER_MPS))
    )
    unknown = (is_stop & F.col("__td").isNull()).cast("int")
    rows = rows.withColumns({
        "__sum": F.sum(F.coalesce("__td", F.lit(0.0))).over(here), "__unknown": F.sum(unknown).over(here),
    })
    at_first = lambda c: F.max(F.when(is_ping & (F.col("ping_no") == 1), F.col(c))).over(whole)
    at_last = lambda c: F.max(F.when(is_ping & (F.col("ping_no") == F.col("__pings")), F.col(c))).over(whole)
    rows = rows.withColumns({
        "__sum_1": at_first("__sum"), "__unknown_1": at_first("__unknown"),
        "__sum_n": at_last("__sum"), "__unknown_n": at_last("__unknown"),
    })
    # A step without a time leaves every stop beyond it without one.
    lead_in = F.when(
        F.col("__unknown_1") - F.col("__unknown") + unknown == 0,
        F.col("__sum_1") - F.col("__sum") + F.col("__td"),
    )
    run_out = F.when(F.col("__unknown") == F.col("__unknown_n"), F.col("__sum") - F.col("__sum_n"))
    share = F.col("__done") / F.nullif(F.col("__span"), F.lit(0.0))
    time = (
        F.when(F.col("ping_no") == 0, add_seconds("__start", -lead_in))
        .when(F.col("ping_no") == F.col("__pings"), add_seconds("__from", run_out))
        .otherwise(add_seconds("__from", F.col("__gap") * share))
    )
    day = ["data_date"] if "data_date" in rows.columns else []
    return rows.filter(is_stop).select(
        *day, "unique_trip_vehicle_day", "rt", "pid", F.col("vid").cast("string").alias("vid"), "stpid",
        "p_stp_id", "seg_combined", "typ", F.col("stop_sequence").cast("int").alias("stop_sequence"),
        time.alias("bus_stop_time"), "speed_mph",
    )


def reject_report(pings: DataFrame, status: DataFrame) -> DataFrame:
    """Per pattern: trips seen, kept by cleaning, timed, and lost by reason."""
    seen = pings.groupBy("pid").agg(F.countDistinct("unique_trip_vehicle_day").alias("original_trips"))
    outcome = status.groupBy("pid").agg(
        F.count(F.lit(1)).alias("kept_trips"),
        F.count_if(F.col("status") == "ok").alias("processed_trips"),
        F.count_if(F.col("status") == "one_match").alias("one_match_trips"),
        F.count_if(F.col("status") == "no_match").alias("no_match_trips"),
    )
    return seen.join(outcome, "pid", "left").na.fill(0)


def rejects(status: DataFrame) -> DataFrame:
    """Trips that could not be timed, with the reason."""
    return status.filter(F.col("status") != "ok").select(*TRIP, F.col("status").alias("reason"))
