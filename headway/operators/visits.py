"""Stop visits: headways, segment times, cumulative times, reused trip ids."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window as W, functions as F

from headway.constants import DAY_FIRST_HOUR, DAY_LAST_HOUR
from headway.functions.clock import is_daytime, seconds_between
from headway.functions.keys import normal_pid
from headway.operators.ordered import (
    bucketed_next, bucketed_previous, bucketed_row_number, bucketed_running_sum,
)
from headway.operators.schedule import on_days
from headway.session import staged


def as_strings(df: DataFrame, keep: tuple[str, ...] = ("bus_stop_time",)) -> DataFrame:
    """Everything but the kept columns as text, for tables whose id types differ between versions."""
    return df.select(*[F.col(c) if c in keep else F.col(c).cast("string").alias(c) for c in df.columns])


def actual_visits(stop_times: DataFrame) -> DataFrame:
    """Estimated stop times as visits: names, id types and pattern ids made uniform."""
    return stop_times.drop("stop_dist").select(
        F.col("rt").cast("string").alias("rt"),
        normal_pid("pid").alias("pid"),
        F.col("stpid").cast("string").alias("stop_id"),
        F.col("unique_trip_vehicle_day").cast("string").alias("trip_id"),
        F.col("stop_sequence").cast("int").alias("stop_sequence"),
        F.col("bus_stop_time").cast("timestamp_ntz").alias("bus_stop_time"),
    )


def scheduled_visits(timetable: DataFrame, bucket: str = "month") -> DataFrame:
    """Clean timetable as visits: rows without a time dropped, reused trip ids split.

    A packed timetable is made uniform before its days are unpacked, and staged, as splitting reads it twice. Rows are dropped
    behind that: a filter on the clock would be pushed below and read it a second time.
    """
    packed = "dates" in timetable.columns
    time = ["dates", "clock"] if packed else [F.col("bus_stop_time").cast("timestamp_ntz").alias("bus_stop_time")]
    timed = timetable if packed else timetable.filter(F.col("bus_stop_time").isNotNull())
    rows = timed.select(
        F.col("route_id").cast("string").alias("rt"),
        normal_pid("pid").alias("pid"),
        F.col("stop_id").cast("string").alias("stop_id"),
        F.col("schd_trip_id").cast("string").alias("schd_trip_id"),
        F.col("stop_sequence").try_cast("double").cast("int").alias("stop_sequence"),
        *time,
    )
    if packed:
        rows = on_days(staged(rows).filter(F.col("clock").isNotNull()))
    tie = ("stop_sequence", "stop_id", "pid")
    return split_reused_trips(rows, keys=("rt", "schd_trip_id"), bucket=bucket, tie=tie).drop("schd_trip_id")


def split_reused_trips(
    timetable: DataFrame,
    keys: tuple[str, ...] = ("rt", "schd_trip_id"),
    bucket: str = "month",
    tie: tuple[str, ...] = ("stop_sequence", "stop_id"),
) -> DataFrame:
    """Give each run of a reused scheduled id its own ``trip_id``.

    Rows are numbered by time within the id; every ``max(stop_sequence)`` rows a
    new run starts and its ordinal is appended to the id.
    """
    numbered = bucketed_row_number(
        timetable, keys, "bus_stop_time", tie, "__rn", bucket, {"__stops": "stop_sequence"}
    )
    run = F.floor((F.col("__rn") - 1) / F.col("__stops")).cast("string")
    return numbered.withColumn(
        "trip_id", F.concat_ws("-", F.col(keys[-1]).cast("string"), run)
    ).drop("__rn", "__stops")


def daytime(visits: DataFrame, first: int = DAY_FIRST_HOUR, last: int = DAY_LAST_HOUR) -> DataFrame:
    return visits.filter(is_daytime("bus_stop_time", first, last))


def headways(visits: DataFrame, bucket: str = "day", within_day: bool = False) -> DataFrame:
    """Seconds until the next bus at the same stop of the same route.

    By default the last headway of a day reaches to the next day's first bus;
    ``within_day`` leaves it NULL.
    """
    out = bucketed_next(visits, ("rt", "stop_id"), "bus_stop_time", ("trip_id", "pid", "stop_sequence"), "__due", bucket)
    gap = seconds_between("bus_stop_time", "__due")
    if within_day:
        same = F.to_date("__due") == F.to_date("bus_stop_time")
        gap = F.when(same, gap)
    return out.withColumn("time_till_next_bus", gap).drop("__due")


def headways_by_stop(visits: DataFrame) -> DataFrame:
    """``headways`` for visits that are stored by stop: one window per (rt, stop_id), which such a table needs no shuffle for.

    For tables that are not, ``headways`` cuts a busy stop by day; here it is one task, as it is one bucket.
    """
    order = W.partitionBy("rt", "stop_id").orderBy("bus_stop_time", "trip_id", "pid", "stop_sequence")
    due = F.lead("bus_stop_time").over(order)
    return visits.withColumn("time_till_next_bus", seconds_between("bus_stop_time", due))


def segment_times(visits: DataFrame, bucket: str | None = None) -> DataFrame:
    """Seconds from the previous stop of the trip (0 at the first) and their running sum.

    A trip is one vehicle on one service day, so its window is small by nature.
    Where trip ids are unreliable, ``bucket`` ("hour", "day") cuts long trips.
    """
    keys, time, tie = ("rt", "trip_id"), "bus_stop_time", ("stop_sequence", "stop_id", "pid")
    gap = lambda before: F.coalesce(seconds_between(before, time), F.lit(0)).cast("long")
    if bucket is not None:
        timed = bucketed_previous(visits, keys, time, tie, "__before", bucket)
        timed = timed.withColumn("time_to_previous_stop", gap("__before")).drop("__before")
        return bucketed_running_sum(
            timed, keys, time, tie, "time_to_previous_stop", "cum_trip_time", bucket
        )
    w = W.partitionBy(*keys).orderBy(time, *tie)
    return visits.withColumn("time_to_previous_stop", gap(F.lag(time).over(w))).withColumn(
        "cum_trip_time", F.sum("time_to_previous_stop").over(w.rowsBetween(W.unboundedPreceding, 0))
    )


def stop_event_metrics(visits: DataFrame, is_daytime: bool = True, bucket: str = "day") -> DataFrame:
    """Daytime visits with headway, segment and cumulative time and date parts."""
    base = daytime(visits) if is_daytime else visits
    t = F.col("bus_stop_time")
    return (
        segment_times(headways(base, bucket))
        .withColumn("hour", F.hour(t))
        .withColumn("month", F.month(t))
        .withColumn("year", F.year(t))
        .withColumn("day", F.day(t))
    )
