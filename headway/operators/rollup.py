"""From stop and trip metrics to routes and areas."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from headway.functions.clock import floor_to
from headway.functions.measures import wait_minutes
from headway.operators.ordered import first_per_group
from headway.operators.ranks import group_medians, weighted_median
from headway.operators.visits import segment_times

STOP_COLUMNS = (
    "median_actual_time_till_next_bus", "std_actual_time_till_next_bus", "time_till_next_bus_delay",
    "median_schedule_time_till_next_bus", "std_schedule_time_till_next_bus",
    "median_schedule_num_buses", "median_actual_num_buses",
)
TRIP_COLUMNS = ("median_actual_trip_duration", "median_schedule_trip_duration")


def without_routes(df: DataFrame, routes: Sequence[str]) -> DataFrame:
    return df.filter(~F.col("rt").isin(*routes)) if routes else df


def weighted_median_by(
    metrics: DataFrame, group: str, period: str, metric: str, weight: str,
    drop_periods: Sequence[str] = (),
) -> DataFrame:
    """Median of a metric in minutes per (period_value, group), each row weighing its count."""
    rows = metrics.filter(F.col("period") == period)
    if drop_periods:
        rows = rows.filter(~F.col("period_value").isin(*drop_periods))
    out = weighted_median(rows, ["period_value", group], metric, weight, "__median")
    return out.select("period_value", group, (F.col("__median") / 60).alias("median_minutes"))


def _scope(df: DataFrame, group: str, period: str | int) -> tuple[DataFrame, list[str]]:
    if period == "one_value":
        return df.filter(F.col("period") == "dayofyear"), [group]
    if isinstance(period, int):
        return df.filter((F.col("period") == "year") & (F.col("period_value") == str(period))), [group]
    return df.filter(F.col("period") == period), [group, "period_value"]


def medians_by(df: DataFrame, group: str, period: str | int, columns: Sequence[str]) -> DataFrame:
    """Plain medians over the rows of a group; times come out in minutes.

    ``period`` is a period name, ``"one_value"`` (all days of the year together)
    or a year.
    """
    rows, keys = _scope(df, group, period)
    present = [c for c in columns if c in df.columns]
    out = group_medians(rows, keys, present)
    minutes = [
        F.col(c) if "num_buses" in c else (F.col(c) / 60).alias(c) for c in present
    ]
    return out.select(*keys, *minutes)


def summary_by(
    stops: DataFrame, trips: DataFrame | None, group: str, period: str | int,
    stop_columns: Sequence[str] = STOP_COLUMNS, trip_columns: Sequence[str] = TRIP_COLUMNS,
) -> DataFrame:
    """Stop medians with the excess of buses; for routes also trip durations and their delay."""
    excess = F.col("median_actual_num_buses") - F.col("median_schedule_num_buses")
    out = medians_by(stops, group, period, stop_columns).withColumn("bus_excess", excess)
    if trips is None:
        return out
    late = F.col("median_actual_trip_duration") - F.col("median_schedule_trip_duration")
    durations = medians_by(trips, group, period, trip_columns).withColumn("trip_delay", late)
    _, keys = _scope(stops, group, period)
    return out.join(durations, keys, "left")


def buses_per_hour(visits: DataFrame, keys: Sequence[str] = ("rt", "pid", "stop_id")) -> DataFrame:
    """Visits per clock hour and stop, and the wait an evenly spaced service would give."""
    return (
        visits.groupBy(*keys, floor_to("hour", "bus_stop_time").alias("hour"))
        .agg(F.count(F.lit(1)).alias("bus_per_hour"))
        .withColumn("wait_time_minutes", wait_minutes("bus_per_hour"))
        .withColumn("year", F.year("hour"))
        .withColumn("month", F.month("hour"))
    )


def average_service(frame: DataFrame, *by: str | Column) -> DataFrame:
    """Mean buses per hour and mean wait by any grouping (stop and route, day, month, ...)."""
    return frame.groupBy(*by).agg(
        F.avg("bus_per_hour").alias("avg_bus_per_hour"),
        F.avg("wait_time_minutes").alias("avg_wait_time_minutes"),
    )


def area_service(stop_service: DataFrame, stop_areas: DataFrame) -> DataFrame:
    """Stop-level averages rolled up to areas: summed and averaged buses, averaged wait."""
    return (
        stop_areas.select("community", "stop_id")
        .join(stop_service, "stop_id")
        .groupBy("community")
        .agg(
            F.sum("avg_bus_per_hour").alias("sum_bus_per_hour"),
            F.avg("avg_bus_per_hour").alias("avg_bus_per_hour"),
            F.avg("avg_wait_time_minutes").alias("avg_wait_time_minutes"),
        )
    )


def busiest_pattern(visits: DataFrame) -> DataFrame:
    """The pattern with most distinct trips of each route, the lowest id on ties."""
    trips = visits.groupBy("rt", "pid").agg(F.countDistinct("trip_id").alias("trips"))
    return first_per_group(trips, ["rt"], [-F.col("trips"), F.col("pid")])


def sample_trips(trips: DataFrame, n: int, seed: int = 0, key: str = "trip_id", by: Sequence[str] = ("rt",)) -> DataFrame:
    """``n`` trips of each group in a pseudo-random order fixed by the seed (a sampling operator: the limit is the point).

    The order is that of a checksum of trip and seed. Ranks over ``n`` are dropped before the shuffle.
    """
    order = W.partitionBy(*by).orderBy(F.md5(F.concat_ws(":", F.col(key).cast("string"), F.lit(str(seed))).cast("binary")), key)
    return (
        trips.select(*by, key).distinct().withColumn("__rank", F.row_number().over(order))
        .filter(F.col("__rank") <= n).drop("__rank")
    )


def trip_profiles(visits: DataFrame, n: int | None = None, seed: int = 0) -> DataFrame:
    """Cumulative time along the trips of each route's busiest pattern, all or ``n`` sampled ones per route."""
    top = busiest_pattern(visits).select("rt", "pid")
    rows = visits.join(top, ["rt", "pid"], "left_semi")
    if n is not None:
        rows = rows.join(sample_trips(rows, n, seed), ["rt", "trip_id"], "left_semi")
    return segment_times(rows)


def median_profile(metrics: DataFrame, period_value: str) -> DataFrame:
    """Median cumulative times of a year, per stop: the curves trips are compared with."""
    return metrics.filter((F.col("period") == "year") & (F.col("period_value") == period_value)).select(
        "rt", "pid", "stop_id", "median_actual_cum_trip_time", "median_schedule_cum_trip_time"
    )
