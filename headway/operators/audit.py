"""Audits of the raw data: pings per trip, gaps, missing patterns, lost trips, run figures."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window as W, functions as F

from headway.functions.clock import seconds_between
from headway.operators.pings import TRIP


def pings_per_trip(pings: DataFrame) -> DataFrame:
    return pings.groupBy("rt", *TRIP).agg(F.count(F.lit(1)).alias("pings"))


def one_ping_share(per_trip: DataFrame) -> DataFrame:
    """Trips, one-ping trips and their percentage overall."""
    return per_trip.agg(
        F.count(F.lit(1)).alias("total_trips"), F.count_if(F.col("pings") == 1).alias("single_row_trips")
    ).withColumn(
        "percentage_single_row_trips",
        F.round(F.try_divide(F.col("single_row_trips"), F.col("total_trips")) * 100, 3),
    )


def one_ping_share_by_pattern(per_trip: DataFrame) -> DataFrame:
    return per_trip.groupBy("rt", "pid").agg(
        F.count_if(F.col("pings") == 1).alias("single_row_trips"),
        (F.count_if(F.col("pings") == 1) / F.count(F.lit(1)) * 100).alias("percentage_single_row_trips"),
    )


def pings_per_pattern(per_trip: DataFrame, stops: DataFrame | None = None) -> DataFrame:
    """Trips and mean pings per trip of each pattern, with its stop count if given."""
    out = per_trip.groupBy("rt", "pid").agg(
        F.count(F.lit(1)).alias("count"), F.avg("pings").alias("mean")
    )
    return out if stops is None else out.join(stops, "pid", "left")


def ping_gaps(pings: DataFrame) -> DataFrame:
    """Mean seconds between pings per trip with two or more.

    The gaps of a trip add up to its span, so the mean needs no ordering.
    """
    n, span = F.col("__n"), seconds_between("__a", "__b")
    return (
        pings.groupBy(*TRIP)
        .agg(F.count(F.lit(1)).alias("__n"), F.min("data_time").alias("__a"), F.max("data_time").alias("__b"))
        .filter(n > 1)
        .select(*TRIP, (span / (n - 1)).alias("avg_time"))
    )


def step_gaps(pings: DataFrame) -> DataFrame:
    """Each ping's seconds since the one before it in its trip."""
    w = W.partitionBy(*TRIP).orderBy("data_time", "ping_id")
    return pings.select(
        *TRIP, "ping_id", "data_time",
        seconds_between(F.lag("data_time").over(w), F.col("data_time")).alias("gap_seconds"),
    )


def pattern_sets(seen: DataFrame, current: DataFrame, historic: DataFrame) -> DataFrame:
    """Every pattern id with where it occurs (the set algebra of the audit as flags)."""
    tagged = (
        seen.select("pid", F.lit("seen").alias("s"))
        .unionByName(current.select("pid", F.lit("current").alias("s")))
        .unionByName(historic.select("pid", F.lit("historic").alias("s")))
    )
    return tagged.groupBy("pid").agg(
        F.max(F.col("s") == "seen").alias("seen"),
        F.max(F.col("s") == "current").alias("current"),
        F.max(F.col("s") == "historic").alias("historic"),
    )


def pings_without_pattern(pings: DataFrame, patterns: DataFrame) -> DataFrame:
    return pings.join(patterns.select("pid").distinct(), "pid", "left_anti")


def trip_reconciliation(raw: DataFrame, processed: DataFrame) -> DataFrame:
    """Raw trips per (route, pattern) beside processed ones; a loss is blamed on the
    missing pattern when none came through, on errors otherwise."""
    before = raw.groupBy("rt", "pid").agg(F.countDistinct("unique_trip_vehicle_day").alias("og_trips"))
    after = processed.groupBy("rt", "pid").agg(F.countDistinct("unique_trip_vehicle_day").alias("actual_trips"))
    lost = F.col("og_trips") - F.col("actual_trips")
    zero = F.lit(0).cast("long")
    return (
        before.join(after, ["rt", "pid"], "left")
        .na.fill(0, ["actual_trips"])
        .withColumn("missing_trips_errors", F.when(F.col("actual_trips") != 0, lost).otherwise(zero))
        .withColumn("missing_trips_missing_pids", F.when(F.col("actual_trips") == 0, lost).otherwise(zero))
    )


def losses_by_route(reconciliation: DataFrame) -> DataFrame:
    sums = reconciliation.groupBy("rt").agg(
        *[F.sum(c).alias(c) for c in ("missing_trips_errors", "missing_trips_missing_pids", "og_trips", "actual_trips")],
        F.array_sort(F.collect_set("pid")).alias("pids"),
    )
    share = lambda c: F.try_divide(F.col(c), F.col("og_trips")) * 100
    return sums.withColumn("missing_pid_percent", share("missing_trips_missing_pids")).withColumn(
        "error_percent", share("missing_trips_errors")
    )


def run_stats(stop_times: DataFrame) -> DataFrame:
    """Rows, trips, patterns, days and last day in one row.

    Rows are reduced to (trip, pattern, day) first, so the distinct counts work on a fraction.
    """
    small = stop_times.groupBy(
        "unique_trip_vehicle_day", "pid", F.to_date("bus_stop_time").alias("day")
    ).agg(F.count(F.lit(1)).alias("n"))
    return small.agg(
        F.sum("n").alias("total_rows"),
        F.countDistinct("unique_trip_vehicle_day").alias("total_trips"),
        F.countDistinct("pid").alias("total_pids"),
        F.countDistinct("day").alias("total_days"),
        F.max("day").alias("max_date"),
    )


def value_counts(df: DataFrame, column: str) -> DataFrame:
    return df.groupBy(column).agg(F.count(F.lit(1)).alias("count"))


def route_pattern_xwalk(pings: DataFrame, existing: DataFrame | None = None) -> DataFrame:
    """Distinct (rt, pid), joined with those known before."""
    new = pings.select("rt", "pid").distinct()
    return new if existing is None else existing.select("rt", "pid").union(new).distinct()
