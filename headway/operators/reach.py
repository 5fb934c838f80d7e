"""How far a rider gets from a stop."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from headway.constants import REACH_BUDGETS_MIN
from headway.functions.measures import budget_label, budget_rank
from headway.operators.ordered import fill_forward, first_per_group


def pattern_times(metrics: DataFrame, sequence: DataFrame, period_value: str) -> DataFrame:
    """Stops of each pattern in order with the elapsed seconds from its first stop.

    ``metrics`` are actual stop metrics, ``sequence`` gives (pid, stop_id,
    stop_sequence). Stops without a measured time are left out.
    """
    year = metrics.filter((F.col("period") == "year") & (F.col("period_value") == period_value))
    order = W.partitionBy("rt", "pid").orderBy("stop_sequence", "stop_id")
    return (
        year.select("rt", "pid", "stop_id", F.col("median_actual_time_to_previous_stop").alias("time_to_previous"))
        .filter(F.col("time_to_previous").isNotNull())
        .join(sequence.select("pid", "stop_id", F.col("stop_sequence").cast("int").alias("stop_sequence")).distinct(), ["pid", "stop_id"])
        .withColumn("path_index", F.row_number().over(order) - 1)
        .withColumn(
            "elapsed", F.sum("time_to_previous").over(order.rowsBetween(W.unboundedPreceding, 0))
        )
    )


def origins_of(times: DataFrame) -> DataFrame:
    """One origin per (rt, pid, stop): the first time the pattern passes it."""
    return first_per_group(times, ["rt", "pid", "stop_id"], [F.col("path_index")])


def _route(df: DataFrame, catalogue: DataFrame | None) -> DataFrame:
    """Route of (origin stop, pid) after the catalogue, NULL where it has none."""
    if catalogue is None:
        return df.withColumn("route", F.col("rt"))
    routes = catalogue.groupBy("pid", F.col("stop_id").alias("origin_stop")).agg(F.min("route_id").alias("route"))
    return df.join(routes, ["pid", "origin_stop"], "left")


def reach_budgets(
    times: DataFrame, budgets: Sequence[int] = REACH_BUDGETS_MIN, catalogue: DataFrame | None = None
) -> DataFrame:
    """Per origin and budget: the last stop in reach and how many stops that spans.

    Elapsed time never falls along a pattern, so what a budget reaches is a range
    frame starting at the origin: no pairs of stops are formed.
    """
    order = W.partitionBy("rt", "pid").orderBy("elapsed")

    def furthest(minutes: int) -> Column:
        last = F.max(F.struct("path_index", "stop_sequence", "stop_id", "elapsed"))
        return F.struct(
            F.lit(minutes).alias("minutes"),
            last.over(order.rangeBetween(W.currentRow, minutes * 60)).alias("last"),
        )

    wide = times.withColumn("__reach", F.array(*[furthest(b) for b in budgets]))
    flat = origins_of(wide).select(
        "rt", "pid", F.col("stop_id").alias("origin_stop"), F.col("stop_sequence").alias("from_sequence"),
        "path_index", "elapsed", F.inline("__reach"),
    )
    out = flat.select(
        "rt", "pid", "origin_stop", "from_sequence", "minutes",
        budget_label("minutes").alias("time_label"), budget_rank("minutes").alias("time_rank"),
        F.col("last.stop_id").alias("last_stop"), F.col("last.stop_sequence").alias("to_sequence"),
        (F.col("last.path_index") - F.col("path_index") + 1).alias("stops_reached"),
        (F.col("last.elapsed") - F.col("elapsed")).alias("seconds_used"),
    )
    return _route(out, catalogue)


def reach_minutes(
    times: DataFrame, origins: DataFrame, catalogue: DataFrame | None = None
) -> DataFrame:
    """Whole minutes from each wanted origin to every later stop of its patterns.

    ``origins`` lists (stop_id): the report's own size is origins times the
    remainder of their patterns.
    """
    wanted = origins_of(times.join(origins.select("stop_id").distinct(), "stop_id", "left_semi")).select(
        "rt", "pid", F.col("stop_id").alias("origin_stop"), F.col("path_index").alias("__from"),
        F.col("elapsed").alias("__start"),
    )
    out = (
        times.join(wanted, ["rt", "pid"])
        .filter(F.col("path_index") >= F.col("__from"))
        .withColumn("travel_seconds", F.col("elapsed") - F.col("__start"))
        .select(
            "rt", "pid", "origin_stop", "stop_id", "stop_sequence", "travel_seconds",
            F.floor(F.col("travel_seconds") / 60).cast("int").alias("minutes"),
        )
    )
    return _route(out, catalogue)


def reach_paths(reach: DataFrame, pattern_points: DataFrame) -> DataFrame:
    """The part of the pattern a budget covers as an ordered path of points.

    Waypoints belong to the stop before them. A pattern's points travel as one
    array, cut to the covered part; no row is formed per point.
    """
    named = pattern_points.withColumn("__stop", fill_forward("stpid", ["pid"], ["seq"]))
    points = named.groupBy("pid").agg(
        F.array_sort(F.collect_list(F.struct("seq", "lon", "lat", F.col("__stop").alias("stop_id")))).alias("__points")
    )
    first = lambda stop: F.array_min(
        F.transform(F.filter("__points", lambda p: p["stop_id"] == F.col(stop)), lambda p: p["seq"])
    )
    last = F.array_max(
        F.transform(F.filter("__points", lambda p: p["stop_id"] == F.col("last_stop")), lambda p: p["seq"])
    )
    covered = F.filter("__points", lambda p: p["seq"].between(F.col("__a"), F.col("__b")))
    return (
        reach.join(points, "pid")
        .withColumn("__a", first("origin_stop"))
        .withColumn("__b", last)
        .withColumn("path", F.transform(covered, lambda p: F.struct(p["lon"].alias("lon"), p["lat"].alias("lat"))))
        .drop("__points", "__a", "__b")
    )


def reach_segments(minutes: DataFrame, legs: DataFrame, stops: DataFrame) -> DataFrame:
    """Continuous reach with the leg that leads to each stop, matched on (sequence, stop)."""
    geometry = (
        stops.select("pid", F.col("seq").cast("int").alias("stop_sequence"), F.col("stpid").alias("stop_id"), "segment")
        .join(legs.withColumnRenamed("segments", "segment"), ["pid", "segment"])
    )
    return minutes.join(geometry, ["pid", "stop_sequence", "stop_id"])
