"""Quality checks of estimated stop times and of metric tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window as W, functions as F

from headway import constants as K
from headway.functions.clock import seconds_between
from headway.functions.measures import actual_without_schedule

CHECKS = (
    "avg_speed_trips", "na_times_trips", "same_time_trips", "min_max_time_issue_trips", "very_long_trips",
)


def trip_checks(
    stop_times: DataFrame, max_speed: float = K.QC_MAX_SPEED_MPH, max_hours: int = K.QC_MAX_TRIP_HOURS
) -> DataFrame:
    """One row per trip with a flag per check. Mergeable aggregates only, no sorting of trips."""
    t, seg = F.col("bus_stop_time"), F.col("seg_combined")
    per_trip = (
        stop_times.filter(F.col("typ") == "S")
        .groupBy("pid", "unique_trip_vehicle_day")
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.countDistinct(t).alias("times"),
            F.count_if(t.isNull()).alias("missing"),
            F.coalesce(F.max("speed_mph"), F.lit(0.0)).alias("top_speed"),
            F.min(t).alias("min_t"), F.max(t).alias("max_t"),
            F.min_by(F.struct(t.alias("t")), seg)["t"].alias("first_t"),
            F.max_by(F.struct(t.alias("t")), seg)["t"].alias("last_t"),
        )
    )
    in_place = (F.col("first_t") == F.col("min_t")) & (F.col("last_t") == F.col("max_t"))
    distinct = F.col("times") + (F.col("missing") > 0).cast("int")
    return per_trip.select(
        "pid", "unique_trip_vehicle_day",
        (F.col("top_speed") > max_speed).alias("avg_speed_trips"),
        (F.col("missing") > 0).alias("na_times_trips"),
        (distinct != F.col("n")).alias("same_time_trips"),
        (~F.coalesce(in_place, F.lit(False))).alias("min_max_time_issue_trips"),
        F.coalesce(seconds_between("min_t", "max_t") > max_hours * 3600, F.lit(False)).alias("very_long_trips"),
    )


def qc_summary(checks: DataFrame) -> DataFrame:
    """Trips per pattern failing each check."""
    return checks.groupBy("pid").agg(*[F.count_if(F.col(c)).alias(c) for c in CHECKS])


def qc_examples(checks: DataFrame, n: int = K.QC_EXAMPLES) -> DataFrame:
    """The first ``n`` trips per pattern and check; ranked map-side before the shuffle."""
    failed = F.array(*[F.when(F.col(c), F.lit(c)) for c in CHECKS])
    rows = checks.select("pid", F.explode(F.array_compact(failed)).alias("issue"), "unique_trip_vehicle_day")
    w = W.partitionBy("pid", "issue").orderBy("unique_trip_vehicle_day")
    return rows.withColumn("example", F.row_number().over(w)).filter(F.col("example") <= n)


def qc_error_rate(checks: DataFrame) -> DataFrame:
    """Issues as a percentage of trips for patterns with any, worst first when sorted by ``perc``."""
    issues = sum((F.col(c).cast("int") for c in CHECKS[1:]), F.col(CHECKS[0]).cast("int"))
    return (
        checks.groupBy("pid")
        .agg(F.count(F.lit(1)).alias("total_trips"), F.sum(issues).alias("issues"))
        .filter(F.col("issues") > 0)
        .withColumn("perc", F.col("issues") / F.col("total_trips") * 100)
    )


def qc_metrics(metrics: DataFrame) -> DataFrame:
    """Mark metric rows that hold an actual figure without its scheduled twin."""
    return metrics.withColumn("actual_nulls_not_in_schedule", actual_without_schedule(metrics.columns))
