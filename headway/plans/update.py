"""Incremental runs: new days in, stop times appended, metrics rebuilt."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from headway.operators.audit import run_stats
from headway.operators.metrics import metrics_state, stop_metrics_both
from headway.operators.visits import actual_visits, scheduled_visits
from headway.plans.process import stop_times
from headway.sources.writers import publish, write_partitioned


def service_date(data_date: Column) -> Column:
    """The day of data as a date, from a date or from text in either usual form; any other value fails the run."""
    text = data_date.cast("string")
    iso = F.concat_ws("-", F.substring(text, 1, 4), F.substring(text, 5, 2), F.substring(text, 7, 2))
    # Formatted parsing fails by an exception, row by row, so the two usual shapes are cast; it decides on all others.
    plain = F.when(text.rlike(r"^[0-9]{8}\z"), iso).when(text.rlike(r"^[0-9]{4}-[0-9]{2}-[0-9]{2}\z"), text).try_cast("date")
    day = F.coalesce(plain, F.try_to_date(text, "yyyy-MM-dd"), F.try_to_date(text, "yyyyMMdd"))
    return F.when(day.isNull(), F.raise_error(F.concat(F.lit("no service date in "), F.coalesce(text, F.lit("NULL"))))).otherwise(day)


def new_days(pings: DataFrame, held: DataFrame | None) -> DataFrame:
    """Pings of days the stop-time table does not hold yet."""
    if held is None:
        return pings
    days = held.select(F.col("service_date").alias("__held")).distinct()
    return pings.join(days, service_date(F.col("data_date")) == F.col("__held"), "left_anti")


def append_stop_times(spark: SparkSession, pings: DataFrame, points: DataFrame, path: str) -> DataFrame:
    """Process pings of new days and write them as partitions by service date.

    The service date is the pings' ``data_date``, carried along with the trip. A day is replaced
    as a whole, so a second run of the same input leaves the table as it is. Returns the run's figures.
    """
    done = stop_times(pings, points).stop_times
    write_partitioned(done.withColumn("service_date", service_date(F.col("data_date"))).drop("data_date"), path, ["service_date"])
    return run_stats(spark.read.parquet(path))


def update_metrics(
    spark: SparkSession, stop_time_path: str, timetable: DataFrame, out: str, version: str, as_of: str
) -> DataFrame:
    """Rebuild the combined metric table and publish it under ``version``; returns its state."""
    actual = actual_visits(spark.read.parquet(stop_time_path))
    table = stop_metrics_both(actual, scheduled_visits(timetable), as_of=as_of)
    publish(table, out, version)
    return metrics_state(spark.read.parquet(f"{out}/version={version}"))
