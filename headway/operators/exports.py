"""Row shapes handed to maps and viewers."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from headway.functions.clock import clock_text, round_to_second
from headway.functions.keys import normal_pid

TRACE = ("rt", "pid", "stpid", "trip_id", "type", "bus_stop_time", "bus_stop_date")


def ping_points(pings: DataFrame) -> DataFrame:
    """``{position: [lat, lon], id, tmstmp, delayed}``, one per ping."""
    return pings.select(
        F.array("lat", "lon").alias("position"), F.col("vid").alias("id"),
        F.col("data_time").alias("tmstmp"), F.col("dly").alias("delayed"),
    )


def trip_trace(pings: DataFrame, stop_times: DataFrame) -> DataFrame:
    """Pings (B) and stop times (S) of trips in one list; order by trip, date and clock to read it."""
    def part(df: DataFrame, time: str, kind: str) -> DataFrame:
        at = round_to_second(time)
        stop = F.col("stpid") if kind == "S" else F.lit(None).cast("string")
        return df.select(
            "rt", normal_pid("pid").alias("pid"), stop.alias("stpid"),
            F.col("unique_trip_vehicle_day").alias("trip_id"), F.lit(kind).alias("type"),
            clock_text(at).alias("bus_stop_time"), F.to_date(at).alias("bus_stop_date"),
        )

    return part(stop_times, "bus_stop_time", "S").unionByName(part(pings, "data_time", "B"))


def trip_stop_geometry(stop_times: DataFrame, stops: DataFrame) -> DataFrame:
    """Stop times with the position of their stop, which may be missing."""
    where = stops.filter(F.col("typ") == "S").groupBy("pid", "stpid").agg(
        F.min_by("lat", "seq").alias("lat"), F.min_by("lon", "seq").alias("lon")
    )
    return stop_times.join(where, ["pid", "stpid"], "left")
