"""Pings to stop times in one job: no loop over patterns or trips."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame, Window as W, functions as F

from headway.operators.interpolate import interpolate_stop_times, reject_report, rejects
from headway.operators.matching import match_status, match_to_legs
from headway.operators.patterns import build_patterns
from headway.operators.pings import TRIP, clean_pings
from headway.session import staged


class Processed(NamedTuple):
    stop_times: DataFrame
    rejects: DataFrame
    report: DataFrame


def with_ping_id(pings: DataFrame) -> DataFrame:
    """A stable id per ping for tie-breaking: a hash of its content, the same on every retry.

    Pings that repeat one another within a trip are numbered first, so that each stays a ping of its own.
    """
    if "ping_id" in pings.columns:
        return pings
    ids = [c for c in ("vid", "data_time", "lat", "lon", "unique_trip_vehicle_day") if c in pings.columns]
    # Dealt by trip, as the cleaning that follows needs it.
    repeats = W.partitionBy(*TRIP, *[c for c in ids if c not in TRIP]).orderBy(F.lit(0))
    numbered = pings.repartition(*TRIP).withColumn("__repeat", F.row_number().over(repeats))
    return numbered.withColumn("ping_id", F.xxhash64(*ids, "__repeat")).drop("__repeat")


def stop_times(pings: DataFrame, points: DataFrame, leg_offset: float = 0.5, anchor: str = "next") -> Processed:
    """Keyed pings and pattern points to stop times, rejected trips and a report per pattern.

    Cleaned and matched pings are staged, since the three results all read them.
    """
    stops, legs = build_patterns(points)
    cleaned = staged(clean_pings(with_ping_id(pings)))
    matched = staged(match_to_legs(cleaned, legs, leg_offset=leg_offset))
    status = match_status(cleaned, matched)
    return Processed(
        interpolate_stop_times(matched, stops, anchor), rejects(status), reject_report(pings, status)
    )
