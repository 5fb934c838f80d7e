"""Vehicle pings: snapshots to rows, trip keys, cleaning."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window as W, functions as F

from headway import constants as K
from headway.functions import geo
from headway.functions.clock import parse_feed_time
from headway.functions.keys import normal_pid, trip_key
from headway.schemas import SNAPSHOT

TRIP = ("pid", "unique_trip_vehicle_day")


def explode_snapshots(docs: DataFrame, text: str = "value", file: str = "scrape_file") -> tuple[DataFrame, DataFrame]:
    """JSON snapshots to (pings, errors).

    A document maps chunk names to a response with vehicles, errors or both;
    either list may be absent. Broken documents give no rows in either output;
    ``unreadable_snapshots`` lists them.
    """
    parsed = docs.select(file, F.explode(F.map_values(F.from_json(text, SNAPSHOT))).alias("__chunk"))
    response = F.col("__chunk").getField("bustime-response")
    vehicles = parsed.select(file, F.explode(response.getField("vehicle")).alias("v")).select("v.*", file)
    errors = parsed.select(file, F.explode(response.getField("error")).alias("e")).select("e.*", file)
    t = parse_feed_time("tmstmp")
    pings = (
        vehicles.withColumns({
            "data_time": t, "lat": F.col("lat").try_cast("double"), "lon": F.col("lon").try_cast("double"),
            "dly": F.col("dly").try_cast("boolean"),
        })
        .withColumns({"data_hour": F.hour("data_time"), "data_date": F.to_date("data_time")})
    )
    return pings, errors


def unreadable_snapshots(docs: DataFrame, text: str = "value", file: str = "scrape_file") -> DataFrame:
    bad = F.from_json(text, SNAPSHOT).isNull() | (F.size(F.map_keys(F.from_json(text, SNAPSHOT))) <= 0)
    return docs.filter(F.coalesce(bad, F.lit(True))).select(file)


def key_trips(pings: DataFrame, sep: str = "") -> DataFrame:
    """Add ``unique_trip_vehicle_day`` from the ids as stored, then make ``pid`` uniform."""
    key = trip_key("rt", "pid", "tatripid", "vid", "data_date", sep=sep)
    return pings.withColumn("unique_trip_vehicle_day", key).withColumn("pid", normal_pid("pid"))


def clean_pings(
    pings: DataFrame,
    min_box_m2: float = K.MIN_TRIP_BOX_M2,
    standstill_m: float = K.STANDSTILL_M,
    only_kept: bool = True,
) -> DataFrame:
    """Drop trips that stand still, leading standstill pings and one-ping trips.

    Input needs ``pid, unique_trip_vehicle_day, ping_id, data_time, lat, lon``.
    With ``only_kept=False`` no row is dropped and ``drop_reason`` tells why it
    would be. All windows share the trip key, so there is a single shuffle.
    """
    ordered = W.partitionBy(*TRIP).orderBy("data_time", "ping_id")
    # Whole-trip figures use the same order, so that one sort serves all windows.
    trip = ordered.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    box = (F.max("x_m").over(trip) - F.min("x_m").over(trip)) * (
        F.max("y_m").over(trip) - F.min("y_m").over(trip)
    )
    step = geo.distance(
        F.col("x_m"), F.col("y_m"), F.lead("x_m").over(ordered), F.lead("y_m").over(ordered)
    )
    # The last ping has no step and always stands as a move.
    moves = F.coalesce((step >= standstill_m).cast("int"), F.lit(1))
    moved = F.max("__moves").over(ordered.rowsBetween(W.unboundedPreceding, 0)) == 1
    reason = (
        F.when(F.col("__box") <= min_box_m2, "stationary_trip")
        .when(~F.col("__moved"), "leading_standstill")
        .when(F.count_if(F.col("__moved")).over(trip) <= 1, "one_ping")
    )
    out = (
        geo.with_xy(pings)
        .withColumns({"__box": box, "__moves": moves})
        .withColumn("__moved", moved)
        .withColumn("drop_reason", reason)
        .drop("__box", "__moves", "__moved")
    )
    return out.filter(F.col("drop_reason").isNull()).drop("drop_reason") if only_kept else out
