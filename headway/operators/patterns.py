"""Pattern geometry: ordered points to stops and legs; patterns out of GTFS tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window as W, functions as F

from headway import constants as K
from headway.functions import geo
from headway.functions.keys import bare_pid, pattern_stop_id, shape_pid
from headway.operators.ordered import first_per_group


def build_patterns(points: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``pattern_points`` to (stops, legs).

    Point k gets ordinal ``segment`` = k. Leg k joins points k-1 and k; leg 0 is
    the first point alone and has no length.
    """
    order = W.partitionBy("pid").orderBy("seq")
    xy = geo.with_xy(points.select("pid", "seq", "lat", "lon", "typ", "stpid", "stpnm", "pdist"))
    stops = xy.withColumn("segment", F.row_number().over(order) - 1).withColumn(
        "p_stp_id", pattern_stop_id("pid", "stpid")
    )
    # The previous point is read with lag over the same order, so one sort serves both.
    x0, y0 = (F.coalesce(F.lag(c).over(order), F.col(c)) for c in ("x_m", "y_m"))
    legs = stops.select(
        "pid",
        F.col("segment").alias("segments"),
        x0.alias("x0"), y0.alias("y0"), F.col("x_m").alias("x1"), F.col("y_m").alias("y1"),
    ).withColumn("length_ft", geo.distance("x0", "y0", "x1", "y1") * K.FEET_PER_METRE)
    return stops, legs


def stops_per_pattern(points: DataFrame) -> DataFrame:
    return points.groupBy("pid").agg(F.count_if(F.col("typ") == "S").alias("stops"))


def current_or_historic(current: DataFrame, historic: DataFrame, key: str = "pid") -> DataFrame:
    """Rows of the current version; historic rows only for keys it lacks."""
    known = current.select(key).distinct()
    return current.unionByName(historic.join(known, key, "left_anti"))


def missing_patterns(wanted: DataFrame, points: DataFrame) -> DataFrame:
    """Pattern ids asked for but without points."""
    return wanted.select("pid").distinct().join(points.select("pid").distinct(), "pid", "left_anti")


def shape_points(shapes: DataFrame) -> DataFrame:
    """GTFS shapes under pattern column names."""
    return shapes.select(
        "shape_id",
        F.col("shape_pt_sequence").try_cast("int").alias("seq"),
        F.col("shape_pt_lat").alias("lat"),
        F.col("shape_pt_lon").alias("lon"),
        F.col("shape_dist_traveled").try_cast("double").alias("pdist"),
    )


def patterns_by_coordinates(shapes: DataFrame, stops: DataFrame, trips: DataFrame) -> DataFrame:
    """Shape points that carry a stop's exact coordinate text are stops, the rest waypoints.

    Shapes no trip uses are left out. Coordinates are compared as text.
    """
    named = stops.select(
        F.col("stop_lat").alias("lat"), F.col("stop_lon").alias("lon"),
        F.col("stop_id").alias("stpid"), F.col("stop_name").alias("stpnm"),
    )
    used = trips.select("shape_id").distinct()
    return (
        shape_points(shapes)
        .join(used, "shape_id", "left_semi")
        .join(named, ["lat", "lon"], "left")
        .select(
            "shape_id", shape_pid("shape_id").alias("pid"), "seq",
            F.col("lat").try_cast("double").alias("lat"), F.col("lon").try_cast("double").alias("lon"),
            F.when(F.col("stpid").isNotNull(), "S").otherwise("W").alias("typ"),
            "stpid", "stpnm", "pdist",
        )
    )


def bus_stops_only(stops: DataFrame) -> DataFrame:
    return stops.filter((F.col("location_type") == "0") & F.col("parent_station").isNull())


def near_pairs(
    left: DataFrame, right: DataFrame, radius: float, distance: str = "dist"
) -> DataFrame:
    """Rows of both sides whose (x_m, y_m) lie within ``radius``.

    An equi-join on grid cells of that size: each right row is copied to its nine
    neighbour cells, each left row stays in one, so a pair is met exactly once.
    Right columns must not clash with left ones, positions apart.
    """
    around = F.array(*[F.lit(d).cast("long") for d in (-1, 0, 1)])
    r = (
        right.withColumnsRenamed({"x_m": "__rx", "y_m": "__ry"})
        .withColumn("__dx", F.explode(around))
        .withColumn("__dy", F.explode(around))
        .withColumn("__cx", geo.cell("__rx", radius) + F.col("__dx"))
        .withColumn("__cy", geo.cell("__ry", radius) + F.col("__dy"))
        .drop("__dx", "__dy")
    )
    l = left.withColumn("__cx", geo.cell("x_m", radius)).withColumn("__cy", geo.cell("y_m", radius))
    return (
        l.join(r, ["__cx", "__cy"])
        .withColumn(distance, geo.distance("x_m", "y_m", "__rx", "__ry"))
        .filter(F.col(distance) <= radius)
        .drop("__cx", "__cy", "__rx", "__ry")
    )


def nearest_stop_points(shapes: DataFrame, stops: DataFrame, radius: float = K.SHAPE_STOP_M) -> DataFrame:
    """``(shape_id, stpid, seq, dist)``: for each shape and stop the closest shape point.

    A point counts for its nearest stop, for all of them where several are equally near, and a
    stop keeps its closest point. Distances are the same computation for stops in one spot, so
    these tie exactly.
    """
    pts = shapes.select("shape_id", "seq", "x_m", "y_m")
    # Stops in one spot are met once and told apart again afterwards.
    named = stops.groupBy("x_m", "y_m").agg(F.collect_set("stpid").alias("__stpids"))
    pairs = near_pairs(pts, named, radius).select("shape_id", "seq", "__stpids", "dist")
    least = pairs.groupBy("shape_id", "seq").agg(F.min("dist").alias("dist"))
    nearest = pairs.join(least, ["shape_id", "seq", "dist"]).select(
        "shape_id", "seq", F.explode("__stpids").alias("stpid"), "dist"
    )
    return first_per_group(nearest, ["shape_id", "stpid"], [F.col("dist"), F.col("seq")])


def patterns_by_distance(
    shapes: DataFrame, stops: DataFrame, trips: DataFrame, radius: float = K.SHAPE_STOP_M
) -> DataFrame:
    """Like ``patterns_by_coordinates`` with a distance test instead of equal text."""
    pts = geo.with_xy(
        shape_points(shapes)
        .withColumn("lat", F.col("lat").try_cast("double"))
        .withColumn("lon", F.col("lon").try_cast("double"))
        .join(trips.select("shape_id").distinct(), "shape_id", "left_semi")
    )
    named = geo.with_xy(
        stops.select(
            F.col("stop_id").alias("stpid"), F.col("stop_name").alias("stpnm"),
            F.col("stop_lat").try_cast("double").alias("lat"),
            F.col("stop_lon").try_cast("double").alias("lon"),
        )
    )
    found = nearest_stop_points(pts, named, radius).join(named.select("stpid", "stpnm"), "stpid")
    return (
        pts.join(found.drop("dist"), ["shape_id", "seq"], "left")
        .select(
            "shape_id", shape_pid("shape_id").alias("pid"), "seq", "lat", "lon",
            F.when(F.col("stpid").isNotNull(), "S").otherwise("W").alias("typ"),
            "stpid", "stpnm", "pdist",
        )
    )


def stop_pattern_catalogue(trips: DataFrame, stop_times: DataFrame) -> DataFrame:
    """Distinct (route, pattern, stop, sequence) out of GTFS trips and stop times."""
    return (
        stop_times.select("trip_id", "stop_id", "stop_sequence")
        .join(trips.select("trip_id", "route_id", "shape_id"), "trip_id")
        .select("route_id", bare_pid(shape_pid("shape_id")).alias("pid"), "stop_id", "stop_sequence")
        .distinct()
    )
