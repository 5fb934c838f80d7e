"""Time spent on each leg of a pattern."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window as W, functions as F

from headway.functions import geo
from headway.functions.clock import exact_seconds_between
from headway.operators.pings import TRIP


def leg_times(matched: DataFrame, legs: DataFrame, leg_offset: float = 0.5) -> DataFrame:
    """Per (pid, leg): seconds spent on it in all, and how often it was passed.

    The time between two placed pings is shared out over the legs between them by
    the distance covered on each, measured along the pattern.
    """
    order = W.partitionBy("pid").orderBy("segments")
    along = legs.withColumn(
        "__end", F.sum("length_ft").over(order.rowsBetween(W.unboundedPreceding, 0))
    ).withColumn("__begin", F.col("__end") - F.col("length_ft"))
    dx, dy = F.col("x1") - F.col("x0"), F.col("y1") - F.col("y0")
    share = F.try_divide(
        (F.col("x_m") - F.col("x0")) * dx + (F.col("y_m") - F.col("y0")) * dy, dx * dx + dy * dy
    )
    share = F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.coalesce(share, F.lit(0.0))))
    placed = (
        matched.withColumn("segments", F.round(F.col("seg_combined") - leg_offset).cast("int"))
        .join(along, ["pid", "segments"])
        .select(*TRIP, "segments", "seg_combined", "data_time", (F.col("__begin") + share * F.col("length_ft")).alias("__at"))
    )
    w = W.partitionBy(*TRIP).orderBy("seg_combined")
    hops = (
        placed.withColumn("__to", F.lead("segments").over(w))
        .withColumn("__until", F.lead("__at").over(w))
        .withColumn("__dt", exact_seconds_between("data_time", F.lead("data_time").over(w)))
        .filter(F.col("__until") > F.col("__at"))
        .withColumn("__pace", F.col("__dt") / (F.col("__until") - F.col("__at")))
        .withColumn("segments", F.explode(F.sequence("segments", "__to")))
    )
    covered = F.least("__end", "__until") - F.greatest("__begin", "__at")
    return (
        hops.join(along.select("pid", "segments", "__begin", "__end"), ["pid", "segments"])
        .withColumn("__ft", F.greatest(F.lit(0.0), covered))
        .filter(F.col("__ft") > 0)
        .groupBy("pid", "segments")
        .agg(
            F.sum(F.col("__ft") * F.col("__pace")).alias("seconds"),
            F.sum("__ft").alias("feet"),
            F.count(F.lit(1)).alias("occurrences"),
        )
    )
