"""Ordered-row operators over groups that may be very large.

A plain window sorts a whole group inside one task. Where a group can grow
without limit (one stop over years, one reused trip id) the operators here cut
it into time buckets: the window runs per (group, bucket), a summary with one
row per bucket carries what crosses bucket borders, and the two are joined on the
bucket. The result is the same as the plain window's, whatever the bucket. Keys and
time must not be NULL.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from headway.functions.clock import floor_to


def _bucketed(df: DataFrame, time: str, bucket: str) -> DataFrame:
    return df.withColumn("__bucket", floor_to(bucket, time))


def bucketed_next(
    df: DataFrame, keys: Sequence[str], time: str, tie: Sequence[str], out: str, bucket: str = "day"
) -> DataFrame:
    """Add ``out``: the ``time`` of the next row of the group, NULL on the last."""
    b = _bucketed(df, time, bucket)
    group = [*keys, "__bucket"]
    local = b.withColumn(out, F.lead(time).over(W.partitionBy(*group).orderBy(time, *tie)))
    firsts = b.groupBy(*group).agg(F.min(time).alias("__edge"))
    across = F.lead("__edge").over(W.partitionBy(*keys).orderBy("__bucket"))
    return (
        local.join(firsts.select(*group, across.alias("__across")), group, "left")
        .withColumn(out, F.coalesce(out, "__across"))
        .select(*df.columns, out)
    )


def bucketed_previous(
    df: DataFrame, keys: Sequence[str], time: str, tie: Sequence[str], out: str, bucket: str = "day"
) -> DataFrame:
    """Add ``out``: the ``time`` of the row before, NULL on the first."""
    b = _bucketed(df, time, bucket)
    group = [*keys, "__bucket"]
    local = b.withColumn(out, F.lag(time).over(W.partitionBy(*group).orderBy(time, *tie)))
    lasts = b.groupBy(*group).agg(F.max(time).alias("__edge"))
    across = F.lag("__edge").over(W.partitionBy(*keys).orderBy("__bucket"))
    return (
        local.join(lasts.select(*group, across.alias("__across")), group, "left")
        .withColumn(out, F.coalesce(out, "__across"))
        .select(*df.columns, out)
    )


def bucketed_running_sum(
    df: DataFrame, keys: Sequence[str], time: str, tie: Sequence[str], value: str | Column, out: str,
    bucket: str = "day", group_max: Mapping[str, str] | None = None,
) -> DataFrame:
    """Add ``out``: the sum of ``value`` over the group's rows up to this one.

    ``group_max`` maps further output columns to columns whose largest value in
    the whole group they take; it rides on the same summary.
    """
    extras = dict(group_max or {})
    b = _bucketed(df, time, bucket).withColumn("__v", F.col(value) if isinstance(value, str) else value)
    group = [*keys, "__bucket"]
    upto = W.partitionBy(*group).orderBy(time, *tie).rowsBetween(W.unboundedPreceding, 0)
    local = b.withColumn("__local", F.sum("__v").over(upto))
    sums = b.groupBy(*group).agg(
        F.sum("__v").alias("__total"), *[F.max(c).alias(name) for name, c in extras.items()]
    )
    along = W.partitionBy(*keys).orderBy("__bucket")
    whole = along.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    before = F.sum("__total").over(along.rowsBetween(W.unboundedPreceding, -1))
    summary = sums.select(
        *group, F.coalesce(before, F.lit(0)).alias("__before"),
        *[F.max(name).over(whole).alias(name) for name in extras],
    )
    return (
        local.join(summary, group, "left")
        .withColumn(out, F.col("__local") + F.col("__before"))
        .select(*df.columns, out, *extras)
    )


def bucketed_row_number(
    df: DataFrame, keys: Sequence[str], time: str, tie: Sequence[str], out: str, bucket: str = "day",
    group_max: Mapping[str, str] | None = None,
) -> DataFrame:
    """Add ``out``: the 1-based position of the row in its group by time."""
    return bucketed_running_sum(df, keys, time, tie, F.lit(1), out, bucket, group_max)


def first_per_group(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The first row of each group as a mergeable aggregate: no sort, no big group in one task."""
    rest = [c for c in df.columns if c not in keys]
    return (
        df.groupBy(*keys)
        .agg(F.min_by(F.struct(*rest), F.struct(*order)).alias("__r"))
        .select(*keys, *[F.col(f"__r.{c}").alias(c) for c in rest])
    )


def fill_forward(c: str | Column, partition: Sequence[str], order: Sequence[str | Column]) -> Column:
    frame = W.partitionBy(*partition).orderBy(*order).rowsBetween(W.unboundedPreceding, 0)
    return F.last(c, ignorenulls=True).over(frame)


def row_index(partition: Sequence[str], order: Sequence[str | Column]) -> Column:
    """0-based position."""
    return F.row_number().over(W.partitionBy(*partition).orderBy(*order)) - 1
