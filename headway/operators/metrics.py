"""Stop and trip metrics over calendar periods; actual against scheduled."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from headway.functions.clock import floor_to, seconds_between
from headway.operators.periods import LIVE_PERIODS, alike, fan_out, finest, label_periods, roll_up
from headway.operators.ranks import SHORT_PACK, histogram, pivot_pack, ranked_pack, stack_values
from headway.operators.visits import daytime, headways, segment_times
from headway.session import staged

STOP_KEYS = ("rt", "pid", "stop_id")
TRIP_KEYS = ("rt", "pid")
STOP_METRICS = ("time_till_next_bus", "time_to_previous_stop", "cum_trip_time", "num_buses")
KINDS = ("actual", "schedule")
_CODES = ["__period", "__code"]


def _metric_code(kind: str, metric: str) -> int:
    return KINDS.index(kind) * len(STOP_METRICS) + STOP_METRICS.index(metric)


def value_histogram(
    df: DataFrame, keys: Sequence[str], time: str, values: Mapping[int, str | Column],
    periods: Sequence[str] = LIVE_PERIODS, as_of: str | None = None,
) -> DataFrame:
    """Counts of each value of each metric in each (keys, period), for the finest of the periods.

    Rows are counted by value and by what periods can tell of their time first, and only these
    counts fan out over the periods. The other periods are made of these by ``packs_by_period``.
    """
    if "last_full_month" in periods and as_of is None:
        raise ValueError("period last_full_month needs as_of")
    cols = {f"__v{code}": (F.col(c) if isinstance(c, str) else c) for code, c in values.items()}
    narrow = df.select(*keys, alike(time, periods).alias("__at"), *[c.alias(name) for name, c in cols.items()])
    stacked = stack_values(narrow, [*keys, "__at"], {code: f"__v{code}" for code in values})
    counted = histogram(stacked, [*keys, "__at", "metric"])
    spread = fan_out(counted, "__at", finest(periods), as_of)
    return spread.groupBy(*keys, *_CODES, "metric", "value").agg(F.sum("n").alias("n"))


def count_histogram(
    df: DataFrame, keys: Sequence[str], time: str, code: int,
    periods: Sequence[str] = LIVE_PERIODS, as_of: str | None = None,
) -> DataFrame:
    """Two-level counts: visits per slot, then how often each count occurs.

    Slots without a visit are not filled with zero. Visits are first counted per
    hour, which every larger slot is a sum of.
    """
    hourly = (
        df.groupBy(*keys, floor_to("hour", time).alias("__hour")).agg(F.count(F.lit(1)).alias("__n"))
    )
    slots = (
        fan_out(hourly, "__hour", periods, as_of, with_slot=True)
        .groupBy(*keys, *_CODES, "__slot")
        .agg(F.sum("__n").alias("value"))
    )
    return histogram(
        slots.withColumn("metric", F.lit(code).cast("tinyint")), [*keys, *_CODES, "metric"]
    )


def _whole_packs(
    values: DataFrame, packs: DataFrame, keys: Sequence[str], periods: Sequence[str], as_of: str | None, stats: Sequence[str],
) -> DataFrame:
    """Packs of the periods that are made up of others, out of the others' histogram and packs.

    A whole with one part has that part's pack. Only values of wholes with several parts are added up and ranked once more.
    """
    group = [*keys, *_CODES, "metric"]
    wholes = staged(
        roll_up(packs, periods, as_of).groupBy(*group).agg(F.count(F.lit(1)).alias("__parts"), F.first(F.struct(*stats)).alias("__pack"))
    )
    alone = wholes.where("__parts = 1").select(*group, "__pack.*")
    several = wholes.where("__parts > 1").select(*[F.col(c).alias(f"__of_{c}") for c in group])
    if not several.head(1):
        return alone
    same = F.lit(True)
    for c in group:
        same = same & F.col(c).eqNullSafe(F.col(f"__of_{c}"))
    again = roll_up(values, periods, as_of).join(several, same, "left_semi")
    summed = again.groupBy(*group, "value").agg(F.sum("n").alias("n"))
    return alone.unionByName(ranked_pack(summed, [*keys, *_CODES], stats=stats))


def packs_by_period(
    values: DataFrame | None, keys: Sequence[str], names: Mapping[int, str],
    periods: Sequence[str] = LIVE_PERIODS, stats: Sequence[str] = SHORT_PACK, as_of: str | None = None,
    counts: DataFrame | None = None,
) -> DataFrame:
    """Histograms to one row per (keys, period, period_value).

    ``values`` holds the finest of the periods and the others are made of it. ``counts`` holds every period, as what is
    counted differs with it.
    """
    parts = []
    if values is not None and len(finest(periods)) < len(periods):
        # Both are read twice; the packs are small.
        values = staged(values)
        packs = staged(ranked_pack(values, [*keys, *_CODES], stats=stats))
        parts = [packs, _whole_packs(values, packs, keys, periods, as_of, stats)]
    elif values is not None:
        parts = [ranked_pack(values, [*keys, *_CODES], stats=stats)]
    if counts is not None:
        parts.append(ranked_pack(counts, [*keys, *_CODES], stats=stats))
    packs = parts[0]
    for more in parts[1:]:
        packs = packs.unionByName(more)
    wide = pivot_pack(packs, [*keys, *_CODES], names, stats)
    labelled = label_periods(wide, periods)
    rest = [c for c in labelled.columns if c not in (*keys, "period", "period_value")]
    return labelled.select(*keys, "period", "period_value", *rest)


def period_metrics(
    df: DataFrame, metric: str, value: str | None = None, keys: Sequence[str] = STOP_KEYS,
    time: str = "bus_stop_time", periods: Sequence[str] = LIVE_PERIODS,
    as_of: str | None = None, stats: Sequence[str] = SHORT_PACK,
) -> DataFrame:
    """The metric pack of one value column, or of bus counts when ``value`` is None."""
    if value is None:
        counts = count_histogram(df, keys, time, 0, periods, as_of)
        return packs_by_period(None, keys, {0: metric}, periods, stats, counts=counts)
    values = value_histogram(df, keys, time, {0: value}, periods, as_of)
    return packs_by_period(values, keys, {0: metric}, periods, stats, as_of)


def _stop_histograms(
    visits: DataFrame, kind: str, periods: Sequence[str], as_of: str | None, is_daytime: bool, bucket: str
) -> tuple[DataFrame, DataFrame]:
    """Histograms of times, for the finest periods, and of bus counts, for all."""
    # Headways, segment times and bus counts each read the visits, so these are computed once.
    base = staged((daytime(visits) if is_daytime else visits).select(*STOP_KEYS, "trip_id", "stop_sequence", "bus_stop_time"))
    timed = segment_times(headways(base, bucket))
    values = {_metric_code(kind, m): m for m in STOP_METRICS[:3]}
    times = value_histogram(timed, STOP_KEYS, "bus_stop_time", values, periods, as_of)
    counts = count_histogram(
        base, STOP_KEYS, "bus_stop_time", _metric_code(kind, "num_buses"), periods, as_of
    )
    return times, counts.withColumn("value", F.col("value").cast("long"))


def _names(kinds: Sequence[str]) -> dict[int, str]:
    return {_metric_code(k, m): f"{k}_{m}" for k in kinds for m in STOP_METRICS}


def stop_metrics(
    visits: DataFrame, kind: str, periods: Sequence[str] = LIVE_PERIODS, as_of: str | None = None,
    stats: Sequence[str] = SHORT_PACK, is_daytime: bool = True, bucket: str = "day",
) -> DataFrame:
    """All four metrics of one kind. The metrics travel as rows and meet in one pivot, so no joins."""
    times, counts = _stop_histograms(visits, kind, periods, as_of, is_daytime, bucket)
    return packs_by_period(times, STOP_KEYS, _names([kind]), periods, stats, as_of, counts)


def _with_delay(df: DataFrame) -> DataFrame:
    delay = F.col("median_actual_time_till_next_bus") - F.col("median_schedule_time_till_next_bus")
    return df.withColumn("time_till_next_bus_delay", delay)


def compare_stop_metrics(actual: DataFrame, schedule: DataFrame) -> DataFrame:
    """Full outer join of two stored metric tables, with the headway delay."""
    keys = [*STOP_KEYS, "period", "period_value"]
    return _with_delay(schedule.join(actual, keys, "full"))


def stop_metrics_both(
    actual: DataFrame, scheduled: DataFrame, periods: Sequence[str] = LIVE_PERIODS,
    as_of: str | None = None, stats: Sequence[str] = SHORT_PACK, is_daytime: bool = True,
    bucket: str = "day",
) -> DataFrame:
    """``compare_stop_metrics`` of both kinds in one pass.

    Both kinds feed the same histograms and the pivot pairs them, which gives the rows
    of the full outer join without joining.
    """
    both = zip(
        _stop_histograms(actual, "actual", periods, as_of, is_daytime, bucket),
        _stop_histograms(scheduled, "schedule", periods, as_of, is_daytime, bucket),
    )
    times, counts = (a.unionByName(s) for a, s in both)
    return _with_delay(packs_by_period(times, STOP_KEYS, _names(KINDS), periods, stats, as_of, counts))


def trip_durations(visits: DataFrame) -> DataFrame:
    """First and last time of each trip and the seconds between."""
    return (
        visits.groupBy("trip_id", "rt", "pid")
        .agg(F.min("bus_stop_time").alias("start_trip"), F.max("bus_stop_time").alias("end_trip"))
        .withColumn("trip_duration", seconds_between("start_trip", "end_trip"))
    )


def trip_metrics(
    visits: DataFrame, kind: str, periods: Sequence[str] = LIVE_PERIODS, as_of: str | None = None,
    stats: Sequence[str] = SHORT_PACK,
) -> DataFrame:
    """Duration pack per (rt, pid, period), by the trip's start."""
    return period_metrics(
        trip_durations(visits), f"{kind}_trip_duration", "trip_duration", TRIP_KEYS, "start_trip",
        periods, as_of, stats,
    )


def compare_trip_metrics(
    actual: DataFrame, scheduled: DataFrame, periods: Sequence[str] = LIVE_PERIODS,
    as_of: str | None = None, stats: Sequence[str] = SHORT_PACK,
) -> DataFrame:
    """Actual and scheduled trip durations side by side, either may be missing."""
    hists = [
        value_histogram(
            trip_durations(v), TRIP_KEYS, "start_trip", {code: "trip_duration"}, periods, as_of
        )
        for code, v in enumerate((actual, scheduled))
    ]
    names = {i: f"{k}_trip_duration" for i, k in enumerate(KINDS)}
    return packs_by_period(hists[0].unionByName(hists[1]), TRIP_KEYS, names, periods, stats, as_of)


def hourly_counts_both(actual: DataFrame, scheduled: DataFrame) -> DataFrame:
    """Trips per (rt, stop, clock hour) present in both kinds."""
    def counts(v: DataFrame, name: str) -> DataFrame:
        return v.groupBy("rt", "stop_id", floor_to("hour", "bus_stop_time").alias("hour")).agg(
            F.count("bus_stop_time").alias(name)
        )

    return counts(scheduled, "num_trips_sched").join(
        counts(actual, "num_trips_actual"), ["rt", "stop_id", "hour"], "inner"
    )


def metrics_state(metrics: DataFrame) -> DataFrame:
    """Rows, distinct months, latest month and latest month with actual data."""
    month = F.when(F.col("period") == "month_abs", F.col("period_value"))
    has_actual = F.col("median_actual_time_till_next_bus").isNotNull()
    by_month = metrics.groupBy(month.alias("m")).agg(
        F.count(F.lit(1)).alias("n"), F.max(has_actual).alias("seen")
    )
    return by_month.agg(
        F.sum("n").alias("total_rows"),
        F.count("m").alias("total_months"),
        F.max("m").alias("max_month"),
        F.max(F.when(F.col("seen"), F.col("m"))).alias("max_month_actual"),
    )
