"""Calendar periods and the fan-out of rows over them.

Each period maps a timestamp to a small integer code; rows are grouped by the
code and the readable ``period_value`` is made from it after the aggregation, so
that shuffled rows stay narrow.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from headway.functions.clock import floor_to, in_last_full_month, iso_weekday


def _day_number(day: Column) -> Column:
    return F.datediff(day, F.lit("1970-01-01").cast("date")).cast("int")


def _day_text(code: Column) -> Column:
    return F.date_add(F.lit("1970-01-01").cast("date"), code).cast("string")


def _pair_text(code: Column) -> Column:
    return F.concat_ws("-", F.floor(code / 100).cast("string"), (code % 100).cast("string"))


def _plain_text(code: Column) -> Column:
    return code.cast("string")


@dataclass(frozen=True)
class Period:
    """``code`` labels a timestamp, ``slot`` is the unit bus counts are taken over."""

    name: str
    code: Callable[[Column], Column]
    text: Callable[[Column], Column]
    slot: str


PERIODS = (
    Period("hour", lambda t: F.hour(t), _plain_text, "hour"),
    Period("weekday", lambda t: iso_weekday(t), _plain_text, "day"),
    Period("month", lambda t: F.month(t), _plain_text, "month"),
    Period("year", lambda t: F.year(t), _plain_text, "year"),
    Period("month_abs", lambda t: _day_number(F.trunc(t.cast("date"), "month")), _day_text, "month"),
    Period("year_hour", lambda t: F.year(t) * 100 + F.hour(t), _pair_text, "hour"),
    Period("year_weekday", lambda t: F.year(t) * 100 + iso_weekday(t), _pair_text, "day"),
    Period("last_full_month", lambda t: F.lit(0), lambda c: F.lit("last_full_month"), "month"),
    Period("dayofyear", lambda t: F.dayofyear(t), _plain_text, "day"),
    Period("week", lambda t: F.weekofyear(t), _plain_text, "week"),
    Period("week_abs", lambda t: _day_number(F.trunc(t.cast("date"), "week")), _day_text, "week"),
)
BY_NAME = {p.name: p for p in PERIODS}
LIVE_PERIODS = tuple(p.name for p in PERIODS[:8])
OLDER_PERIODS = ("hour", "weekday", "dayofyear", "week", "month", "year", "week_abs", "month_abs")


def _chosen(names: Sequence[str], as_of: str | None) -> list[tuple[int, Period]]:
    if "last_full_month" in names and as_of is None:
        raise ValueError("period last_full_month needs as_of")
    return [(i, p) for i, p in enumerate(PERIODS) if p.name in names]


def _date_of(code: Column) -> Column:
    return F.date_add(F.lit("1970-01-01").cast("date"), code)


#: Periods that are made up of whole parts of another one: the other, and the code out of the part's.
_MADE_OF = {
    "hour": ("year_hour", lambda c, as_of: F.pmod(c, F.lit(100))),
    "weekday": ("year_weekday", lambda c, as_of: F.pmod(c, F.lit(100))),
    "month": ("month_abs", lambda c, as_of: F.month(_date_of(c))),
    "year": ("month_abs", lambda c, as_of: F.year(_date_of(c))),
    "last_full_month": (
        "month_abs", lambda c, as_of: F.when(in_last_full_month(_date_of(c).cast("timestamp_ntz"), as_of), F.lit(0))
    ),
    "week": ("week_abs", lambda c, as_of: F.weekofyear(_date_of(c))),
}


def finest(names: Sequence[str]) -> list[str]:
    """The periods named that are not made up of parts of another one named."""
    return [n for n in names if n not in _MADE_OF or _MADE_OF[n][0] not in names]


def period_number(name: str) -> int:
    return PERIODS.index(BY_NAME[name])


def roll_up(df: DataFrame, names: Sequence[str], as_of: str | None) -> DataFrame:
    """Rows of the finest periods named as rows of the other ones, which they are parts of."""
    entries = []
    for i, p in _chosen(names, as_of):
        if p.name in finest(names):
            continue
        part, code = _MADE_OF[p.name]
        here = F.col("__period") == period_number(part)
        whole = code(F.col("__code"), as_of).cast("int")
        if p.name == "last_full_month":
            here = here & whole.isNotNull()
        entries.append(F.when(here, F.struct(F.lit(i).cast("tinyint").alias("__period"), whole.alias("__code"))))
    rest = [c for c in df.columns if c not in ("__period", "__code")]
    return df.select(*rest, F.inline(F.filter(F.array(*entries), lambda e: e.isNotNull())))


#: Periods that tell the days of a month, weekdays, months and years apart.
_BY_DAY = {"dayofyear", "week", "week_abs"}
_BY_WEEKDAY = {"weekday", "year_weekday"}
_BY_MONTH = {"month", "month_abs", "last_full_month"}
_BY_YEAR = {"year", "year_hour", "year_weekday"}


def alike(time: str, names: Sequence[str]) -> Column:
    """A time with the same code as ``time`` in every period named, the same for as many rows as can be.

    The hour; where no period tells the days of a month apart but by weekday, that hour on the month's
    first such weekday, or on its first day. Where none tells months apart, the same of the year, or of no year.
    """
    t = F.col(time)
    if _BY_DAY & set(names):
        return floor_to("hour", t)
    if _BY_MONTH & set(names):
        first = F.trunc(t.cast("date"), "month")
    elif _BY_YEAR & set(names):
        first = F.trunc(t.cast("date"), "year")
    else:
        first = F.lit("1970-01-01").cast("date")
    day = first
    if _BY_WEEKDAY & set(names):
        day = F.date_add(first, F.pmod(F.weekday(t) - F.weekday(first), F.lit(7)).cast("int"))
    return F.timestamp_add("HOUR", F.hour(t), day.cast("timestamp_ntz"))


def fan_out(
    df: DataFrame, time: str, names: Sequence[str], as_of: str | None, with_slot: bool = False
) -> DataFrame:
    """One row per period with ``__period``, ``__code`` (and ``__slot``); the time column goes.

    A row outside the last full month has no entry for that period.
    """
    t = F.col(time)
    entries = []
    for i, p in _chosen(names, as_of):
        fields = [F.lit(i).cast("tinyint").alias("__period"), p.code(t).cast("int").alias("__code")]
        if with_slot:
            fields.append(floor_to(p.slot, t).alias("__slot"))
        entry = F.struct(*fields)
        if p.name == "last_full_month":
            entry = F.when(in_last_full_month(t, as_of), entry)
        entries.append(entry)
    out = df.select(*[c for c in df.columns if c != time], F.inline(F.array(*entries)))
    return out.filter(F.col("__period").isNotNull()) if "last_full_month" in names else out


def label_periods(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Codes to ``period`` and ``period_value``."""
    period, value = F.lit(None).cast("string"), F.lit(None).cast("string")
    for i, p in enumerate(PERIODS):
        if p.name in names:
            here = F.col("__period") == i
            period = F.when(here, F.lit(p.name)).otherwise(period)
            value = F.when(here, p.text(F.col("__code"))).otherwise(value)
    rest = [c for c in df.columns if c not in ("__period", "__code")]
    return df.select(period.alias("period"), value.alias("period_value"), *rest)
