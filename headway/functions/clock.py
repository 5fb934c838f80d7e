"""Times: parsing, service-day clock, truncation, differences.

All timestamps are ``timestamp_ntz`` (naive local time), so no result depends on
the session time zone.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from headway.constants import DAY_FIRST_HOUR, DAY_LAST_HOUR


def _c(x: str | Column) -> Column:
    return F.col(x) if isinstance(x, str) else x


def parse_feed_time(text: str | Column) -> Column:
    """``yyyyMMdd HH:mm`` to a timestamp; anything else is NULL."""
    t = _c(text)
    iso = F.regexp_replace(t, r"^(\d{4})(\d{2})(\d{2}) (\d{2}:\d{2})$", "$1-$2-$3 $4:00")
    return F.when(t.rlike(r"^\d{8} \d{2}:\d{2}$"), iso.try_cast("timestamp_ntz"))


def parse_service_date(text: str | Column) -> Column:
    """``yyyyMMdd`` (or ISO) text to a date; anything else is NULL."""
    t = _c(text).cast("string")
    iso = F.concat_ws("-", F.substring(t, 1, 4), F.substring(t, 5, 2), F.substring(t, 7, 2))
    return F.when(F.length(t) == 8, iso).otherwise(t).try_cast("date")


def service_time(service_date: Column, clock: str | Column, strict_reference: bool = False) -> Column:
    """Service date plus an ``HH:MM:SS`` clock whose hour may pass 23.

    ``strict_reference`` keeps the narrower published rule: only hour 24 rolls
    over, every ``24`` in such a text turns into ``00`` (minutes and seconds too)
    and hours from 25 on give NULL.
    """
    t = _c(clock)
    if strict_reference:
        rolls = t.startswith("24")
        text = F.when(rolls, F.replace(t, F.lit("24"), F.lit("00"))).otherwise(t)
        day = F.when(rolls, F.date_add(service_date, 1)).otherwise(service_date)
        shaped = t.rlike(r"^\d{1,2}:[0-5]\d:[0-5]\d$")
        return F.when(shaped, F.concat_ws(" ", day.cast("string"), text).try_cast("timestamp_ntz"))
    return after(service_date, clock_seconds(t))


def after(service_date: Column, seconds: Column) -> Column:
    """So many seconds after a day begins; NULL where either is."""
    return F.timestamp_add("SECOND", seconds, service_date.cast("timestamp_ntz"))


def clock_seconds(clock: str | Column) -> Column:
    """Seconds of an ``HH:MM:SS`` clock whose hour may pass 23; anything else is NULL."""
    t = _c(clock)
    hour = F.substring_index(t, ":", 1).try_cast("int")
    minute = F.substring_index(F.substring_index(t, ":", 2), ":", -1).try_cast("int")
    second = F.substring_index(t, ":", -1).try_cast("int")
    three_parts = F.length(t) - F.length(F.replace(t, F.lit(":"), F.lit(""))) == 2
    valid = three_parts & (hour >= 0) & minute.between(0, 59) & second.between(0, 59)
    return F.when(valid, hour * 3600 + minute * 60 + second)


def seconds_between(start: str | Column, end: str | Column) -> Column:
    """Whole seconds from start to end, truncated."""
    return F.timestamp_diff("SECOND", _c(start), _c(end))


def exact_seconds_between(start: str | Column, end: str | Column) -> Column:
    """Seconds with fraction from start to end."""
    return F.timestamp_diff("MICROSECOND", _c(start), _c(end)) / F.lit(1e6)


def add_seconds(ts: str | Column, seconds: Column) -> Column:
    """Timestamp plus a fractional number of seconds; NULL if either is."""
    return F.timestamp_add("MICROSECOND", F.round(seconds * F.lit(1e6)).cast("long"), _c(ts))


def iso_weekday(ts: str | Column) -> Column:
    """Monday is 1."""
    return F.weekday(_c(ts)) + 1


def is_daytime(ts: str | Column, first: int = DAY_FIRST_HOUR, last: int = DAY_LAST_HOUR) -> Column:
    """Hour within ``[first, last]``; NULL times fail."""
    return F.hour(_c(ts)).between(first, last)


def in_last_full_month(ts: str | Column, as_of: str) -> Column:
    """Within the calendar month before ``as_of`` (a plain range, so it prunes and pushes down)."""
    first_of_month = F.trunc(F.lit(as_of).cast("date"), "month")
    c = _c(ts)
    return (c >= F.add_months(first_of_month, -1).cast("timestamp_ntz")) & (
        c < first_of_month.cast("timestamp_ntz")
    )


def on_day(ts: str | Column, day: str) -> Column:
    """Within one date, as a range that can be pushed down."""
    c, start = _c(ts), F.lit(day).cast("date")
    return (c >= start.cast("timestamp_ntz")) & (c < F.date_add(start, 1).cast("timestamp_ntz"))


def floor_to(unit: str, ts: str | Column) -> Column:
    """Truncate to second, hour, day, week (Monday), month or year.

    Built from date parts: Spark's own truncation passes through the session time
    zone and would move naive times that fall into a daylight-saving gap.
    """
    c = _c(ts)
    day = F.to_date(c)
    if unit in ("week", "month", "year"):
        return F.trunc(day, unit).cast("timestamp_ntz")
    if unit == "day":
        return day.cast("timestamp_ntz")
    if unit == "hour":
        return F.timestamp_add("HOUR", F.hour(c), day.cast("timestamp_ntz"))
    if unit == "second":
        seconds = F.hour(c) * 3600 + F.minute(c) * 60 + F.second(c)
        return F.timestamp_add("SECOND", seconds, day.cast("timestamp_ntz"))
    raise ValueError(f"cannot truncate to {unit!r}")


def round_to_second(ts: str | Column) -> Column:
    """Nearest second, halves to the even second."""
    c = _c(ts)
    floor = floor_to("second", c)
    micros = F.timestamp_diff("MICROSECOND", floor, c)
    up = (micros > 500000) | ((micros == 500000) & (F.second(c) % 2 == 1))
    return F.timestamp_add("SECOND", F.when(up, 1).otherwise(0), floor)


def clock_text(ts: str | Column) -> Column:
    """``HH:mm:ss``."""
    c = _c(ts)
    return F.concat_ws(":", *[F.lpad(part(c).cast("string"), 2, "0") for part in (F.hour, F.minute, F.second)])
