"""Small scalar rules: speeds, waits, rates, labels, flags."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, functions as F

from headway import constants as K


def _c(x: str | Column) -> Column:
    return F.col(x) if isinstance(x, str) else x


def speed_mph(metres: str | Column, seconds: str | Column) -> Column:
    """Mean speed; a zero gap counts as a tiny one, so it ends up out of range."""
    s = F.when(_c(seconds) == 0, F.lit(K.ZERO_GAP_SECONDS)).otherwise(_c(seconds))
    return (_c(metres) / K.SPEED_MILE_M) / (s / 3600)


def plausible_speed(mph: str | Column, low: float = K.MIN_SPEED_MPH, high: float = K.MAX_SPEED_MPH) -> Column:
    return F.when(_c(mph).between(low, high), _c(mph))


def plausible_step(metres: str | Column, low: float = K.MIN_STEP_M) -> Column:
    return F.when(_c(metres) >= low, _c(metres))


def wait_minutes(buses_per_hour: str | Column) -> Column:
    return F.try_divide(F.lit(60.0), _c(buses_per_hour))


def per_capita(n: str | Column, population: str | Column, per: int = 1000) -> Column:
    """NULL instead of infinity where nobody lives."""
    return F.try_divide(_c(n) * F.lit(float(per)), _c(population))


def budget_label(minutes: str | Column) -> Column:
    m = _c(minutes)
    out = F.lit(None).cast("string")
    for value, text in K.REACH_LABELS:
        out = F.when(m == value, F.lit(text)).otherwise(out)
    return out


def budget_rank(minutes: str | Column) -> Column:
    """Display order of the label."""
    m = _c(minutes)
    out = F.lit(None).cast("int")
    for rank, (value, _) in enumerate(K.REACH_LABELS):
        out = F.when(m == value, F.lit(rank)).otherwise(out)
    return out


def actual_without_schedule(columns: list[str]) -> Column:
    """True when some actual column holds a value and its schedule twin does not.

    Twins are columns whose names differ only in ``actual`` / ``schedule``.
    """
    tests = [
        F.col(c).isNotNull() & F.col(c.replace("actual", "schedule")).isNull()
        for c in columns
        if "actual" in c and c.replace("actual", "schedule") in columns
    ]
    return reduce(or_, tests, F.lit(False))
