"""Identifiers: trip keys, pattern ids, stop ids."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def trip_key(*parts: str | Column, sep: str = "") -> Column:
    """Join the parts into one key; a NULL part is skipped, not propagated.

    The default has no separator, which lets ``('1', '23')`` and ``('12', '3')``
    collide; pass ``sep`` where old keys need not be matched.
    """
    return F.concat_ws(sep, *[F.col(p) if isinstance(p, str) else p for p in parts])


def normal_pid(pid: str | Column) -> Column:
    """``'95.0'`` or 95.0 becomes ``'95'``; what is not a number becomes NULL."""
    c = F.col(pid) if isinstance(pid, str) else pid
    return c.try_cast("double").try_cast("int").cast("string")


def shape_pid(shape_id: str | Column) -> Column:
    """The pattern id is the last five characters of a shape id."""
    c = F.col(shape_id) if isinstance(shape_id, str) else shape_id
    return F.right(c.cast("string"), F.lit(5))


def bare_pid(pid: str | Column) -> Column:
    """Pattern id without leading zeros."""
    c = F.col(pid) if isinstance(pid, str) else pid
    return c.try_cast("int").cast("string")


def padded_pid(pid: str | Column) -> Column:
    """Pattern id padded with zeros to five characters."""
    c = F.col(pid) if isinstance(pid, str) else pid
    return F.lpad(c.cast("string"), 5, "0")


def pattern_stop_id(pid: str | Column, stpid: str | Column) -> Column:
    """``pid-stpid``; NULL on waypoints, which have no stop id."""
    p = F.col(pid) if isinstance(pid, str) else pid
    s = F.col(stpid) if isinstance(stpid, str) else stpid
    return F.when(s.isNotNull(), F.concat_ws("-", p, s))
