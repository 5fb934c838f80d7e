"""Map matching: pings to monotone positions along their pattern."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from headway import constants as K
from headway.functions import geo
from headway.operators.ordered import bucketed_row_number
from headway.operators.pings import TRIP
from headway.session import staged

#: What tells a ping from all others. An id alone may be a hash that two pings of a large table share.
PING = (*TRIP, "data_time", "ping_id")


def _beside(df: DataFrame) -> tuple[DataFrame, Column]:
    """The rows with ping keys renamed, and the condition to join them on: NULL meets NULL."""
    condition = F.lit(True)
    for k in PING:
        condition = condition & F.col(k).eqNullSafe(F.col(f"__{k}"))
    return df.withColumnsRenamed({k: f"__{k}" for k in PING}), condition


def candidate_legs(
    pings: DataFrame, legs: DataFrame, corridor_m: float = K.CORRIDOR_M,
    leg_offset: float = 0.5, cell_m: float = 250.0,
) -> DataFrame:
    """Each ping with each leg of its pattern whose corridor holds it.

    Legs are spread over the grid cells their corridor touches and joined on
    (pid, cell): a ping is compared with the few legs around it instead of the
    whole pattern, and a busy pattern is spread over its cells.
    """
    pad, half_diagonal = F.lit(corridor_m), cell_m * 0.7072
    low = lambda a, b: geo.cell(F.least(F.col(a), F.col(b)) - pad, cell_m)
    high = lambda a, b: geo.cell(F.greatest(F.col(a), F.col(b)) + pad, cell_m)
    centre = lambda c: (F.col(c) + 0.5) * cell_m
    spread = (
        legs.select(
            "pid", "segments", "x0", "y0", "x1", "y1",
            F.explode(F.sequence(low("x0", "x1"), high("x0", "x1"))).alias("__cx"),
        )
        .select("*", F.explode(F.sequence(low("y0", "y1"), high("y0", "y1"))).alias("__cy"))
        # A long diagonal leg touches few of the cells in its box.
        .filter(
            geo.distance_to_leg(centre("__cx"), centre("__cy"), "x0", "y0", "x1", "y1")
            <= corridor_m + half_diagonal
        )
    )
    located = pings.withColumns({"__cx": geo.cell("x_m", cell_m), "__cy": geo.cell("y_m", cell_m)})
    near = located.join(spread, ["pid", "__cx", "__cy"]).filter(
        geo.distance_to_leg("x_m", "y_m", "x0", "y0", "x1", "y1") <= corridor_m
    )
    return near.withColumn("seg_combined", F.col("segments") + F.lit(leg_offset)).drop(
        "__cx", "__cy", "x0", "y0", "x1", "y1", "segments"
    )


def off_route(pings: DataFrame, candidates: DataFrame) -> DataFrame:
    """Pings with no candidate leg."""
    near, same = _beside(candidates.select(*PING).distinct())
    return pings.join(near, same, "left_anti")


def first_candidate(candidates: DataFrame) -> DataFrame:
    """The earliest leg of each ping, without regard to the other pings of its trip."""
    return candidates.groupBy(*PING).agg(F.min("seg_combined").alias("seg_combined"))


#: Pings that are walked together; a trip of more is cut, whatever its length.
CHUNK = 256
#: Chunks, or groups of chunks, that are put together at once.
FAN_IN = 64


def greedy_positions(candidates: DataFrame, chunk: int = CHUNK, bucket: str = "hour") -> DataFrame:
    """Walk a trip's pings by time; each takes the first of its positions beyond the last one taken.

    Returns the placed pings' keys with ``seg_combined``. A trip of at most ``chunk`` pings is one fold. Where a key holds more
    (one vehicle id for a fleet), see ``_walk_in_chunks``; candidates are staged, as their numbers decide which it is.
    """
    pings = staged(candidates.select(*PING, "seg_combined").groupBy(*PING).agg(F.collect_set("seg_combined").alias("__at")))
    long = pings.groupBy(*TRIP).agg(F.count(F.lit(1)).alias("__n")).where(F.col("__n") > chunk).select(*TRIP)
    if not long.head(1):
        return _walk(pings, TRIP, F.lit(0.0))
    short = pings.join(long, list(TRIP), "left_anti")
    return _walk(short, TRIP, F.lit(0.0)).unionByName(_walk_in_chunks(pings.join(long, list(TRIP)), chunk, bucket))


def _pings(df: DataFrame, keys: Sequence[str], *more: Column) -> DataFrame:
    """One row for each group, its pings by time."""
    return df.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct("data_time", "ping_id", "__at"))).alias("__pings"), *more)


def _following(ping: Column, at: Column) -> Column:
    return F.array_min(F.filter(ping["__at"], lambda p: p > at))


def _walk(df: DataFrame, keys: Sequence[str], start: Column, *more: Column) -> DataFrame:
    """The fold itself. Positions taken grow strictly, so its list is no longer than the pattern has legs."""
    time, ident = (df.schema[c].dataType.simpleString() for c in ("data_time", "ping_id"))
    groups = _pings(df, keys, *more)
    none = F.array().cast(f"array<struct<data_time:{time},ping_id:{ident},seg_combined:double>>")

    def step(acc: Column, ping: Column) -> Column:
        following = _following(ping, acc["at"])
        taken = F.struct(
            ping["data_time"].alias("data_time"), ping["ping_id"].alias("ping_id"), following.alias("seg_combined")
        )
        return F.when(
            following.isNotNull(),
            F.struct(following.alias("at"), F.concat(acc["taken"], F.array(taken)).alias("taken")),
        ).otherwise(acc)

    placed = F.aggregate("__pings", F.struct(start.alias("at"), none.alias("taken")), step, lambda acc: acc["taken"])
    return groups.select(*TRIP, F.inline(placed))


def _walk_in_chunks(pings: DataFrame, chunk: int, bucket: str) -> DataFrame:
    """The same walk over trips of any length, by an associative scan.

    Pings are numbered by time and cut into chunks. What a chunk does to a position it is entered with is a step function: one
    value for each position its trip can be at, so no longer than the pattern has legs. Functions of neighbouring chunks
    are put together, level by level, until a trip is one; then positions go down the levels again, and every chunk is walked
    from the position it is entered with. No row holds more than a chunk, ``FAN_IN`` functions or a pattern's legs.
    """
    trip = list(TRIP)
    # Numbering needs a time; pings without one come first, as they do in a sort.
    timed = pings.withColumn("__time", F.coalesce("data_time", F.lit("0001-01-01").cast("timestamp_ntz")))
    numbered = bucketed_row_number(timed, trip, "__time", ("ping_id",), "__rn", bucket).drop("__time")
    # Both the functions and the last walk read the chunks.
    chunks = staged(numbered.withColumn("__c0", F.floor((F.col("__rn") - 1) / chunk)).drop("__rn"))
    places = chunks.select(*trip, F.explode("__at").alias("p")).groupBy(*trip).agg(
        F.array_sort(F.array_union(F.array(F.lit(0.0)), F.collect_set("p"))).alias("__places")
    )

    def entered(at: Column) -> Column:
        return F.aggregate("__pings", at, lambda acc, ping: F.coalesce(_following(ping, acc), acc))

    functions = _pings(chunks, [*trip, "__c0"]).join(places, trip)
    level = staged(functions.select(*trip, "__c0", "__places", F.transform("__places", entered).alias("__to")))
    levels = [level]
    while level.agg(F.max(f"__c{len(levels) - 1}")).first()[0]:
        n = len(levels)
        own, above = f"__c{n - 1}", f"__c{n}"
        parts = level.withColumn(above, F.floor(F.col(own) / FAN_IN)).groupBy(*trip, above).agg(
            F.array_sort(F.collect_list(F.struct(own, "__to"))).alias("__parts"), F.first("__places").alias("__places")
        )
        level = staged(parts.select(*trip, above, "__places", F.transform("__places", _through("__parts")).alias("__to")))
        levels.append(level)
    # The topmost level has one function a trip, entered at the start.
    starts = levels[-1].select(*trip, F.col(f"__c{len(levels) - 1}"), F.lit(0.0).alias("__start"))
    for n in range(len(levels) - 1, 0, -1):
        own, above = f"__c{n - 1}", f"__c{n}"
        parts = levels[n - 1].withColumn(above, F.floor(F.col(own) / FAN_IN)).groupBy(*trip, above).agg(
            F.array_sort(F.collect_list(F.struct(own, "__to"))).alias("__parts"), F.first("__places").alias("__places")
        )
        first = F.struct(F.col("__start").alias("at"), F.array().cast("array<struct<chunk:bigint,start:double>>").alias("starts"))

        def enter(acc: Column, part: Column) -> Column:
            here = F.struct(part[own].alias("chunk"), acc["at"].alias("start"))
            return F.struct(_applied(part["__to"], acc["at"]).alias("at"), F.concat(acc["starts"], F.array(here)).alias("starts"))

        down = parts.join(starts, [*trip, above]).select(
            *trip, F.inline(F.aggregate("__parts", first, enter, lambda acc: acc["starts"]))
        )
        starts = down.select(*trip, F.col("chunk").alias(own), F.col("start").alias("__start"))
    # The start is one value a chunk, whatever aggregate takes it.
    return _walk(chunks.join(starts, [*trip, "__c0"]), [*trip, "__c0"], F.col("__start"), F.min("__start").alias("__start"))


def _applied(function: Column, at: Column) -> Column:
    """The value of a step function given by its values at ``__places``."""
    return F.element_at(function, F.array_position("__places", at).cast("int"))


def _through(parts: str) -> Callable[[Column], Column]:
    """Several functions in a row, as one."""
    return lambda at: F.aggregate(parts, at, lambda acc, part: _applied(part["__to"], acc))


def match_to_legs(
    pings: DataFrame, legs: DataFrame, corridor_m: float = K.CORRIDOR_M, leg_offset: float = 0.5,
) -> DataFrame:
    """Clean pings (with ``x_m, y_m``) to at most one position per ping, strictly growing per trip."""
    placed, same = _beside(greedy_positions(candidate_legs(pings, legs, corridor_m, leg_offset)))
    return pings.join(placed, same).select(*pings.columns, "seg_combined")


def match_status(pings: DataFrame, matched: DataFrame) -> DataFrame:
    """Per trip: pings in, pings placed and whether it can be interpolated."""
    placed = matched.groupBy(*TRIP).agg(F.count(F.lit(1)).alias("placed"))
    status = (
        F.when(F.col("placed") == 0, "no_match").when(F.col("placed") == 1, "one_match").otherwise("ok")
    )
    return (
        pings.groupBy(*TRIP).agg(F.count(F.lit(1)).alias("pings"))
        .join(placed, list(TRIP), "left")
        .withColumn("placed", F.coalesce("placed", F.lit(0)))
        .withColumn("status", status)
    )
