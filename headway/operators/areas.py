"""Stops and people in areas.

An area is one row: ``community`` and ``parts``, an array of polygons, each an array of rings of
which the first is the outline and the others are holes. Parts of one area do not overlap.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from headway import constants as K
from headway.functions import geo
from headway.functions.measures import per_capita

#: Degrees per grid cell when points meet polygons.
CELL_DEG = 0.01


def _edges(areas: DataFrame) -> DataFrame:
    """One row per edge of all rings of all parts."""
    return areas.select("community", F.explode(geo.ring_edges(F.flatten("parts"))).alias("__e"))


def _cells(areas: DataFrame, cell: float) -> DataFrame:
    """``community, __cx, __cy, __across, __edges``: the grid cells in which some point may lie inside.

    A point is inside if a ray to the right crosses an odd number of edges. An edge is of concern only to
    the rows of cells it reaches through. In a row, edges left of a cell are crossed by no ray from it, edges
    to the right that span the row by every one; ``__across`` counts the latter. What is left goes with the
    cell as ``__edges``: few at the border, none within, so an outline is never copied to the cells it encloses.
    """
    e = lambda f: F.col("__e").getField(f)
    low, high = F.least(e("y0"), e("y1")), F.greatest(e("y0"), e("y1"))
    left, right = F.least(e("x0"), e("x1")), F.greatest(e("x0"), e("x1"))
    slack = cell * 1e-9
    rows = (
        _edges(areas)
        .withColumn("__cy", F.explode(F.sequence(geo.cell(low, cell), geo.cell(high, cell))))
        .withColumn("__spans", (low <= F.col("__cy") * cell - slack) & (high >= (F.col("__cy") + 1) * cell + slack))
        .groupBy("community", "__cy")
        .agg(
            F.collect_list(F.struct(F.col("__e").alias("e"), left.alias("left"), right.alias("right"), "__spans")).alias("__row"),
            F.min(left).alias("__left"), F.max(right).alias("__right"),
        )
    )
    begin, end = F.col("__cx") * cell - slack, (F.col("__cx") + 1) * cell + slack
    beyond = lambda r: (r["left"] > end) & r["__spans"]
    cells = rows.withColumn("__cx", F.explode(F.sequence(geo.cell("__left", cell), geo.cell("__right", cell)))).select(
        "community", "__cx", "__cy", F.size(F.filter("__row", beyond)).alias("__across"),
        F.transform(F.filter("__row", lambda r: (r["right"] >= begin) & ~beyond(r)), lambda r: r["e"]).alias("__edges"),
    )
    return cells.filter((F.size("__edges") > 0) | (F.col("__across") % 2 == 1))


def _inside(x: str | Column, y: str | Column) -> Column:
    return (F.col("__across") + geo.crossings(x, y, "__edges")) % 2 == 1


def _near_cells(areas: DataFrame, cell: float, radius: float) -> DataFrame:
    """``community, __cx, __cy, __near``: the cells within ``radius`` of an edge, with those edges."""
    e = lambda f: F.col("__e").getField(f)
    lo = lambda a, b: geo.cell(F.least(e(a), e(b)) - F.lit(radius), cell)
    hi = lambda a, b: geo.cell(F.greatest(e(a), e(b)) + F.lit(radius), cell)
    centre = lambda c: (F.col(c) + 0.5) * cell
    return (
        _edges(areas)
        .withColumn("__cx", F.explode(F.sequence(lo("x0", "x1"), hi("x0", "x1"))))
        .withColumn("__cy", F.explode(F.sequence(lo("y0", "y1"), hi("y0", "y1"))))
        # A long diagonal edge comes near few of the cells in its box.
        .filter(
            geo.distance_to_leg(centre("__cx"), centre("__cy"), e("x0"), e("y0"), e("x1"), e("y1"))
            <= radius + cell * 0.7072
        )
        .groupBy("community", "__cx", "__cy").agg(F.collect_list("__e").alias("__near"))
    )


def points_in_areas(
    areas: DataFrame, points: DataFrame, x: str = "lon", y: str = "lat", cell: float = CELL_DEG
) -> DataFrame:
    """Point columns with the ``community`` each point lies in.

    Polygons and points meet on grid cells, then ray casting decides. A point in
    no area is absent, a point in two areas appears twice.
    """
    located = points.withColumn("__cx", geo.cell(x, cell)).withColumn("__cy", geo.cell(y, cell))
    return (
        located.join(_cells(areas, cell), ["__cx", "__cy"])
        .filter(_inside(x, y))
        .select("community", *points.columns)
    )


def stops_in_areas(areas: DataFrame, stops: DataFrame, cell: float = CELL_DEG) -> DataFrame:
    """All areas with their stops; an area without stops keeps one row with NULLs."""
    found = points_in_areas(areas, stops, cell=cell)
    return areas.select("community").join(found, "community", "left")


def points_near_areas(
    areas_m: DataFrame, points_m: DataFrame, radius: float, cell: float = 1000.0
) -> DataFrame:
    """Points inside an area or within ``radius`` of its outline; everything in metres."""
    # Where a cell has both, points are tested once, so that none counts twice.
    cells = _cells(areas_m, cell).join(_near_cells(areas_m, cell, radius), ["community", "__cx", "__cy"], "full")
    located = points_m.withColumn("__cx", geo.cell("x_m", cell)).withColumn("__cy", geo.cell("y_m", cell))
    near = F.coalesce(_inside("x_m", "y_m"), F.lit(False)) | F.coalesce(
        geo.distance_to_edges("x_m", "y_m", "__near") <= radius, F.lit(False)
    )
    return located.join(cells, ["__cx", "__cy"]).filter(near).select("community", *points_m.columns)


def area_counts(
    areas: DataFrame, stops: DataFrame, areas_m: DataFrame, radius: float = K.BLOCK_M
) -> DataFrame:
    """Stops per area: strictly inside, and within one block of it.

    ``stops`` carries ``lon, lat`` and ``x_m, y_m``; ``areas_m`` holds the same
    outlines in metres.
    """
    strict = points_in_areas(areas, stops).groupBy("community").agg(F.count(F.lit(1)).alias("n_stops_strict"))
    buffered = points_near_areas(areas_m, stops, radius).groupBy("community").agg(
        F.count(F.lit(1)).alias("n_stops_buffer")
    )
    return (
        areas.select("community")
        .join(strict, "community", "left")
        .join(buffered, "community", "left")
        .na.fill(0, ["n_stops_strict", "n_stops_buffer"])
    )


def project_rings(areas: DataFrame) -> DataFrame:
    """Areas with ring corners in metres, in the same order."""
    corners = (
        areas.select("community", F.posexplode("parts").alias("__part", "__rings"))
        .select("community", "__part", F.posexplode("__rings").alias("__ring", "__points"))
        .select("community", "__part", "__ring", F.posexplode("__points").alias("__i", "__p"))
    )
    metric = geo.with_xy(
        corners.select("community", "__part", "__ring", "__i", F.col("__p.y").alias("lat"), F.col("__p.x").alias("lon"))
    )

    def folded(df: DataFrame, keys: list[str], order: str, value: Column, out: str) -> DataFrame:
        # Corners of one outline, rings of one part, parts of one area: bounded by the shape itself.
        listed = F.array_sort(F.collect_list(F.struct(F.col(order).alias("i"), value.alias("v"))))
        return df.groupBy(*keys).agg(F.transform(listed, lambda s: s["v"]).alias(out))

    points = folded(
        metric, ["community", "__part", "__ring"], "__i", F.struct(F.col("x_m").alias("x"), F.col("y_m").alias("y")), "__points"
    )
    rings = folded(points, ["community", "__part"], "__ring", F.col("__points"), "__rings")
    return folded(rings, ["community"], "__part", F.col("__rings"), "parts")


def area_sizes(areas_m: DataFrame) -> DataFrame:
    """Square metres (holes taken off) and the centroid of the outlines, each part weighing as its outline's area."""
    holes = lambda part: F.aggregate(
        F.slice(part, 2, F.greatest(F.size(part) - 1, F.lit(0))), F.lit(0.0), lambda acc, r: acc + geo.ring_area(r)
    )
    total = lambda body: F.aggregate("parts", F.lit(0.0), lambda acc, part: acc + body(part))
    outline = total(lambda part: geo.ring_area(part[0]))
    centre = lambda axis: total(
        lambda part: F.coalesce(geo.ring_area(part[0]) * geo.ring_centroid(part[0])[axis], F.lit(0.0))
    ) / F.nullif(outline, F.lit(0.0))
    return areas_m.select(
        "community", (outline - total(holes)).alias("area_m2"), centre("x").alias("centroid_x"), centre("y").alias("centroid_y")
    )


def population_by_area(areas: DataFrame, tracts: DataFrame) -> DataFrame:
    """People per area; a tract belongs where its centroid lies, so nobody counts twice."""
    found = points_in_areas(areas, tracts).groupBy("community").agg(F.sum("pop").alias("pop"))
    return areas.select("community").join(found, "community", "left").na.fill(0, ["pop"])


def stops_per_capita(areas: DataFrame, stops: DataFrame, tracts: DataFrame, per: int = 1000) -> DataFrame:
    n = points_in_areas(areas, stops).groupBy("community").agg(F.count(F.lit(1)).alias("n_stops"))
    return (
        population_by_area(areas, tracts)
        .join(n, "community", "left")
        .na.fill(0, ["n_stops"])
        .withColumn("stops_percap", per_capita("n_stops", "pop", per))
    )


def coverage_share(
    areas_m: DataFrame, stops_m: DataFrame, blocks: Sequence[int] = (1, 2, 3, 4),
    block_m: float = K.BLOCK_M, cell_m: float = 100.0,
) -> DataFrame:
    """Share of an area within 1 to n blocks of a stop, estimated on grid cells.

    Each stop marks the cells within reach with its distance and a cell keeps the
    smallest, so no stop is ever paired with another row. Cells count where
    their centre lies in the area.
    """
    reach = max(blocks) * block_m
    span = F.lit(int(reach // cell_m) + 1).cast("long")
    centre = lambda c: (F.col(c) + 0.5) * cell_m
    marked = (
        stops_m.select("x_m", "y_m").distinct()
        .withColumn("__cx", F.explode(F.sequence(geo.cell("x_m", cell_m) - span, geo.cell("x_m", cell_m) + span)))
        .withColumn("__cy", F.explode(F.sequence(geo.cell("y_m", cell_m) - span, geo.cell("y_m", cell_m) + span)))
        .withColumn("__d", geo.distance("x_m", "y_m", centre("__cx"), centre("__cy")))
        .filter(F.col("__d") <= reach)
        .groupBy("__cx", "__cy")
        .agg(F.min("__d").alias("__d"))
    )
    cells = (
        _cells(areas_m, cell_m)
        .filter(_inside(centre("__cx"), centre("__cy")))
        .select("community", "__cx", "__cy")
    )
    shares = [
        (F.count_if(F.col("__d") <= b * block_m) / F.count(F.lit(1))).alias(f"percent_{b}b") for b in blocks
    ]
    return cells.join(marked, ["__cx", "__cy"], "left").groupBy("community").agg(
        F.count(F.lit(1)).alias("cells"), *shares
    )


def _tiled(df: DataFrame, low: str, high: str, tile: float) -> DataFrame:
    """Intervals cut at the borders of tiles of a line, with the tile's number."""
    start, end = F.col("__tile") * tile, (F.col("__tile") + 1) * tile
    spread = df.withColumn("__tile", F.explode(F.sequence(geo.cell(low, tile), geo.cell(high, tile))))
    return spread.withColumns({low: F.greatest(F.col(low), start), high: F.least(F.col(high), end)}).filter(F.col(low) < F.col(high))


def covered_area(
    areas_m: DataFrame, stops_m: DataFrame, blocks: Sequence[int] = (1, 2, 3, 4),
    block_m: float = K.BLOCK_M, step_m: float = 20.0, tile_m: float = 10_000.0,
) -> DataFrame:
    """``community, area_m2, percent_<n>b``: the share of an area within n blocks of a stop, by lengths along lines.

    On each of the lines ``step_m`` apart, an area is some intervals between its edges and what stops reach is the union of
    the chords of their circles; both are exact, and so is what they share. Lines are cut into tiles, so neither a long line
    nor a place full of stops is one task. Halving ``step_m`` halves the error at least.
    """
    step = F.lit(float(step_m))
    line = lambda c: (F.col(c) + 0.5) * step
    e = lambda f: F.col("__e").getField(f)
    first, last = geo.cell(F.least(e("y0"), e("y1")), step_m), geo.cell(F.greatest(e("y0"), e("y1")), step_m)
    crossed = (
        _edges(areas_m).withColumn("__j", F.explode(F.sequence(first, last)))
        .filter((e("y0") > line("__j")) != (e("y1") > line("__j")))
        .select("community", "__j", ((e("x1") - e("x0")) * (line("__j") - e("y0")) / (e("y1") - e("y0")) + e("x0")).alias("__a"))
    )
    # Between the first and the second crossing, the third and the fourth, and so on, lies the area.
    order = W.partitionBy("community", "__j").orderBy("__a")
    spans = crossed.select(
        "community", "__j", "__a", F.lead("__a").over(order).alias("__b"), F.row_number().over(order).alias("__n")
    ).filter("__n % 2 = 1 AND __b > __a").drop("__n")
    spans = _tiled(spans, "__a", "__b", tile_m)
    radii = F.explode(F.array(*[F.struct(F.lit(b).alias("block"), F.lit(b * block_m).alias("radius")) for b in blocks]))
    away = F.abs(line("__j") - F.col("y_m"))
    half = F.sqrt(F.col("__r.radius") * F.col("__r.radius") - away * away)
    chords = (
        stops_m.select("x_m", "y_m").distinct().withColumn("__r", radii)
        .withColumn("__j", F.explode(F.sequence(
            geo.cell(F.col("y_m") - F.col("__r.radius"), step_m), geo.cell(F.col("y_m") + F.col("__r.radius"), step_m)
        )))
        .filter(away < F.col("__r.radius"))
        .select(F.col("__r.block").alias("__block"), "__j", (F.col("x_m") - half).alias("__lo"), (F.col("x_m") + half).alias("__hi"))
    )
    tiled = _tiled(chords, "__lo", "__hi", tile_m)
    along = W.partitionBy("__block", "__j", "__tile").orderBy("__lo", "__hi")
    reached = F.max("__hi").over(along.rowsBetween(W.unboundedPreceding, -1))
    # What a chord adds to those that begin before it.
    unions = tiled.withColumn("__lo", F.greatest(F.col("__lo"), F.coalesce(reached, F.col("__lo")))).filter("__lo < __hi")
    shared = F.greatest(F.lit(0.0), F.least("__b", "__hi") - F.greatest("__a", "__lo"))
    covered = spans.join(unions, ["__j", "__tile"]).groupBy("community", "__block").agg(F.sum(shared).alias("__m"))
    wide = covered.groupBy("community").agg(
        *[F.sum(F.when(F.col("__block") == b, F.col("__m"))).alias(f"__m{b}") for b in blocks]
    )
    size = spans.groupBy("community").agg(F.sum(F.col("__b") - F.col("__a")).alias("__all"))
    return size.join(wide, "community", "left").select(
        "community", (F.col("__all") * step).alias("area_m2"),
        *[(F.coalesce(F.col(f"__m{b}"), F.lit(0.0)) / F.col("__all")).alias(f"percent_{b}b") for b in blocks],
    )


def community_stops(stop_areas: DataFrame, community: str | None = None) -> DataFrame:
    """Stops of one community, or of all."""
    rows = stop_areas.filter(F.col("stop_id").isNotNull())
    if community is not None:
        rows = rows.filter(F.col("community") == community)
    return rows.select("community", "stop_id").distinct()
