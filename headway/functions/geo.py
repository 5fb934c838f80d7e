"""Planar geometry as column expressions.

Points are pairs of doubles, rings are ``array<struct<x,y>>`` and polygons
``array<ring>`` whose first ring is the outline and the others holes.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, functions as F

from headway import constants as K


def _c(x: str | Column) -> Column:
    return F.col(x) if isinstance(x, str) else x


def _tm_terms() -> dict[str, float]:
    f = 1.0 / K.GRS80_INV_F
    e2 = f * (2.0 - f)
    arc = (
        1 - e2 / 4 - 3 * e2**2 / 64 - 5 * e2**3 / 256,
        3 * e2 / 8 + 3 * e2**2 / 32 + 45 * e2**3 / 1024,
        15 * e2**2 / 256 + 45 * e2**3 / 1024,
        35 * e2**3 / 3072,
    )
    p0 = math.radians(K.TM_LAT0_DEG)
    m0 = K.GRS80_A * (
        arc[0] * p0 - arc[1] * math.sin(2 * p0) + arc[2] * math.sin(4 * p0) - arc[3] * math.sin(6 * p0)
    )
    return {"e2": e2, "ep2": e2 / (1 - e2), "arc": arc, "m0": m0}


def with_xy(
    df: DataFrame, lat: str = "lat", lon: str = "lon", x: str = "x_m", y: str = "y_m"
) -> DataFrame:
    """Add EPSG:26971 metres for a longitude/latitude pair.

    The series terms are shared columns in a first projection, so each is
    evaluated once per row.
    """
    t = _tm_terms()
    a0, a2, a4, a6 = t["arc"]
    phi = f"radians(`{lat}`)"
    keep = [f"`{c}`" for c in df.columns if c not in (x, y)]
    terms = df.selectExpr(
        *keep,
        f"tan({phi}) * tan({phi}) AS __t2",
        f"tan({phi}) AS __tan",
        f"{t['ep2']!r}D * pow(cos({phi}), 2) AS __c",
        f"radians(`{lon}` - {K.TM_LON0_DEG!r}D) * cos({phi}) AS __a",
        f"{K.GRS80_A!r}D / sqrt(1 - {t['e2']!r}D * pow(sin({phi}), 2)) AS __n",
        f"{K.GRS80_A!r}D * ({a0!r}D * {phi} - {a2!r}D * sin(2 * {phi}) + {a4!r}D * sin(4 * {phi})"
        f" - {a6!r}D * sin(6 * {phi})) - {t['m0']!r}D AS __m",
    )
    east = (
        "__a + (1 - __t2 + __c) * pow(__a, 3) / 6"
        f" + (5 - 18 * __t2 + __t2 * __t2 + 72 * __c - 58 * {t['ep2']!r}D) * pow(__a, 5) / 120"
    )
    north = (
        "__a * __a / 2 + (5 - __t2 + 9 * __c + 4 * __c * __c) * pow(__a, 4) / 24"
        f" + (61 - 58 * __t2 + __t2 * __t2 + 600 * __c - 330 * {t['ep2']!r}D) * pow(__a, 6) / 720"
    )
    return terms.selectExpr(
        *keep,
        f"{K.TM_FALSE_EASTING!r}D + {K.TM_K0!r}D * __n * ({east}) AS `{x}`",
        f"{K.TM_FALSE_NORTHING!r}D + {K.TM_K0!r}D * (__m + __n * __tan * ({north})) AS `{y}`",
    )


def distance(x0: str | Column, y0: str | Column, x1: str | Column, y1: str | Column) -> Column:
    return F.hypot(_c(x1) - _c(x0), _c(y1) - _c(y0))


def distance_to_leg(
    px: str | Column, py: str | Column,
    x0: str | Column, y0: str | Column, x1: str | Column, y1: str | Column,
) -> Column:
    """Distance of a point to a leg; a leg of zero length acts as a point.

    Written by cases so that no term is repeated inside another: join conditions
    are compiled without sharing, and a nested form outgrows a Java method.
    """
    px, py, x0, y0, x1, y1 = (_c(v) for v in (px, py, x0, y0, x1, y1))
    dx, dy = x1 - x0, y1 - y0
    along = (px - x0) * dx + (py - y0) * dy
    across = F.abs((px - x0) * dy - (py - y0) * dx) / F.nullif(F.hypot(dx, dy), F.lit(0.0))
    return (
        F.when(along <= 0, F.hypot(px - x0, py - y0))
        .when(along >= dx * dx + dy * dy, F.hypot(px - x1, py - y1))
        .otherwise(across)
    )


def ring_edges(rings: str | Column) -> Column:
    """All edges of a polygon as ``array<struct<x0,y0,x1,y1>>``.

    Rings may or may not repeat their first point at the end.
    """
    def edges(ring: Column) -> Column:
        following = F.concat(F.slice(ring, 2, F.size(ring)), F.slice(ring, 1, 1))
        return F.zip_with(
            ring, following,
            lambda p, q: F.struct(
                p["x"].alias("x0"), p["y"].alias("y0"), q["x"].alias("x1"), q["y"].alias("y1")
            ),
        )

    return F.flatten(F.transform(_c(rings), edges))


def crossings(px: str | Column, py: str | Column, edges: str | Column) -> Column:
    """How many edges a ray from the point to the right crosses."""
    px, py = _c(px), _c(py)
    crossed = F.filter(
        _c(edges),
        lambda e: ((e["y0"] > py) != (e["y1"] > py))
        & (px < (e["x1"] - e["x0"]) * (py - e["y0"]) / F.nullif(e["y1"] - e["y0"], F.lit(0.0)) + e["x0"]),
    )
    return F.size(crossed)


def inside(px: str | Column, py: str | Column, edges: str | Column) -> Column:
    """Ray casting: a point is inside when a ray crosses an odd number of edges."""
    return crossings(px, py, edges) % 2 == 1


def distance_to_edges(px: str | Column, py: str | Column, edges: str | Column) -> Column:
    px, py = _c(px), _c(py)
    return F.array_min(
        F.transform(_c(edges), lambda e: distance_to_leg(px, py, e["x0"], e["y0"], e["x1"], e["y1"]))
    )


def ring_area(ring: str | Column) -> Column:
    """Shoelace area of one ring."""
    return F.abs(signed_area(_c(ring)))


def _closed_pairs(ring: Column) -> Column:
    following = F.concat(F.slice(ring, 2, F.size(ring)), F.slice(ring, 1, 1))
    return F.zip_with(
        ring, following,
        lambda p, q: F.struct(
            (p["x"] * q["y"] - q["x"] * p["y"]).alias("cross"),
            (p["x"] + q["x"]).alias("sx"), (p["y"] + q["y"]).alias("sy"),
        ),
    )


def _sum(arr: Column, body) -> Column:
    return F.aggregate(arr, F.lit(0.0), lambda acc, e: acc + body(e))


def signed_area(ring: Column) -> Column:
    """Shoelace area of one ring, positive where it runs to the left."""
    return _sum(_closed_pairs(ring), lambda e: e["cross"]) / 2


def ring_centroid(ring: str | Column) -> Column:
    """Centre of mass of one ring as ``struct<x,y>``."""
    r = _c(ring)
    six_area = F.nullif(signed_area(r) * 6, F.lit(0.0))
    pairs = _closed_pairs(r)
    return F.struct(
        (_sum(pairs, lambda e: e["sx"] * e["cross"]) / six_area).alias("x"),
        (_sum(pairs, lambda e: e["sy"] * e["cross"]) / six_area).alias("y"),
    )


#: Cell of a point without a position. It meets no position, and being a plain
#: value it keeps cells non-null: a nullable key would make the optimizer test the
#: whole projection formula for NULL before every join.
NO_CELL = -(1 << 62)


def cell(v: str | Column, size: float) -> Column:
    """Index of the grid cell a coordinate lies in."""
    return F.coalesce(F.floor(_c(v) / F.lit(float(size))).cast("long"), F.lit(NO_CELL))
