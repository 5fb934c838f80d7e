"""Areas against areas: which of them meet, and unions of adjoining ones.

Areas are rows as in ``areas``. Nothing here compares whole outlines: edges meet edges on grid cells.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from headway.functions import geo
from headway.operators.areas import CELL_DEG, points_in_areas
from headway.session import staged

#: Degrees that count as one place when outlines are put together.
SNAP_DEG = 1e-9


def _edges(areas: DataFrame, key: str) -> DataFrame:
    return areas.select(F.col(key), F.inline(geo.ring_edges(F.flatten("parts"))))


def _on_cells(edges: DataFrame, cell: float) -> DataFrame:
    """Edges with the grid cells they touch, a little more than that."""
    low = lambda a, b: geo.cell(F.least(a, b), cell)
    high = lambda a, b: geo.cell(F.greatest(a, b), cell)
    centre = lambda c: (F.col(c) + 0.5) * cell
    return (
        edges.withColumn("__cx", F.explode(F.sequence(low("x0", "x1"), high("x0", "x1"))))
        .withColumn("__cy", F.explode(F.sequence(low("y0", "y1"), high("y0", "y1"))))
        # A long diagonal edge touches few of the cells in its box.
        .filter(geo.distance_to_leg(centre("__cx"), centre("__cy"), "x0", "y0", "x1", "y1") <= cell * 0.7072)
    )


def segments_meet(a: str, b: str) -> Column:
    """Whether two segments, columns with these prefixes, share a point; touching counts."""
    c = lambda side, name: F.col(f"{side}{name}")
    cross = lambda side, px, py: (c(side, "x1") - c(side, "x0")) * (py - c(side, "y0")) - (c(side, "y1") - c(side, "y0")) * (px - c(side, "x0"))
    apart = lambda side, other: F.signum(cross(side, c(other, "x0"), c(other, "y0"))) * F.signum(cross(side, c(other, "x1"), c(other, "y1"))) > 0

    def boxes(v: str) -> Column:
        low = lambda s: F.least(c(s, f"{v}0"), c(s, f"{v}1"))
        high = lambda s: F.greatest(c(s, f"{v}0"), c(s, f"{v}1"))
        return (low(a) <= high(b)) & (low(b) <= high(a))

    return boxes("x") & boxes("y") & ~apart(a, b) & ~apart(b, a)


def _outline_points(areas: DataFrame, key: str) -> DataFrame:
    """The first point of each part's outline."""
    first = F.col("__part")[0][0]
    return areas.select(F.col(key), F.explode("parts").alias("__part")).select(key, first["x"].alias("lon"), first["y"].alias("lat"))


def intersecting(
    left: DataFrame, right: DataFrame, left_key: str = "community", right_key: str = "geoid", cell: float = CELL_DEG
) -> DataFrame:
    """``left_key, right_key``: pairs of areas that share a point, holes and several parts included.

    Two areas meet if edges of theirs do, or else if a part of one lies within the other; then so does the first point of
    its outline. Edges meet on grid cells, points by ray casting, so no pair of areas is formed that is not near.
    """
    names = ["x0", "y0", "x1", "y1"]
    a = _on_cells(_edges(left.withColumnRenamed(left_key, "__l"), "__l"), cell).withColumnsRenamed({n: f"a{n}" for n in names})
    b = _on_cells(_edges(right.withColumnRenamed(right_key, "__r"), "__r"), cell).withColumnsRenamed({n: f"b{n}" for n in names})
    crossing = a.join(b, ["__cx", "__cy"]).filter(segments_meet("a", "b")).select("__l", "__r").distinct()
    as_areas = lambda df, key: df.select(F.col(key).alias("community"), "parts")
    right_in_left = points_in_areas(as_areas(left, left_key), _outline_points(right, right_key), cell=cell)
    left_in_right = points_in_areas(as_areas(right, right_key), _outline_points(left.withColumnRenamed(left_key, "__l"), "__l"), cell=cell)
    pairs = crossing.union(right_in_left.select("community", right_key)).union(left_in_right.select("__l", "community"))
    return pairs.distinct().toDF(left_key, right_key)


def population_by_overlap(areas: DataFrame, tract_areas: DataFrame, cell: float = CELL_DEG) -> DataFrame:
    """People of all tracts that touch an area: a tract on a border counts for each side."""
    pairs = intersecting(areas, tract_areas, cell=cell)
    sums = pairs.join(tract_areas.select("geoid", "pop"), "geoid").groupBy("community").agg(
        F.sum("pop").alias("pop"), F.count(F.lit(1)).alias("tracts")
    )
    return areas.select("community").join(sums, "community", "left").na.fill(0, ["pop", "tracts"])


# --- unions -------------------------------------------------------------------


def _border(areas: DataFrame, key: str, snap: float, cell: float) -> DataFrame:
    """``key, x0, y0, x1, y1``: the borders of the unions as directed pieces, the inside on their left, in units of ``snap``.

    Pieces between neighbours run both ways and cancel. A corner on an edge of a neighbour cuts that edge first.
    """
    at = lambda p, v: F.round(p[v] / F.lit(snap)).cast("long").alias(v)
    rings = areas.select(key, F.explode("parts").alias("__part")).select(key, F.posexplode("__part").alias("__n", "__ring"))
    snapped = F.transform("__ring", lambda p: F.struct(at(p, "x"), at(p, "y")))
    # Around the first point, so that products fit: outlines are small beside their place.
    local = F.transform("__ring", lambda p: F.struct((p["x"] - F.col("__ring")[0]["x"]).alias("x"), (p["y"] - F.col("__ring")[0]["y"]).alias("y")))
    turns_left = geo.signed_area(local) > 0
    rings = rings.withColumn("__ring", snapped).withColumn(
        "__ring", F.when(turns_left == (F.col("__n") == 0), F.col("__ring")).otherwise(F.reverse("__ring"))
    )
    edges = rings.select(key, F.inline(geo.ring_edges(F.array("__ring")))).filter("x0 <> x1 OR y0 <> y1")
    edges = staged(edges.withColumn("__e", F.xxhash64(key, "x0", "y0", "x1", "y1")).distinct())
    # Corners on the inside of an edge.
    size = max(1.0, cell / snap)
    spread = _on_cells(edges, size)
    corners = edges.select(key, F.col("x0").alias("x"), F.col("y0").alias("y")).distinct()
    located = corners.withColumn("__cx", geo.cell("x", size)).withColumn("__cy", geo.cell("y", size))
    dx, dy = F.col("x1") - F.col("x0"), F.col("y1") - F.col("y0")
    ax, ay = F.col("x") - F.col("x0"), F.col("y") - F.col("y0")
    along = ax * dx + ay * dy
    on = (dx * ay == dy * ax) & (along > 0) & (along < dx * dx + dy * dy)
    cuts = spread.join(located, [key, "__cx", "__cy"]).filter(on).select(key, "__e", "x0", "y0", "x1", "y1", along.alias("__at"), "x", "y")
    ends = edges.select(key, "__e", "x0", "y0", "x1", "y1", F.lit(0).cast("long").alias("__at"), F.col("x0").alias("x"), F.col("y0").alias("y"))
    order = W.partitionBy(key, "__e", "x0", "y0", "x1", "y1").orderBy("__at")
    pieces = cuts.distinct().unionByName(ends).select(
        key, F.col("x").alias("a"), F.col("y").alias("b"),
        F.coalesce(F.lead("x").over(order), "x1").alias("c"), F.coalesce(F.lead("y").over(order), "y1").alias("d"),
    )
    forward = (F.col("a") < F.col("c")) | ((F.col("a") == F.col("c")) & (F.col("b") < F.col("d")))
    pick = lambda yes, no: F.when(forward, F.col(yes)).otherwise(F.col(no))
    net = pieces.select(
        key, pick("a", "c").alias("a"), pick("b", "d").alias("b"), pick("c", "a").alias("c"), pick("d", "b").alias("d"),
        F.when(forward, 1).otherwise(-1).alias("__way"),
    ).groupBy(key, "a", "b", "c", "d").agg(F.sum("__way").alias("__way")).filter("__way <> 0")
    way = lambda yes, no: F.when(F.col("__way") > 0, F.col(yes)).otherwise(F.col(no))
    return net.select(key, way("a", "c").alias("x0"), way("b", "d").alias("y0"), way("c", "a").alias("x1"), way("d", "b").alias("y1"))


def _successors(border: DataFrame, key: str) -> DataFrame:
    """Each piece with the one that follows it: at a corner where several meet, the one farthest to the left."""
    pieces = border.withColumn("__id", F.struct("x0", "y0", "x1", "y1"))
    following = border.select(key, F.col("x0").alias("x1"), F.col("y0").alias("y1"), F.col("x1").alias("x2"), F.col("y1").alias("y2"))
    ix, iy = F.col("x1") - F.col("x0"), F.col("y1") - F.col("y0")
    ox, oy = F.col("x2") - F.col("x1"), F.col("y2") - F.col("y1")
    turn = F.atan2((ix * oy - iy * ox).cast("double"), (ix * ox + iy * oy).cast("double"))
    chosen = pieces.join(following, [key, "x1", "y1"]).groupBy(key, "__id").agg(
        F.max_by(F.struct(F.col("x1").alias("x0"), F.col("y1").alias("y0"), F.col("x2").alias("x1"), F.col("y2").alias("y1")), turn).alias("__next")
    )
    return staged(chosen)


def _ranked(links: DataFrame, key: str) -> DataFrame:
    """``key, __id, __first, __rank``: for each piece its ring's least piece and the steps to there, by doubling: as many rounds
    as the logarithm of the longest ring's pieces, none of which brings a ring together.
    """
    start = links.select(key, "__id", F.col("__next").alias("__to"), F.least("__id", "__next").alias("__first"))
    rows = staged(start)
    while True:
        there = rows.select(F.col(key).alias("__k"), F.col("__id").alias("__j"), F.col("__to").alias("__far"), F.col("__first").alias("__other"))
        new = rows.join(there, (F.col(key) == F.col("__k")) & (F.col("__to") == F.col("__j"))).select(
            key, "__id", F.col("__far").alias("__to"), F.least("__first", "__other").alias("__new"), "__first"
        )
        new = staged(new)
        changed = bool(new.filter("__new <> __first").head(1))
        rows = new.select(key, "__id", "__to", F.col("__new").alias("__first"))
        if not changed:
            break
    first = rows.select(key, "__id", "__first")
    # Steps to the piece before the ring's first one: the chain ends there.
    last = F.col("__next") == F.col("__first")
    chain = staged(links.join(first, [key, "__id"]).select(
        key, "__id", "__first", F.when(~last, F.col("__next")).alias("__to"), F.when(last, 0).otherwise(1).cast("long").alias("__steps")
    ))
    while chain.filter("__to IS NOT NULL").head(1):
        there = chain.select(F.col(key).alias("__k"), F.col("__id").alias("__j"), F.col("__to").alias("__far"), F.col("__steps").alias("__more"))
        chain = staged(chain.join(there, (F.col(key) == F.col("__k")) & (F.col("__to") == F.col("__j")), "left").select(
            key, "__id", "__first", F.col("__far").alias("__to"), (F.col("__steps") + F.coalesce("__more", F.lit(0))).alias("__steps")
        ))
    return chain.select(key, "__id", "__first", (-F.col("__steps")).alias("__rank"))


def dissolve(areas: DataFrame, key: str, snap: float = SNAP_DEG, cell: float = CELL_DEG) -> DataFrame:
    """``key, parts``: the union of all areas of a key, one row each.

    Areas of a key may adjoin but not overlap (equal ones count once). Borders between them cancel; what is left is stitched into
    rings, without corners that do not turn. Outlines run to the left, holes to the right, and a hole goes with the smallest
    outline around it.
    """
    keyed = areas.select(F.col(key).alias("__key"), "parts").filter(F.col(key).isNotNull())
    links = _successors(_border(keyed, "__key", snap, cell), "__key")
    id_, to = F.col("__id"), F.col("__next")
    straight = (id_["x1"] - id_["x0"]) * (to["y1"] - to["y0"]) == (id_["y1"] - id_["y0"]) * (to["x1"] - to["x0"])
    ranked = _ranked(links, "__key").join(links, ["__key", "__id"]).withColumn("__straight", straight)
    # A piece stands for the corner at its end. Corners of one ring: bounded by the shape itself.
    corner = F.struct("__rank", (F.col("__id.x1") * snap).alias("x"), (F.col("__id.y1") * snap).alias("y"))
    rings = ranked.filter(~F.col("__straight")).groupBy("__key", "__first").agg(F.array_sort(F.collect_list(corner)).alias("__points"))
    rings = staged(rings.select(
        "__key", "__first", F.transform("__points", lambda p: F.struct(p["x"].alias("x"), p["y"].alias("y"))).alias("ring")
    ).withColumn("area", _local_area("ring")))
    outlines, holes = rings.filter("area > 0"), rings.filter("area < 0")
    # The middle of a hole's first edge, a little inside it, is in the outlines around the hole.
    ids = F.struct("__key", "__first")
    named = outlines.select(ids.alias("community"), F.array(F.array("ring")).alias("parts"), F.col("area").alias("__around"))
    a, b = F.col("ring")[0], F.col("ring")[1]
    points = holes.select(
        F.col("__key").alias("__hole_key"), F.col("__first").alias("__hole"), F.col("ring").alias("__hole_ring"),
        ((a["x"] + b["x"]) / 2).alias("lon"), ((a["y"] + b["y"]) / 2).alias("lat"),
    )
    within = points_in_areas(named, points, cell=cell).filter(F.col("community.__key") == F.col("__hole_key")).join(
        named.select("community", "__around"), "community"
    )
    owned = within.groupBy("__hole_key", "__hole").agg(
        F.min_by("community", "__around").alias("community"), F.first("__hole_ring").alias("ring")
    ).groupBy("community").agg(F.array_sort(F.collect_list("ring")).alias("__holes"))
    parts = outlines.withColumn("community", ids).join(owned, "community", "left").select(
        "__key", "__first", F.concat(F.array("ring"), F.coalesce("__holes", F.array())).alias("part")
    )
    whole = parts.groupBy("__key").agg(F.array_sort(F.collect_list(F.struct("__first", "part"))).alias("__parts"))
    return whole.select(F.col("__key").alias(key), F.transform("__parts", lambda p: p["part"]).alias("parts"))


def _local_area(ring: str) -> Column:
    """Signed area around the first point: places far from the origin lose no digits."""
    first = F.col(ring)[0]
    return geo.signed_area(F.transform(ring, lambda p: F.struct((p["x"] - first["x"]).alias("x"), (p["y"] - first["y"]).alias("y"))))
