"""Centroid clustering with a vantage-point tree over the centroids.

Vectors are turned into integers, so distances, sums and means are exact. Every round builds a vantage-point tree
over the centroids on the driver, broadcasts it (its size is centroids times components, whatever the table's), and assigns each vector by
a best-first branch-and-bound search of its own: the node with the least possible distance is next, and a search ends when that
exceeds the best found. Bounds come from the triangle inequality in floating point, widened by more than its rounding, and a node at just the
best distance is still visited, so equally near centroids are all met and the smallest number wins. Distances to centroids are
compared as integers. The searches of a batch advance together, a step each, so numpy does the arithmetic.

Tasks add up counts and component sums; only those, a row for each centroid and task, are shuffled, and one row for each
centroid reaches the driver. Vectors are staged once in the shared folder and read by every round.

Defined results: a vector takes part if it has exactly ``components`` components, none null or non-finite; null ids take part and count as
empty text where first centroids are chosen; repeated rows are vectors of their own; equal hashes go by components; with fewer vectors than centroids
wanted there are as many centroids as vectors; an empty table gives an empty result; other columns are ignored. Integers over
2^27 in size are refused, since their distances might not fit 64 bits.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from headway.llm.common import batch_of, mapped
from headway.session import staged

COMPONENTS, CENTROIDS, ROUNDS, SEED, UNITS = 64, 8, 10, 3, 1024
#: Centroids in a leaf of the tree, at most.
LEAF = 2
#: Integers beyond would make squared distances overflow.
MOST_UNITS = 1 << 27
#: Numbers (nodes or components) held for a batch of searches.
BATCH_NUMBERS = 1 << 21
#: Relative error of a bound: over that of a square root and two sums.
SLACK = 1e-12


class Node(NamedTuple):
    """Centroids in ``members`` are all compared here: a vantage point, or a leaf's. Children lie within radii of the vantage point."""

    members: tuple[int, ...]
    children: tuple[tuple[int, float, float], ...]  # node, least and greatest distance from the vantage point


def distances(x: np.ndarray, centre: np.ndarray) -> np.ndarray:
    """Squared distances of integer vectors to one centroid, exact."""
    d = x - centre
    return np.einsum("ij,ij->i", d, d)


def tree(centroids: np.ndarray, leaf: int = LEAF) -> list[Node]:
    """A vantage-point tree, root first: the farthest centroid from the mean is the vantage point, the median distance parts the rest."""
    nodes: list[Node] = []

    def build(members: np.ndarray) -> int:
        here = len(nodes)
        nodes.append(Node((), ()))
        if len(members) <= leaf:
            nodes[here] = Node(tuple(members.tolist()), ())
            return here
        points = centroids[members].astype(float)
        at = int(np.argmax(((points - points.mean(axis=0)) ** 2).sum(axis=1)))
        rest = np.delete(members, at)
        away = np.sqrt(distances(centroids[rest], centroids[members[at]]).astype(float))
        order = np.argsort(away, kind="stable")
        half = len(rest) // 2
        children = tuple(
            (build(rest[part]), float(away[part].min()), float(away[part].max())) for part in (order[:half], order[half:]) if len(part)
        )
        nodes[here] = Node((int(members[at]),), children)
        return here

    if len(centroids):
        build(np.arange(len(centroids)))
    return nodes


class Search(NamedTuple):
    centroids: np.ndarray
    nodes: list[Node]

    def nearest(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Number and squared distance of the nearest centroid for each row; the smallest number of equally near ones."""
        step = max(1, BATCH_NUMBERS // max(len(self.nodes), x.shape[1]))
        parts = [self._some(x[i : i + step]) for i in range(0, len(x), step)]
        return tuple(np.concatenate(p) for p in zip(*parts)) if parts else (np.zeros(0, np.int64), np.zeros(0, np.int64))

    def _some(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        rows = len(x)
        best = np.full(rows, np.iinfo(np.int64).max)
        number = np.full(rows, -1)
        # The least possible distance below each node not yet visited; the frontier of every search is a row.
        bound = np.full((rows, len(self.nodes)), np.inf)
        bound[:, 0] = 0.0
        going = np.arange(rows)
        while len(going):
            node = bound[going].argmin(axis=1)
            least = bound[going, node]
            go = least <= np.sqrt(best[going].astype(float)) * (1 + SLACK)  # just as far is not too far
            going, node = going[go & np.isfinite(least)], node[go & np.isfinite(least)]
            for n in np.unique(node).tolist():
                own = going[node == n]
                self._visit(n, own, x, best, number, bound)
        return number, best

    def _visit(self, n: int, own: np.ndarray, x: np.ndarray, best: np.ndarray, number: np.ndarray, bound: np.ndarray) -> None:
        here = bound[own, n]
        bound[own, n] = np.inf
        away = None
        for c in self.nodes[n].members:
            away = distances(x[own], self.centroids[c])
            nearer = (away < best[own]) | ((away == best[own]) & (c < number[own]))
            best[own[nearer]], number[own[nearer]] = away[nearer], c
        for child, low, high in self.nodes[n].children:
            reach = np.sqrt(away.astype(float))
            least = np.maximum(low - reach, reach - high) - SLACK * (reach + high)
            bound[own, child] = np.maximum(here, least)


def integers(table: DataFrame, components: int = COMPONENTS, units: int = UNITS) -> DataFrame:
    """``vec_id, x``: the vectors that take part, each component times ``units`` rounded down."""
    rows = table.select("vec_id", F.col("embedding").cast("array<double>").alias("embedding")).where(
        (F.size("embedding") == components)
        & F.forall("embedding", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    )
    fits = F.forall("embedding", lambda v: F.abs(v) <= float(MOST_UNITS // units))
    checked = F.when(fits, F.col("embedding")).otherwise(F.raise_error(F.lit(f"a component over {MOST_UNITS // units} in size")))
    return rows.select("vec_id", F.transform(checked, lambda v: F.floor(v * units).cast("int")).alias("x"))


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(len(column), -1)


SUM_SCHEMA = pa.schema([("cluster", pa.int32()), ("n", pa.int64()), ("sums", pa.list_(pa.int64()))])


def _adder(search):
    """Tasks that assign their vectors and give counts and sums, a row for each centroid that has any."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        k, d = search.value.centroids.shape
        counts, sums = np.zeros(k, dtype=np.int64), np.zeros((k, d), dtype=np.int64)
        for batch in batches:
            x = _matrix(batch.column("x"))
            cluster, _ = search.value.nearest(x)
            counts += np.bincount(cluster, minlength=k)
            for c in np.unique(cluster).tolist():
                sums[c] += x[cluster == c].sum(axis=0)
        some = np.flatnonzero(counts)
        if len(some):
            yield batch_of(SUM_SCHEMA, cluster=some, n=counts[some], sums=sums[some].tolist())

    return run


def _assigner(search, kind: pa.DataType):
    schema = pa.schema([("vec_id", kind), ("cluster", pa.int32()), ("distance", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cluster, distance = search.value.nearest(_matrix(batch.column("x")))
            yield batch_of(schema, vec_id=batch.column("vec_id"), cluster=cluster, distance=distance)

    return run


def first_centroids(rows: DataFrame, k: int, seed: int) -> np.ndarray:
    """The k vectors whose ids hash least: a top-k, so k rows a task move."""
    rank = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("vec_id").cast("string"), F.lit(""))), 256)
    chosen = rows.select(rank.alias("hash"), "x").orderBy("hash", "x").limit(k).collect()
    return np.array([r["x"] for r in sorted(chosen, key=lambda r: (r["hash"], r["x"]))], dtype=np.int64)


def moved(rows: DataFrame, centroids: np.ndarray) -> np.ndarray:
    """One round: every centroid with vectors becomes their mean, rounded down in each component."""
    sent = rows.sparkSession.sparkContext.broadcast(Search(centroids, tree(centroids)))
    parts = mapped(rows.select("x"), _adder(sent), "cluster int, n long, sums array<bigint>")
    # Added up by component in as wide a type as needed; one row a component and centroid reaches the driver.
    wide = parts.select("cluster", "n", F.posexplode("sums").alias("component", "part")).groupBy("cluster", "component").agg(
        F.sum("n").cast("decimal(38,0)").alias("n"), F.sum(F.col("part").cast("decimal(28,0)")).alias("total")
    )
    out = centroids.copy()
    for r in wide.collect():
        out[r["cluster"], r["component"]] = int(r["total"]) // int(r["n"])
    sent.unpersist()
    return out


def clustered(
    table: DataFrame, k: int = CENTROIDS, rounds: int = ROUNDS, components: int = COMPONENTS, units: int = UNITS, seed: int = SEED
) -> tuple[DataFrame, np.ndarray]:
    """``vec_id, cluster, distance`` after the last round, and the final centroids."""
    rows = staged(integers(table, components, units))
    centroids = first_centroids(rows, k, seed)
    if not len(centroids):
        return rows.select("vec_id", F.lit(0).alias("cluster"), F.lit(0).cast("long").alias("distance")), centroids
    for _ in range(rounds):
        centroids = moved(rows, centroids)
    sent = table.sparkSession.sparkContext.broadcast(Search(centroids, tree(centroids)))
    kind = rows.schema["vec_id"].dataType.simpleString()
    from pyspark.sql.pandas.types import to_arrow_type

    done = mapped(rows, _assigner(sent, to_arrow_type(rows.schema["vec_id"].dataType)), f"vec_id {kind}, cluster int, distance long")
    return done, centroids


def op12_vantage_point_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All vectors of 64 components in 8 clusters after 10 rounds, with what each cluster and all of them add up to."""
    done, centroids = clustered(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
    done = staged(done)
    inertia = {r["cluster"]: r["inertia"] for r in done.groupBy("cluster").agg(F.sum("distance").alias("inertia")).collect()}
    names = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids.tolist()]
    # A row for each centroid, looked up by an array in the plan.
    each = F.array(*[F.lit(inertia.get(c, 0)).cast("long") for c in range(len(names))]) if names else F.array().cast("array<bigint>")
    sums = F.array(*[F.lit(n) for n in names]) if names else F.array().cast("array<string>")
    return done.select(
        "vec_id", "cluster", "distance", F.get(each, F.col("cluster")).alias("cluster_inertia"),
        F.lit(sum(inertia.values())).cast("long").alias("inertia"), F.get(sums, F.col("cluster")).alias("centroid_sha256"),
    )


def _sql(k: int = CENTROIDS, rounds: int = ROUNDS) -> str:
    """The same in SQL, every vector against every centroid, a few tables for each round."""
    parts = [
        """vectors AS MATERIALIZED (
  SELECT row_number() OVER () AS n, vec_id, list_transform(embedding, lambda v: CAST(floor(1024 * CAST(v AS DOUBLE)) AS BIGINT)) AS x FROM embeddings
  WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda v: v IS NOT NULL AND isfinite(v))) = 64
), parts AS MATERIALIZED (
  SELECT n, unnest(range(1, 65)) AS i, unnest(x) AS v FROM vectors
), c0 AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY sha256('3:' || coalesce(CAST(vec_id AS VARCHAR), '')), x) - 1 AS c, x FROM vectors
  QUALIFY c < %d
)""" % k
    ]
    for r in range(rounds + 1):
        parts.append(f"""p{r} AS MATERIALIZED (SELECT c, unnest(range(1, 65)) AS i, unnest(x) AS v FROM c{r}
), a{r} AS MATERIALIZED (
  SELECT n, c, d FROM (SELECT a.n, b.c, sum((a.v - b.v) * (a.v - b.v)) AS d FROM parts a JOIN p{r} b USING (i) GROUP BY a.n, b.c)
  QUALIFY row_number() OVER (PARTITION BY n ORDER BY d, c) = 1
)""")
        if r < rounds:
            parts.append(f"""s{r} AS (SELECT c, i, sum(v) AS s, count(*) AS m FROM a{r} JOIN parts USING (n) GROUP BY c, i
), m{r} AS (SELECT c, list((s - ((s % m) + m) % m) // m ORDER BY i) AS y FROM s{r} GROUP BY c
), c{r + 1} AS MATERIALIZED (SELECT c, coalesce(y, x) AS x FROM c{r} LEFT JOIN m{r} USING (c))""")
    return "WITH " + ", ".join(parts) + f"""
SELECT vec_id, CAST(c AS INTEGER) AS cluster, CAST(d AS BIGINT) AS distance, CAST(sum(d) OVER (PARTITION BY c) AS BIGINT) AS cluster_inertia,
       CAST(sum(d) OVER () AS BIGINT) AS inertia, sha256(array_to_string(k.x, ',')) AS centroid_sha256
FROM a{rounds} JOIN vectors USING (n) JOIN c{rounds} k USING (c)
"""


SQL = _sql()
