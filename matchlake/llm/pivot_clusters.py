"""Clusters around integer centroids, found through a table of distances to fixed pivots (LAESA).

The distances of every vector to a few fixed pivots are worked out and written once. In each round the centroids' distances to the same
pivots bound every distance from below: |d(v, p) - d(c, p)| <= d(v, c). A vector first gets its exact distance to the centroid
with the smallest bound; only centroids whose bound does not exceed the best exact distance so far get an exact integer distance too.

Tasks add up their vectors per cluster before anything is shuffled; the driver gets, per round, the sums and counts of ``k``
clusters, and at the start as many vectors as centroids and candidates for pivots are asked for.

Edge cases: rows whose vector is null, of another length, or holds null or non-finite entries are left out; with fewer vectors than
``k`` every vector is a centroid at first; a null id is kept and never chosen as a first centroid before other ids; rows with
the same id or vector count each; ties go to the smaller number; a centroid without vectors stays; an empty table gives an empty result;
other columns are ignored. Distances must fit 64 bits: an entry of 2^27 or more after scaling is an error.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .scratch import stored
from .vectors import finite, matrix, scaled

LIMIT = 1 << 27
CANDIDATES = 4  # candidates for each pivot


def squared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact squared distances of rows."""
    gap = a - b
    return np.einsum("ij,ij->i", gap, gap)


def far_apart(candidates: np.ndarray, count: int) -> np.ndarray:
    """Pivots: the first candidate, then each time the one farthest from those chosen; copies are not chosen twice."""
    chosen = [0]
    nearest = squared(candidates, candidates[:1])
    while len(chosen) < count and nearest.max() > 0:
        chosen.append(int(nearest.argmax()))
        nearest = np.minimum(nearest, squared(candidates, candidates[chosen[-1]][None]))
    return candidates[chosen]


def to_pivots(x: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    """Exact squared distance of each row to each pivot."""
    return np.column_stack([squared(x, p[None]) for p in pivots])


@dataclass(frozen=True)
class Centroids:
    """Integer centroids with their squared distances to the pivots."""

    x: np.ndarray
    far: np.ndarray

    def nearest(self, x: np.ndarray, far: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
        """Number of and squared distance to the nearest centroid of each row; how many exact distances that took."""
        root, own = np.sqrt(far.astype(float)), np.sqrt(self.far.astype(float))
        low = np.zeros((len(x), len(self.x)))
        for p in range(own.shape[1]):
            np.maximum(low, np.abs(root[:, p, None] - own[None, :, p]), out=low)
        # rounding of the roots must not push a bound above the distance
        low = np.maximum(low - 1e-12 * (root.max(initial=0) + own.max(initial=0)), 0) ** 2
        label = low.argmin(axis=1)
        best = squared(x, self.x[label])
        exact, each = len(x), np.arange(len(x))
        low[each, label] = np.inf
        for j in range(len(self.x)):
            rows = np.flatnonzero(low[:, j] <= best * (1 + 1e-12))
            distance = squared(x[rows], self.x[j][None])
            better = (distance < best[rows]) | ((distance == best[rows]) & (j < label[rows]))
            rows, distance, exact = rows[better], distance[better], exact + len(rows)
            label[rows], best[rows] = j, distance
        return label, best, exact


def pivot_table(vectors: DataFrame, pivots: np.ndarray) -> DataFrame:
    """The rows of (vec_id, x) with their squared distances to the pivots, written once."""

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            x = matrix(batch, "x")
            if np.abs(x).max() >= LIMIT:
                raise OverflowError("an entry of a vector is too large for distances of 64 bits")
            far = to_pivots(x, pivots)
            lists = pa.ListArray.from_arrays(np.arange(0, far.size + 1, far.shape[1], dtype=np.int32), far.ravel())
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), batch.column("x"), lists], ["vec_id", "x", "far"])

    kind = dict(vectors.dtypes)["vec_id"]
    return stored(vectors.mapInArrow(measure, f"vec_id {kind}, x array<long>, far array<long>"), "pivots")


def moved(table: DataFrame, centroids: Centroids) -> np.ndarray:
    """The centroids after one round: floor of the mean of their vectors, exactly."""
    k, dims = centroids.x.shape

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, counts = np.zeros((k, dims), np.int64), np.zeros(k, np.int64)
        for batch in batches:
            if batch.num_rows:
                x = matrix(batch, "x")
                label, _, _ = centroids.nearest(x, matrix(batch, "far"))
                counts += np.bincount(label, minlength=k)
                for j in np.unique(label):
                    sums[j] += x[label == j].sum(axis=0)
        some = np.flatnonzero(counts)
        if len(some):
            yield pa.RecordBatch.from_arrays(
                [pa.array(some.astype(np.int32)), pa.array(counts[some]), pa.array(sums[some].tolist(), pa.list_(pa.int64()))], ["cluster", "n", "sums"])

    parts = table.select("x", "far").mapInArrow(add, "cluster int, n long, sums array<long>")
    by_entry = parts.select("cluster", "n", F.posexplode("sums").alias("entry", "part")).groupBy("cluster", "entry").agg(
        F.sum("part").alias("total"), F.sum("n").alias("n"))
    x = centroids.x.copy()
    for row in by_entry.collect():
        x[row.cluster, row.entry] = row.total // row.n
    return x


def cluster(vectors: DataFrame, k: int = 16, rounds: int = 3, dims: int = 64, scale: int = 64, pivots: int = 8,
            seed: str = "1") -> tuple[DataFrame, np.ndarray]:
    """(vec_id, cluster, distance) of each row of (vec_id, embedding), and the final centroids.

    Entries become integers floor(scale * entry). The first centroids are the ``k`` vectors with the smallest sha256 of ``seed:vec_id``.
    """
    ints = vectors.filter(finite("embedding") & (F.size("embedding") == dims)).select("vec_id", scaled("embedding", scale).alias("x"))
    hashed = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256)
    first = ints.orderBy(hashed.asc_nulls_last(), "x").select("x").limit(max(k, CANDIDATES * pivots)).collect()
    kind = dict(vectors.dtypes)["vec_id"]
    if not first:
        return ints.selectExpr("vec_id", "cast(null as int) as cluster", "cast(null as long) as distance"), np.empty((0, dims), np.int64)
    start = np.array([r.x for r in first], np.int64)
    fixed = far_apart(start, pivots)
    table = pivot_table(ints, fixed)
    x = start[:k]
    for _ in range(rounds):
        x = moved(table, Centroids(x, to_pivots(x, fixed)))
    final = Centroids(x, to_pivots(x, fixed))

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                label, distance, _ = final.nearest(matrix(batch, "x"), matrix(batch, "far"))
                yield pa.RecordBatch.from_arrays([batch.column("vec_id"), pa.array(label.astype(np.int32)), pa.array(distance)], ["vec_id", "cluster", "distance"])

    return stored(table.mapInArrow(assign, f"vec_id {kind}, cluster int, distance long"), "clusters"), x


def with_inertia(assigned: DataFrame, centroids: np.ndarray) -> DataFrame:
    """Adds the summed distances of each cluster and of all, and a digest of each centroid. One row per cluster is collected."""
    spark = assigned.sparkSession
    sums = {r.cluster: r.inertia for r in assigned.groupBy("cluster").agg(F.sum("distance").alias("inertia")).collect()}
    rows = [(c, total, sum(sums.values()), ",".join(map(str, centroids[c].tolist()))) for c, total in sorted(sums.items())]
    named = spark.createDataFrame(rows, "cluster int, cluster_inertia long, inertia long, centroid string")
    return assigned.join(F.broadcast(named), "cluster").select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", F.sha2("centroid", 256).alias("centroid_sha256"))
