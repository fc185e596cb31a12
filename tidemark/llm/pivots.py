"""Centroid clustering on integer vectors, with Ptolemaic bounds from cached pivot distances.

Each component x becomes ``floor(scale * x)``, so distances, sums and centroids are exact integers.
The first centroids are the k vectors of smallest hash. A round assigns every vector to its nearest
centroid and moves each centroid to the floored mean of its vectors; an empty one stays.

Pivots are the distinct first centroids, in fixed pairs around a ring. The distances of every vector
to the pivots are taken once and stored beside it. For a pair (p, s), Ptolemy's inequality gives
``d(x, c) >= |d(x, p) d(c, s) - d(x, s) d(c, p)| / d(p, s)``; the largest over the pairs bounds the
distance to centroid c from below. The centroid of least bound is measured first. A centroid whose
bound, rounded down by more than all rounding errors, exceeds the best exact distance so far is
passed over; every other one is measured exactly. Bounds never exclude a tie.

Passes over the stored table do the work; the driver holds k centroids and k x dims sums, which
tasks add up before they are shuffled. How much the bounds save depends on the data: README has figures.

A vector that is null, of another length, or holds a null, NaN or infinite component takes no part.
A null id is kept, and hashes as ``<seed>:``. Rows that repeat an id or a vector are vectors each; of
equal hashes the smaller vector comes first. Of equally near centroids the smaller number wins. With
fewer than k vectors there are as many centroids as vectors; an empty table gives an empty table.
Components beyond ``LIMIT`` in size raise an error, since squared distances would leave 64 bits. Extra
columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import pick, stored

LIMIT = 1 << 27
# more than the relative error of a bound: two square roots, two products, a difference and a quotient
SLACK = 2.0**-44
BLOCK = 4096


def lattice(vectors: DataFrame, dims: int = 64, scale: int = 64) -> DataFrame:
    """``(vec_id, point array<int>)`` of the vectors that take part."""
    x = F.col("embedding")
    fits = (F.size(x) == dims) & F.forall(x, lambda c: c.isNotNull() & (F.abs(c.cast("double")) < float("inf")))
    kept = pick(vectors, vec_id="vec_id", embedding="embedding").where(F.coalesce(fits, F.lit(False)))
    wide = kept.select("vec_id", F.transform(x, lambda c: F.floor(c.cast("double") * scale)).alias("wide"))
    small = F.forall("wide", lambda c: (c >= -LIMIT) & (c <= LIMIT))
    return wide.select("vec_id", F.when(small, F.col("wide")).otherwise(F.raise_error(F.lit("a component is too large"))).cast("array<int>").alias("point"))


def first_centroids(points: DataFrame, k: int = 16, seed: int = 1) -> np.ndarray:
    """The k points of smallest hash, in hash order."""
    rank = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("vec_id").cast("string"), F.lit(""))), 256)
    rows = points.select(rank.alias("rank"), "point").orderBy("rank", "point").limit(k).collect()
    return np.array([r.point for r in rows], np.int64)


def squares(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact squared distances between rows of equal place, or of one row to all."""
    gap = a - b
    return np.einsum("ij,ij->i", gap, gap)


def distances(points: np.ndarray, to: np.ndarray) -> np.ndarray:
    """Distances of points to each row of ``to``, correctly rounded but for the last places."""
    return np.sqrt(np.stack([squares(points, t) for t in to], axis=1).astype(np.float64)) if len(to) else np.zeros((len(points), 0))


class Pivots:
    """Distinct points and the pairs of them that bounds are taken from."""

    def __init__(self, centroids: np.ndarray):
        seen = dict.fromkeys(map(tuple, centroids.tolist()))
        self.points = np.array(list(seen), np.int64).reshape(len(seen), -1)
        n = len(self.points)
        ring = [(i, (i + 1) % n) for i in range(n if n > 2 else n - 1)]
        self.left, self.right = (np.array([pair[side] for pair in ring], np.int64) for side in (0, 1))
        self.between = np.sqrt(squares(self.points[self.left], self.points[self.right]).astype(np.float64))

    def bounds(self, cached: np.ndarray, centroids: np.ndarray) -> np.ndarray:
        """Lower bounds on the squared distance of each point to each centroid, rounded down."""
        of_centroid = distances(centroids, self.points)
        out = np.zeros((len(cached), len(centroids)))
        for p, s, apart in zip(self.left, self.right, self.between, strict=True):
            one = cached[:, p, None] * of_centroid[None, :, s]
            other = cached[:, s, None] * of_centroid[None, :, p]
            # each product may be off by its own size times the slack
            low = np.abs(one - other) - (one + other) * SLACK
            np.maximum(out, low / (apart * (1 + SLACK)), out=out)
        return out * out * (1 - SLACK)


def nearest(points: np.ndarray, cached: np.ndarray, centroids: np.ndarray, pivots: Pivots) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Number of the nearest centroid, its squared distance, and how many centroids were measured."""
    low = pivots.bounds(cached, centroids)
    rows = np.arange(len(points))
    best = low.argmin(axis=1)
    least = squares(points, centroids[best])
    measured = np.ones(len(points), np.int64)
    low[rows, best] = np.inf
    for c, centre in enumerate(centroids):
        # an exact distance above 2**53 is rounded up before it is compared
        open_ = np.flatnonzero(low[:, c] <= np.nextafter(least.astype(np.float64), np.inf))
        exact = squares(points[open_], centre)
        measured[open_] += 1
        better = (exact < least[open_]) | ((exact == least[open_]) & (c < best[open_]))
        at = open_[better]
        least[at], best[at] = exact[better], c
    return best, least, measured


def matrix(column: pa.Array, width: int, kind: type) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(kind).reshape(len(column), width)


def blocks(batches: Iterable[pa.RecordBatch], size: int = BLOCK) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, size):
            yield batch.slice(at, size)


def with_pivots(points: DataFrame, pivots: Pivots) -> DataFrame:
    """Adds ``cached``: the distances of each point to the pivots."""
    dims = pivots.points.shape[1]

    def task(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in blocks(batches):
            far = distances(matrix(part.column(1), dims, np.int64), pivots.points)
            ends = np.arange(len(far) + 1, dtype=np.int32) * far.shape[1]
            yield pa.RecordBatch.from_arrays([*part.columns, pa.ListArray.from_arrays(pa.array(ends), pa.array(far.ravel()))], names=["vec_id", "point", "cached"])

    return points.mapInArrow(task, "vec_id long, point array<int>, cached array<double>")


def assign(table: DataFrame, centroids: np.ndarray, pivots: Pivots) -> DataFrame:
    """``(vec_id, cluster, distance, n_measured)`` of every point."""
    dims, n = pivots.points.shape[1], len(pivots.points)

    def task(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in blocks(batches):
            best, least, measured = nearest(matrix(part.column(1), dims, np.int64), matrix(part.column(2), n, np.float64), centroids, pivots)
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(best.astype(np.int32)), pa.array(least), pa.array(measured.astype(np.int32))], names=["vec_id", "cluster", "distance", "n_measured"])

    return table.mapInArrow(task, "vec_id long, cluster int, distance long, n_measured int")


def sums(table: DataFrame, centroids: np.ndarray, pivots: Pivots) -> DataFrame:
    """``(cluster, pos, total, n)``: component sums and counts, added up within each task first."""
    dims, n = pivots.points.shape[1], len(pivots.points)

    def task(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, count = np.zeros((len(centroids), dims), np.int64), np.zeros(len(centroids), np.int64)
        for part in blocks(batches):
            points = matrix(part.column(1), dims, np.int64)
            best, _, _ = nearest(points, matrix(part.column(2), n, np.float64), centroids, pivots)
            order = np.argsort(best, kind="stable")
            held, start = np.unique(best[order], return_index=True)
            total[held] += np.add.reduceat(points[order], start, axis=0)
            count += np.bincount(best, minlength=len(centroids))
        held = np.flatnonzero(count)
        cluster, pos = np.repeat(held, dims), np.tile(np.arange(dims), len(held))
        yield pa.RecordBatch.from_arrays([pa.array(cluster.astype(np.int32)), pa.array(pos.astype(np.int32)), pa.array(total[held].ravel()), pa.array(count[cluster])], names=["cluster", "pos", "total", "n"])

    parts = table.mapInArrow(task, "cluster int, pos int, total long, n long")
    return parts.groupBy("cluster", "pos").agg(F.sum("total").alias("total"), F.sum("n").alias("n"))


def cluster(vectors: DataFrame, k: int = 16, rounds: int = 3, dims: int = 64, scale: int = 64, seed: int = 1) -> DataFrame:
    """``(vec_id, cluster, distance, n_measured, cluster_inertia, inertia, centroid_sha256)`` of every vector that takes part."""
    points = lattice(vectors, dims, scale)
    centroids = first_centroids(points, k, seed)
    if not len(centroids):
        return points.selectExpr("vec_id", "0 AS cluster", "0L AS distance", "0 AS n_measured", "0L AS cluster_inertia", "0L AS inertia", "'' AS centroid_sha256")
    pivots = Pivots(centroids)
    table = stored(with_pivots(points, pivots))
    for _ in range(rounds):
        # k x dims rows
        for r in sums(table, centroids, pivots).collect():
            centroids[r.cluster, r.pos] = r.total // r.n
    assigned = stored(assign(table, centroids, pivots))
    held = {r.cluster: r.inertia for r in assigned.groupBy("cluster").agg(F.sum("distance").alias("inertia")).collect()}
    sha = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids.tolist()]
    look = lambda values: F.get(F.array(*[F.lit(v) for v in values]), F.col("cluster"))
    return assigned.select(
        "*",
        look([held.get(c, 0) for c in range(len(centroids))]).cast("long").alias("cluster_inertia"),
        F.lit(sum(held.values())).cast("long").alias("inertia"),
        look(sha).alias("centroid_sha256"),
    )
