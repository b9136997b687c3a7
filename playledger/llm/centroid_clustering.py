"""Centroid clustering of vectors in whole numbers; Ptolemy's inequality spares most exact distances.

For points x, c, p, q of a Euclidean space  d(x,c) d(p,q) >= |d(x,p) d(c,q) - d(x,q) d(c,p)|.  The pivots p and q are
fixed, so d(x,p) and d(x,q) are computed once for each vector and stored beside it; in each round the distances of the
few centroids to the pivots give, for each fixed pair of pivots, a lower bound of d(x,c).  A vector is compared with
the centroids in the order of their bounds until the next bound lies above the best exact distance.  Bounds are floats
rounded down by more than their error; what survives is compared exactly, in 64-bit whole numbers.

Vectors are assigned where they lie.  A task sends one row of sums for each cluster; only the centroids (k times the
dimension) and the pivots reach the driver.
"""
from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import batches_of, stored

#: Vectors (those of least hash) that the pivots are made of.
PIVOT_SAMPLE = 4096
#: Components beyond this make squared distances that don't fit 64 bits.
LARGEST = 1 << 26
#: Many times the relative error of a product of two rounded square roots.
_SLACK = 2.0 ** -46


def whole_vectors(vectors: DataFrame, id_col: str, vec_col: str, dim: int, scale: float) -> DataFrame:
    """(vec_id, v): the vectors of exactly ``dim`` components, none null or non-finite, each floor(scale * x)."""
    x = F.transform(F.col(vec_col), lambda e: e.cast("double"))
    fine = (F.size(x) == dim) & F.forall(x, lambda e: F.coalesce(F.abs(e) < float("inf"), F.lit(False)))
    low = F.transform(x, lambda e: F.floor(e * float(scale)))
    told = F.lit(f"a component beyond {LARGEST} after scaling: squared distances would not fit 64 bits")
    return vectors.where(fine).select(
        F.col(id_col).alias("vec_id"),
        F.when(F.exists(low, lambda e: F.abs(e) > LARGEST), F.raise_error(told).cast("array<int>"))
        .otherwise(low.cast("array<int>")).alias("v"))


def squared(v: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Exact squared distances of the rows of ``v`` to one point, or to as many."""
    d = v - c
    return np.einsum("ij,ij->i", d, d)


def choose_pivots(start: np.ndarray, sample: np.ndarray, rounds: int) -> tuple[np.ndarray, list[tuple[int, int]]]:
    """The first centroids and the centres that ``rounds`` rounds make of them on the sample; each pivot is paired with
    the pivot farthest from it.  A bound is tight where a centroid lies close to a pivot, whatever the other one is."""
    centre = start.copy()
    for _ in range(rounds if len(sample) else 0):
        at = Nearest(centre, start, []).assign(sample, np.zeros((len(sample), 0)))[0]
        for c in np.unique(at):
            own = sample[at == c]
            centre[c] = own.sum(0) // len(own)
    p = np.unique(np.concatenate([start, centre]), axis=0)
    far = [int(squared(p, x).argmax()) for x in p]
    return p, sorted({(min(a, b), max(a, b)) for a, b in enumerate(far) if a != b})


@dataclass
class Nearest:
    """Nearest centroid of vectors whose distances to the pivots are known."""
    centroids: np.ndarray
    pivots: np.ndarray
    pairs: list[tuple[int, int]]

    def bounds(self, near: np.ndarray) -> np.ndarray:
        """Lower bounds of the squared distances of vectors (rows; ``near``: distances to the pivots) to the centroids."""
        low = np.zeros((len(near), len(self.centroids)))
        there = np.sqrt(np.stack([squared(self.centroids, p) for p in self.pivots]).astype(float))
        for p, q in self.pairs:
            gap = np.sqrt(float(squared(self.pivots[p:p + 1], self.pivots[q])[0]))
            one, two = near[:, p, None] * there[q], near[:, q, None] * there[p]
            np.maximum(low, (np.abs(one - two) - _SLACK * (one + two)) / gap, out=low)
        return low * low * (1 - _SLACK)

    def assign(self, v: np.ndarray, near: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
        """(cluster, squared distance) of each vector, and how many distances were computed; of ties the first centroid."""
        rows = np.arange(len(v))
        low = self.bounds(near) if self.pairs else np.zeros((len(v), len(self.centroids)))
        order = np.argsort(low, axis=1, kind="stable")
        best, at, done, left = np.full(len(v), np.iinfo(np.int64).max), np.zeros(len(v), np.int64), 0, rows
        for j in range(len(self.centroids)):
            c = order[left, j]
            left = left[low[left, c] <= best[left]]  # bounds ascend: who drops out stays out
            if not len(left):
                break
            c = order[left, j]
            d = squared(v[left], self.centroids[c])
            done += len(left)
            closer = (d < best[left]) | ((d == best[left]) & (c < at[left]))
            best[left[closer]], at[left[closer]] = d[closer], c[closer]
        return at, best, done


def _matrix(column: pa.Array, dim: int, kind) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(kind).reshape(len(column), dim)


def _pivot_distances(pivots: np.ndarray, dim: int):
    def run(frames):
        for b in batches_of(frames, 4096):
            v = _matrix(b.column(1), dim, np.int64)
            near = np.sqrt(np.stack([squared(v, p) for p in pivots], 1).astype(float)) if b.num_rows else np.zeros((0, len(pivots)))
            ends = pa.array(np.arange(b.num_rows + 1, dtype=np.int32) * len(pivots))
            yield pa.RecordBatch.from_arrays([*b.columns, pa.ListArray.from_arrays(ends, pa.array(near.ravel()))],
                                             names=["vec_id", "v", "near"])

    return run


def _sums(finder: Nearest, dim: int):
    """mapInArrow (v, near): for each cluster one row of a task's count and componentwise sums."""
    def run(frames):
        k = len(finder.centroids)
        n, total = np.zeros(k, np.int64), np.zeros((k, dim), np.int64)
        for b in batches_of(frames, 4096):
            v = _matrix(b.column(0), dim, np.int64)
            at, _, _ = finder.assign(v, _matrix(b.column(1), len(finder.pivots), float))
            n += np.bincount(at, minlength=k)
            np.add.at(total, at, v)
        own = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays([pa.array(own.astype(np.int32)), pa.array(n[own]), pa.array(total[own].tolist(), pa.list_(pa.int64()))],
                                         names=["cluster", "n", "total"])

    return run


def _assigned(finder: Nearest, dim: int):
    def run(frames):
        for b in batches_of(frames, 4096):
            at, d, _ = finder.assign(_matrix(b.column(1), dim, np.int64), _matrix(b.column(2), len(finder.pivots), float))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(at.astype(np.int32)), pa.array(d)],
                                             names=["vec_id", "cluster", "distance"])

    return run


def _next(rows: DataFrame, finder: Nearest, dim: int) -> np.ndarray:
    """The centroids after one round: exact floor(sum / count); an empty one stays."""
    found = rows.select("v", "near").mapInArrow(_sums(finder, dim), "cluster int, n long, total array<long>") \
        .select("cluster", "n", F.posexplode("total").alias("part", "s")) \
        .groupBy("cluster", "part").agg(F.sum(F.col("n").cast("decimal(20,0)")).alias("n"), F.sum(F.col("s").cast("decimal(20,0)")).alias("s"))
    out = finder.centroids.copy()
    for r in found.collect():  # k times dim rows
        out[r.cluster, r.part] = int(r.s) // int(r.n)
    return out


def cluster(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", dim: int = 64, scale: float = 64.0,
            k: int = 16, rounds: int = 3, seed: str = "1:",
            pivot_sample: int = PIVOT_SAMPLE) -> DataFrame:
    """(vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256) for each vector that is kept.

    A vector is kept when it has exactly ``dim`` components, none null or non-finite; its components become
    floor(scale * x).  The first centroids are the ``k`` vectors of least sha256 of ``seed`` and the id (of equal ids,
    the least vector first; null ids last), or all vectors if there are fewer.  ``rounds`` times every vector goes to
    the nearest centroid (squared Euclidean distance; of ties the smaller number) and every centroid that has vectors
    becomes their componentwise floor(sum / count); then the vectors are assigned once more.  Distances and inertias
    are exact; an inertia that doesn't fit a long is null, a component beyond 2^26 after scaling is an error.  Rows
    that repeat are vectors of their own.  Results don't hang on ``pivot_sample``.  No vectors: an empty result.  Other columns are not read."""
    spark = vectors.sparkSession
    v = whole_vectors(vectors, id_col, vec_col, dim, scale)
    kind = v.schema["vec_id"].dataType.simpleString()

    def least(salt: str, many: int) -> np.ndarray:
        rows = v.orderBy(F.sha2(F.concat(F.lit(salt), F.col("vec_id").cast("string")), 256).asc_nulls_last(), "v").limit(many)
        return np.array([r.v for r in rows.select("v").collect()], np.int64).reshape(-1, dim)

    centroids = least(seed, k)
    if not len(centroids):
        return spark.createDataFrame([], f"vec_id {kind}, cluster int, distance long, cluster_inertia long, inertia long, "
                                         "centroid_sha256 string")
    pivots, pairs = choose_pivots(centroids, least("pivot:", pivot_sample), rounds)
    rows = stored(v.mapInArrow(_pivot_distances(pivots, dim), f"vec_id {kind}, v array<int>, near array<double>"), "vectors")
    finder = Nearest(centroids, pivots, pairs)
    for _ in range(rounds):
        finder = Nearest(_next(rows, finder, dim), pivots, pairs)
    out = stored(rows.mapInArrow(_assigned(finder, dim), f"vec_id {kind}, cluster int, distance long"), "assigned")

    inertia = dict.fromkeys(range(len(centroids)), 0)
    for r in out.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(20,0)")).alias("s")).collect():  # k rows
        inertia[r.cluster] = int(r.s)

    def known(values: list, kind: str):
        return F.element_at(F.array(*[F.lit(x).cast(kind) for x in values]), F.col("cluster") + 1)

    def fits(x: int):
        return x if x < 1 << 63 else None

    names = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in finder.centroids.tolist()]
    return out.select("vec_id", "cluster", "distance", known([fits(x) for x in inertia.values()], "long").alias("cluster_inertia"),
                      F.lit(fits(sum(inertia.values()))).cast("long").alias("inertia"), known(names, "string").alias("centroid_sha256"))
