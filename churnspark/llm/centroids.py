"""Centroid clustering: a bisector tournament in integers.

A vector is nearer to centroid ``i`` than to ``j`` by the sign of one linear
form: ``2 (c_j - c_i) . x - (|c_j|^2 - |c_i|^2)`` is at most zero if ``i`` is as
near.  The normals and thresholds of all pairs are made once a round.  A vector
plays a tournament: the first centroid meets the second, the winner the third,
and so on; ``k - 1`` sign tests leave the nearest, zero favours the smaller
number, and only the last one's distance is computed.  All of it is in 64-bit
integers, so the result does not depend on the order of the rows.

Each round is one pass: a task returns at most one row of sums for each
centroid.  The driver holds the ``k`` centroids and nothing else.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from churnspark.llm.common import bounded_batches, written

#: Vectors are multiplied by this before they are rounded down.
SCALE = 256
#: Components beyond this have no exact distances in 64 bits.
LIMIT = 1 << 26
#: Vectors of one tournament, for bounded memory.
ROOM = 1 << 14


class Bisectors:
    """Normals and thresholds between all pairs of centroids, ``k * k`` of them."""

    def __init__(self, centroids: np.ndarray):
        self.centroids = centroids
        norms = (centroids * centroids).sum(1)
        self.normals = 2 * (centroids[None] - centroids[:, None])
        self.thresholds = norms[None] - norms[:, None]

    def winners(self, x: np.ndarray) -> np.ndarray:
        """The number of each vector's nearest centroid, the smaller one of ties."""
        best = np.zeros(len(x), np.int32)
        for j in range(1, len(self.centroids)):
            for i in np.unique(best).tolist():  # the vectors whose winner so far is i meet j
                at = np.flatnonzero(best == i)
                best[at[x[at] @ self.normals[i, j] > self.thresholds[i, j]]] = j
        return best

    def distances(self, x: np.ndarray, best: np.ndarray) -> np.ndarray:
        off = x - self.centroids[best]
        return np.einsum("ij,ij->i", off, off)


def quantised(vectors: DataFrame, id_col: str, vector_col: str, size: int) -> DataFrame:
    """``vec, v``: the vectors of ``size`` finite components, each ``floor(256 x)``, as little-endian 32-bit integers."""
    kind = vectors.schema[id_col].dataType.simpleString()

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            lists = b.column(1)
            right = pc.fill_null(pc.equal(pc.list_value_length(lists), size), False)
            ids, lists = b.column(0).filter(right), lists.filter(right)
            x = lists.flatten().cast(pa.float64()).to_numpy(zero_copy_only=False).reshape(-1, size)  # a null becomes NaN
            fine = np.isfinite(x).all(1)
            q = np.floor(SCALE * x[fine])
            if q.size and np.abs(q).max() > LIMIT:
                raise ValueError(f"a component beyond {LIMIT // SCALE} has no exact 64-bit distance")
            rows = q.astype("<i4")
            yield pa.RecordBatch.from_arrays([ids.filter(pa.array(fine)), pa.array([r.tobytes() for r in rows], pa.binary())],
                                             names=["vec", "v"])

    return vectors.select(F.col(id_col).alias("vec"), F.col(vector_col).alias("x")).mapInArrow(pack, f"vec {kind}, v binary")


def unpacked(v: pa.Array, size: int) -> Iterator[np.ndarray]:
    for at in range(0, len(v), ROOM):
        yield np.frombuffer(b"".join(v[at:at + ROOM].to_pylist()), "<i4").reshape(-1, size).astype(np.int64)


def sums(vectors: DataFrame, centroids: np.ndarray) -> DataFrame:
    """``cluster, n, s``: counts and componentwise sums of the vectors of each centroid that has some."""
    k, size = centroids.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bisectors, total, count = Bisectors(centroids), np.zeros((k, size), np.int64), np.zeros(k, np.int64)
        for b in batches:
            for x in unpacked(b.column(0), size):
                best = bisectors.winners(x)
                count += np.bincount(best, minlength=k)
                for i in np.unique(best).tolist():
                    total[i] += x[best == i].sum(0)
        some = np.flatnonzero(count)
        yield pa.RecordBatch.from_arrays([pa.array(some, pa.int32()), pa.array(count[some]), pa.array(list(total[some]), pa.list_(pa.int64()))],
                                         names=["cluster", "n", "s"])

    parts = vectors.select("v").mapInArrow(run, "cluster int, n long, s array<long>")
    return parts.groupBy("cluster").agg(F.sum("n").alias("n"), F.array(*[F.sum(F.col("s")[i]) for i in range(size)]).alias("s"))


def starts(vectors: DataFrame, k: int, size: int, seed: str) -> np.ndarray:
    """The ``k`` vectors with the smallest SHA-256 of ``seed:id``, in that order, at most as many as there are."""
    name = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec").cast("string")), 256)
    rows = vectors.orderBy(name.asc_nulls_last(), F.hex("v")).limit(k).collect()
    return np.frombuffer(b"".join(bytes(r.v) for r in rows), "<i4").reshape(-1, size).astype(np.int64)


def cluster(vectors: DataFrame, k: int = 40, rounds: int = 5, size: int = 64, seed: str = "2",
            id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """``id, cluster, distance, cluster_inertia, inertia, centroid_sha256`` for every vector that is kept.

    Kept are vectors of exactly ``size`` components, none null, NaN or
    infinite; every row of them counts, repeated ones too, and keeps its id,
    null or not.  Components become ``floor(256 x)``; beyond 2**18 (where 64
    bits would not hold the distances) the operator fails with a message.  The
    start centroids are the ``k`` vectors with the smallest SHA-256 of
    ``seed:id`` (rows without an id last, equal ids by their components), fewer
    if there are fewer.  Each round assigns all vectors and moves every
    non-empty centroid to ``floor(sum / count)``; then they are assigned once
    more.  No kept vectors give no rows.  Other columns are ignored.
    """
    spark = vectors.sparkSession
    bounded_batches(spark)
    kind = vectors.schema[id_col].dataType.simpleString()
    kept = written(quantised(vectors, id_col, vector_col, size), "centroid-vectors")
    centroids = starts(kept, k, size, seed)
    if len(centroids) == 0:
        centroids = np.zeros((1, size), np.int64)  # no vector meets it
    for _ in range(rounds):
        for r in sums(kept, centroids).collect():  # one row for each centroid at most
            centroids[r.cluster] = [s // r.n for s in r.s]

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bisectors = Bisectors(centroids)
        for b in batches:
            best, far = [np.zeros(0, np.int32)], [np.zeros(0, np.int64)]
            for x in unpacked(b.column(1), size):
                best.append(bisectors.winners(x))
                far.append(bisectors.distances(x, best[-1]))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(np.concatenate(best)), pa.array(np.concatenate(far))],
                                             names=["vec", "cluster", "distance"])

    assigned = written(kept.mapInArrow(assign, f"vec {kind}, cluster int, distance long"), "centroid-assigned")
    names = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids.tolist()]
    inertia = {r.cluster: r.d for r in assigned.groupBy("cluster").agg(F.sum("distance").alias("d")).collect()}
    per = [(i, inertia.get(i, 0), sum(inertia.values()), names[i]) for i in range(len(names))]
    table = spark.createDataFrame(per, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return (assigned.join(F.broadcast(table), "cluster")  # k rows
            .select(F.col("vec").alias(id_col), "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"))
