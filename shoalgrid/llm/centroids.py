"""Centroid clustering of integer vectors, where each assignment is a bisector tournament.

Vectors keep ``DIM`` components, each made the integer ``floor(1024 * x)``. For every ordered pair of
centroids ``i < j`` the squared distances differ by ``2 x.(c_j - c_i) + |c_i|^2 - |c_j|^2``: an integer
normal and threshold, worked out once per round on the driver (``k * (k - 1) / 2`` of them, ``k`` = 8).
A vector's tournament holds the winner ``w`` (first centroid 0) against ``j = 1 .. k-1``: ``j`` takes over
only if the difference is above zero, so a zero keeps the smaller number. The winner's distance is then
worked out exactly. All tests of a batch are one integer matrix product in a Python worker.

A round is one pass over the staged vectors: the tournament, then Spark sums every component per
cluster (partial sums per task, so a cluster with a third of all rows is no hot group) and counts;
the driver gets ``k`` rows of sums and makes each non-empty centroid ``floor(sum / count)`` exactly.

Defined cases: rows whose vector is null, has another number of components than ``DIM``, or a null or
non-finite component take no part and give no row; so do vectors with a component of magnitude
``2**27`` or more after scaling (their squared distances would not fit a long). A null vec_id takes
part (its row carries the null), but is never a first centroid. Repeated rows are vectors of their own
each; equal hashes of repeated ids are ordered by the vector. Fewer kept vectors than ``k``: as many
centroids as vectors. No vector: an empty result. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shoalgrid.llm.common import map_arrow, stage

DIM = 64
K = 8
ROUNDS = 10
SEED_PREFIX = "3:"
SCALE = 1024
#: Largest magnitude of a scaled component: 64 * (2 * 2**27)**2 = 2**62 fits a long.
BOUND = 1 << 27

_ASSIGNED = "vec_id long, vector array<long>, cluster int, distance long"


def integer_vectors(embeddings: DataFrame, column: str = "embedding") -> DataFrame:
    """(vec_id, vector) of the kept rows, components ``floor(1024 * x)`` as longs."""
    x = F.col(column)
    scaled = F.transform(x, lambda v: F.floor(v.cast("double") * SCALE))
    fine = (x.isNotNull() & (F.size(x) == DIM)
            & F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v.cast("double") * SCALE) < BOUND)))
    kept = embeddings.select(F.col("vec_id").cast("long").alias("vec_id"), F.when(fine, scaled).alias("vector"))
    return kept.where(F.col("vector").isNotNull())


def tournament(vectors: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Cluster and squared distance of each row of ``vectors`` (int64) by k - 1 sign tests."""
    k = len(centroids)
    norms = (centroids * centroids).sum(axis=1)
    pairs = [(i, j) for i in range(k) for j in range(i + 1, k)]
    if not pairs:
        winner = np.zeros(len(vectors), dtype=np.int64)
    else:
        normals = np.stack([2 * (centroids[j] - centroids[i]) for i, j in pairs], axis=1)
        thresholds = np.array([norms[i] - norms[j] for i, j in pairs], dtype=np.int64)
        # d[i, j] > 0 means centroid j is strictly nearer than centroid i.
        sides = vectors @ normals + thresholds
        slot = {pair: n for n, pair in enumerate(pairs)}
        winner = np.zeros(len(vectors), dtype=np.int64)
        rows = np.arange(len(vectors))
        for j in range(1, k):
            columns = np.array([slot[(i, j)] for i in range(j)])
            nearer = sides[rows, columns[winner]] > 0
            winner = np.where(nearer, j, winner)
    gap = vectors - centroids[winner]
    return winner, (gap * gap).sum(axis=1)


def _assign(centroids: np.ndarray):
    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vectors = batch.column("vector")
            flat = np.asarray(vectors.flatten(), dtype=np.int64).reshape(len(vectors), DIM) if len(vectors) else np.zeros((0, DIM), np.int64)
            winner, distance = tournament(flat, centroids)
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id"), vectors, pa.array(winner.astype(np.int32)), pa.array(distance.astype(np.int64))],
                ["vec_id", "vector", "cluster", "distance"])
    return step


def first_centroids(vectors: DataFrame, k: int = K) -> np.ndarray:
    """The ``k`` vectors with the least sha256 of ``3:<vec_id>``, in that order (ties by the vector)."""
    key = F.sha2(F.concat(F.lit(SEED_PREFIX), F.col("vec_id").cast("string")), 256)
    rows = vectors.where(F.col("vec_id").isNotNull()).select(key.alias("h"), "vector").orderBy("h", "vector").limit(k).collect()
    return np.array([r.vector for r in rows], dtype=np.int64).reshape(len(rows), DIM)


def assign(vectors: DataFrame, centroids: np.ndarray) -> DataFrame:
    return map_arrow(vectors, _assign(centroids), _ASSIGNED)


def update(assigned: DataFrame, centroids: np.ndarray) -> np.ndarray:
    """Every non-empty centroid becomes the exact componentwise floor of its vectors' mean."""
    sums = [F.sum(F.col("vector")[i].cast("decimal(38,0)")).alias(f"s{i}") for i in range(DIM)]
    rows = assigned.groupBy("cluster").agg(F.count("*").alias("n"), *sums).collect()
    new = centroids.copy()
    for r in rows:
        new[r.cluster] = [int(r[f"s{i}"]) // r.n for i in range(DIM)]
    return new


def centroid_digest(centroid: np.ndarray) -> str:
    return hashlib.sha256(",".join(str(int(v)) for v in centroid).encode()).hexdigest()


def cluster(embeddings: DataFrame, column: str = "embedding", k: int = K, rounds: int = ROUNDS) -> DataFrame:
    """Per kept vector: vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256 (see the module)."""
    spark = embeddings.sparkSession
    vectors = stage(integer_vectors(embeddings, column), "int-vectors")
    centroids = first_centroids(vectors, k)
    if len(centroids) == 0:
        return spark.createDataFrame([], "vec_id long, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string")
    for _ in range(rounds):
        centroids = update(assign(vectors, centroids), centroids)
    assigned = stage(assign(vectors, centroids).drop("vector"), "assigned")
    per = assigned.groupBy("cluster").agg(F.sum("distance").alias("cluster_inertia")).collect()
    total = sum(int(r.cluster_inertia) for r in per)
    facts = spark.createDataFrame(
        [(r.cluster, int(r.cluster_inertia), centroid_digest(centroids[r.cluster])) for r in per],
        "cluster int, cluster_inertia long, centroid_sha256 string")
    # At most k rows, so the broadcast is bounded by the parameter.
    return (assigned.join(F.broadcast(facts), "cluster")
            .select("vec_id", "cluster", "distance", "cluster_inertia", F.lit(total).cast("long").alias("inertia"), "centroid_sha256"))
