"""Centroid clustering of integer vectors by a tournament of bisecting planes."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabloom.llm.common import in_batches, saved
from tabloom.session import small_table

DIMENSIONS, CENTROIDS, ROUNDS, SEED, SCALE = 64, 40, 5, 2, 256
#: Scaled components beyond this count as this; squared distances of 64 components then stay below 2^60.
LARGEST = 1 << 26
#: Up to this size all sums of a 64-component test are whole doubles, which numpy multiplies faster than integers.
DOUBLES = 1 << 22
BLOCK = 2048


@dataclass(frozen=True)
class Bisectors:
    """Centroids and, for each pair i < j, the plane half way: x is nearer to j where normal . x > threshold."""
    centroids: np.ndarray

    @cached_property
    def normals(self) -> np.ndarray:
        return 2 * (self.centroids[None, :, :] - self.centroids[:, None, :])

    @cached_property
    def thresholds(self) -> np.ndarray:
        squares = (self.centroids ** 2).sum(axis=1)
        return squares[None, :] - squares[:, None]

    def nearest(self, x: np.ndarray) -> np.ndarray:
        """Number of the nearest centroid of each row: k - 1 sign tests, on zero the smaller number stays."""
        kind = np.float64 if max(np.abs(x).max(initial=0), np.abs(self.centroids).max(initial=0)) <= DOUBLES else np.int64
        normals, thresholds, out = self.normals.astype(kind), self.thresholds.astype(kind), np.empty(len(x), dtype=np.int64)
        for at in range(0, len(x), BLOCK):
            part = x[at:at + BLOCK].astype(kind)
            best = np.zeros(len(part), dtype=np.int64)
            for rival in range(1, len(self.centroids)):  # best < rival, so a row of the table holds the pair's plane
                side = np.einsum("nd,nd->n", part, normals[best, rival]) - thresholds[best, rival]
                best[side > 0] = rival
            out[at:at + BLOCK] = best
        return out

    def distances(self, x: np.ndarray, nearest: np.ndarray) -> np.ndarray:
        return ((x - self.centroids[nearest]) ** 2).sum(axis=1)

    def digests(self) -> list[str]:
        """SHA-256 of each centroid's components in decimal, joined by commas."""
        return [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in self.centroids.tolist()]


def integer_vectors(vectors: DataFrame, key: str = "vec_id", vector: str = "embedding", dimensions: int = DIMENSIONS, scale: int = SCALE) -> DataFrame:
    """(id, x): floor(scale * component) of the vectors with ``dimensions`` components, none null or not finite."""
    finite = F.forall("v", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    whole = F.transform("v", lambda c: F.floor(F.greatest(F.lit(-float(LARGEST)), F.least(F.lit(float(LARGEST)), c * float(scale)))).cast("int"))
    rows = vectors.select(F.col(key).cast("long").alias("id"), F.col(vector).cast("array<double>").alias("v"))
    return rows.where((F.size("v") == dimensions) & finite).select("id", whole.alias("x"))


def _matrix(batch: pa.RecordBatch, name: str) -> np.ndarray:
    return batch.column(name).flatten().to_numpy().astype(np.int64).reshape(batch.num_rows, -1)


def first_centroids(vectors: DataFrame, count: int = CENTROIDS, seed: int = SEED) -> np.ndarray:
    """The ``count`` vectors whose SHA-256 of seed and key is smallest, in that order (of equal keys the smaller vector first)."""
    order = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("id").cast("string"), F.lit(""))), 256)
    return np.array([r["x"] for r in vectors.select(order.alias("h"), "x").orderBy("h", "x").limit(count).collect()], dtype=np.int64)


def assigned(vectors: DataFrame, planes: Bisectors) -> DataFrame:
    """(id, cluster, distance) of every vector, in its own task."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _matrix(batch, "x")
            nearest = planes.nearest(x)
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(nearest, pa.int32()), pa.array(planes.distances(x, nearest))], names=["id", "cluster", "distance"])

    return in_batches(vectors.select("id", "x"), run, "id long, cluster int, distance long")


def moved(vectors: DataFrame, planes: Bisectors) -> np.ndarray:
    """The centroids after one round: the floor of the mean of each one's vectors; one without vectors stays.

    A task sends one row of exact sums per centroid it met, so what is shuffled depends on tasks
    and centroids only, and k times (dimensions + 1) numbers reach the driver.
    """
    k, dims = planes.centroids.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, sums = np.zeros(k, dtype=np.int64), np.zeros((k, dims), dtype=np.int64)
        for batch in batches:
            x = _matrix(batch, "x")
            nearest = planes.nearest(x)
            order = np.argsort(nearest, kind="stable")
            met, starts = np.unique(nearest[order], return_index=True)
            if len(met):
                counts[met] += np.diff(np.r_[starts, len(x)])
                sums[met] += np.add.reduceat(x[order], starts, axis=0)
        met = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(met, pa.int32()), pa.array(counts[met]), pa.array(sums[met].tolist(), pa.list_(pa.int64()))], names=["cluster", "n", "sums"])

    parts = in_batches(vectors.select("x"), run, "cluster int, n long, sums array<long>")
    values = parts.select("cluster", F.posexplode(F.concat("sums", F.array("n"))).alias("i", "value"))
    totals = {(c, i): int(v) for c, i, v in values.groupBy("cluster", "i").agg(F.sum(F.col("value").cast(T.DecimalType(38, 0)))).collect()}
    centroids = planes.centroids.copy()
    for cluster in {c for c, _ in totals}:
        centroids[cluster] = [totals[cluster, i] // totals[cluster, dims] for i in range(dims)]
    return centroids


def fit(vectors: DataFrame, count: int = CENTROIDS, rounds: int = ROUNDS, seed: int = SEED) -> Bisectors:
    """Centroids after ``rounds`` rounds over all ``vectors`` (id, x)."""
    planes = Bisectors(first_centroids(vectors, count, seed))
    for _ in range(rounds if len(planes.centroids) else 0):
        planes = Bisectors(moved(vectors, planes))
    return planes


def clusters(vectors: DataFrame, key: str = "vec_id", vector: str = "embedding", dimensions: int = DIMENSIONS, count: int = CENTROIDS, rounds: int = ROUNDS,
             seed: int = SEED, scale: int = SCALE) -> DataFrame:
    """One row per kept vector: ``key``, cluster, distance, cluster_inertia, inertia, centroid_sha256.

    Vectors of another length, null vectors and those with a null or non-finite component are left
    out. Distances are squared and exact; of equal ones the smaller centroid wins. Fewer vectors
    than ``count`` give as many centroids; an empty table gives an empty result. Repeated rows
    count one by one, a missing key is hashed as the empty text, other columns are not looked at.
    """
    spark = vectors.sparkSession
    held = saved(integer_vectors(vectors, key, vector, dimensions, scale), "vectors")
    planes = fit(held, count, rounds, seed)
    rows = saved(assigned(held, planes), "clusters") if len(planes.centroids) else small_table(spark, [], "id long, cluster int, distance long")
    total = F.sum(F.col("distance").cast(T.DecimalType(38, 0)))
    per = {r[0]: int(r[1]) for r in rows.groupBy("cluster").agg(total).collect()}
    facts = [(c, per[c], sum(per.values()), digest) for c, digest in enumerate(planes.digests()) if c in per]
    # One row per centroid: at most ``count`` rows are broadcast.
    told = small_table(spark, facts, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return rows.join(F.broadcast(told), "cluster").select(F.col("id").alias(key), "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
