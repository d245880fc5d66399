"""k-means over integer vectors, each vector placed by a bisector tournament.

For centroids a < b the plane of equal distance has the integer normal 2(b - a) and the integer threshold |b|^2 - |a|^2: a vector x is nearer
to b exactly if x.normal > threshold, and zero favours the smaller number. The planes of all pairs are computed once a round. A vector's
centroids meet in a knock-out over neighbours in number, so k - 1 sign tests leave the nearest one, and only that distance is computed.

All arithmetic is exact: in doubles where every sum stays below 2^53, in 64-bit integers below 2^62, in Python integers beyond. A round reads the kept
vectors once; a task returns at most one (count, componentwise sum) per cluster and batch, which Spark adds up. Nothing but
k sums reaches the driver. A round that moves no centroid ends the fit, as later rounds could not move one either.

Defined results: rows whose vector is NULL, has another length, or holds a NULL or non-finite component take no part. Repeated rows and repeated ids all
count, one row each. Equal hashes of the start order (repeated ids) are ordered by vector; a NULL id starts last. With fewer than k kept vectors
each starts a centroid; an empty table gives an empty result. Equal centroids: the larger number stays empty, and empty centroids do not move.
Scaled components, distances and sums beyond 64 bits saturate there. Only the id and the vector are read, so further columns cannot clash.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize

LONG = 2**63 - 1


@dataclass(frozen=True)
class Planes:
    """Bisecting planes of all centroid pairs: ``normals[a, b]`` and ``thresholds[a, b]`` for a < b."""

    centroids: np.ndarray
    normals: np.ndarray
    thresholds: np.ndarray
    reach: int

    @classmethod
    def of(cls, centroids: list[list[int]]) -> Planes:
        c = np.array(centroids, object)
        square = (c * c).sum(axis=1)
        return cls(c, 2 * (c[None, :, :] - c[:, None, :]), square[None, :] - square[:, None], int(np.abs(c).max(initial=0)))

    def nearest(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(number of the nearest centroid, exact squared distance) of each row of integer vectors."""
        most = max(self.reach, int(np.abs(x.astype(np.float64)).max(initial=0)) + 1)
        largest = 8 * x.shape[1] * most * most      # no term, sum or difference below is larger
        kind = np.float64 if largest < 2**53 else np.int64 if largest < 2**62 else object
        x, centroids = x.astype(kind), self.centroids.astype(kind)
        normals, thresholds = self.normals.astype(kind), self.thresholds.astype(kind)
        rows = len(x)
        field = [np.full(rows, c) for c in range(len(centroids))]
        while len(field) > 1:
            winners = []
            for a, b in zip(field[::2], field[1::2]):
                side = (x * normals[a, b]).sum(axis=1) - thresholds[a, b]
                winners.append(np.where(side > 0, b, a))
            field = winners + field[len(field) & ~1:]
        off = x - centroids[field[0]]
        return field[0], (off * off).sum(axis=1)


def kept(vectors: DataFrame, dim: int, scale: int) -> DataFrame:
    """(vec_id, v): floor(scale * component) of every usable vector."""
    usable = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return (vectors.filter((F.size("embedding") == dim) & usable)
            .select("vec_id", F.transform("embedding", lambda x: F.floor(x.cast("double") * scale).cast("long")).alias("v")))


def _matrix(col: pa.Array, dim: int) -> np.ndarray:
    return np.asarray(col.flatten(), np.int64).reshape(len(col), dim)


def starts(rows: DataFrame, k: int, seed: str) -> list[list[int]]:
    """The k vectors with the smallest sha256 of ``seed:id``."""
    order = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256)
    return [list(r["v"]) for r in rows.orderBy(order.asc_nulls_last(), "v").limit(k).select("v").collect()]


def _sums(rows: DataFrame, centroids: list[list[int]]) -> dict[int, tuple[int, list[int]]]:
    """Per non-empty cluster: how many vectors it has and their componentwise sum."""
    planes, dim = Planes.of(centroids), len(centroids[0])

    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _matrix(batch.column(0), dim)
            near, _ = planes.nearest(x)
            # 64-bit halves: a batch of 2^31 rows cannot overflow either sum
            high, low = x >> 32, x & 0xFFFFFFFF
            found = np.unique(near)
            yield pa.record_batch({
                "cluster": pa.array(found, pa.int32()),
                "n": pa.array([int((near == c).sum()) for c in found], pa.int64()),
                "s": pa.array([[Decimal((int(h) << 32) + int(lo)) for h, lo in zip(high[near == c].sum(axis=0), low[near == c].sum(axis=0))] for c in found],
                              pa.list_(pa.decimal128(38, 0)))})

    parts = rows.select("v").mapInArrow(add_up, "cluster int, n long, s array<decimal(38,0)>")
    total = parts.groupBy("cluster").agg(F.sum("n").alias("n"), F.array(*(F.sum(F.col("s")[i]) for i in range(dim))).alias("s"))
    return {r["cluster"]: (r["n"], [int(x) for x in r["s"]]) for r in total.collect()}


def fit(rows: DataFrame, k: int, rounds: int, seed: str) -> list[list[int]]:
    """Centroids after ``rounds`` rounds over the integer vectors of ``kept``; empty without vectors."""
    centroids = starts(rows, k, seed)
    for _ in range(rounds if centroids else 0):
        sums = _sums(rows, centroids)
        moved = [[s // sums[c][0] for s in sums[c][1]] if c in sums else old for c, old in enumerate(centroids)]
        if moved == centroids:
            break
        centroids = moved
    return centroids


def assign(rows: DataFrame, centroids: list[list[int]]) -> DataFrame:
    """(vec_id, cluster, distance) of every row of ``kept``."""
    planes, dim = Planes.of(centroids), len(centroids[0])
    vec_id = rows.schema["vec_id"].dataType.simpleString()

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            near, distance = planes.nearest(_matrix(batch.column("v"), dim))
            yield pa.record_batch({"vec_id": batch.column("vec_id"), "cluster": pa.array(near, pa.int32()),
                                   "distance": pa.array([min(int(d), LONG) for d in distance], pa.int64())})

    return rows.mapInArrow(place, f"vec_id {vec_id}, cluster int, distance long")


def cluster(vectors: DataFrame, k: int = 8, rounds: int = 10, seed: str = "3", dim: int = 64, scale: int = 1024) -> DataFrame:
    """(vec_id, cluster, distance, cluster_inertia, inertia, centroid) of every usable vector."""
    spark = vectors.sparkSession
    rows = materialize(kept(vectors, dim, scale), "cluster-vectors")
    centroids = fit(rows, k, rounds, seed)
    if not centroids:
        return rows.selectExpr("vec_id", "0 cluster", "0L distance", "0L cluster_inertia", "0L inertia", "v centroid")
    placed = materialize(assign(rows, centroids), "cluster-placed")
    of = {r["cluster"]: int(r["s"]) for r in placed.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("s")).collect()}
    total = min(sum(of.values()), LONG)
    facts = spark.createDataFrame([(c, min(of.get(c, 0), LONG), total, v) for c, v in enumerate(centroids)],
                                  "cluster int, cluster_inertia long, inertia long, centroid array<long>")
    return placed.join(F.broadcast(facts), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid")
