"""Exact k-means rounds on integer vectors with a table of pivot distances (LAESA).

A vector's components become integers, floor(`SCALE` * x). A few pivots, vectors of the first centroids that lie far
from each other, stay the same in all rounds, and every vector's distance to each pivot is stored once, beside
the vector. In a round the centroids' distances to the pivots are computed on the driver; the difference between a
vector's and a centroid's distance to one pivot is a lower bound of their own distance (the triangle inequality), so
the largest difference over the pivots is one too. The centroid with the least bound is measured first; only centroids
whose bound doesn't exceed that distance get their exact integer distance. Bounds are floating-point numbers and
are lowered by more than their rounding error, so no centroid is lost; all results come from integers.

Each task sums its vectors per cluster, so a cluster with most of the vectors costs a few rows a task; sums are added as
decimals. A round is one scan of the written table; what goes to the driver is one row a cluster.

Cases: vectors that are null, of another dimension, or with a null or non-finite component take no part; rows that repeat
are vectors of their own; a null id is kept, and comes after all others as a first centroid; equal hashes (of repeated ids) are put
in the order of the components; with fewer vectors than centroids there are as many centroids as vectors; centroids
may be equal, the smaller number gets the vectors; an empty cluster keeps its centroid; an empty table gives an empty
one; other columns are ignored. A component beyond `LARGEST` after scaling fails the job: its squared distance would
not fit the result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from snapmart.llm.common import col, map_batches, shared_folder, staged, text_table

SCALE = 256
PIVOTS = 12
#: 64 squared differences of such components fit a long.
LARGEST = 1 << 27
#: Vectors worked on at a time.
ROWS = 2048


def integer_vectors(embeddings: DataFrame, dimension: int, scale: int = SCALE, vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """vec_id, v (long components) of the vectors that take part."""
    rows = text_table(embeddings, vec_id, embedding).select(col(vec_id).alias("vec_id"), col(embedding).cast("array<double>").alias("x"))
    finite = F.forall("x", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    scaled = F.transform("x", lambda x: F.floor(x * float(scale)))
    rows = rows.filter((F.size("x") == dimension) & finite)
    fits = F.forall("x", lambda x: F.abs(x) * float(scale) <= float(LARGEST))
    return rows.select("vec_id", F.when(fits, scaled).otherwise(F.raise_error(F.lit("a component is too large")).cast("array<bigint>")).alias("v"))


def first_centroids(vectors: DataFrame, number: int, seed: int = 2) -> np.ndarray:
    """The vectors with the smallest hashes of their ids, in the order of the hashes."""
    order = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256)
    rows = vectors.select("v", order.alias("h")).orderBy(F.col("h").asc_nulls_last(), "v").limit(number).collect()  # `number` rows
    return np.array([r["v"] for r in rows], np.int64)


def squared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact squared distances of rows."""
    d = a - b
    return np.einsum("ij,ij->i", d, d)


def choose_pivots(centroids: np.ndarray, number: int = PIVOTS) -> np.ndarray:
    """Centroids of which each lies farthest from those chosen before."""
    chosen = [0]
    nearest = squared(centroids, centroids[0])
    while len(chosen) < min(number, len(centroids)) and nearest.max() > 0:
        chosen.append(int(nearest.argmax()))
        nearest = np.minimum(nearest, squared(centroids, centroids[chosen[-1]]))
    return centroids[chosen]


def pivot_distances(vectors: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    """One row a vector, one column a pivot."""
    return np.sqrt(np.stack([squared(vectors, p) for p in pivots], axis=1).astype(np.float64))


def nearest_centroids(vectors: np.ndarray, to_pivots: np.ndarray, centroids: np.ndarray, of_centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """The number and the squared distance of each vector's nearest centroid, and how many distances were computed."""
    bound = np.zeros((len(vectors), len(centroids)))
    for p in range(to_pivots.shape[1]):
        np.maximum(bound, np.abs(to_pivots[:, p, None] - of_centroids[None, :, p]), out=bound)
    # distances of up to 2**31 have a rounding error below 2**-20
    bound = np.maximum(bound - 1e-6 * (1 + bound), 0.0)
    bound *= bound
    best = bound.argmin(axis=1)
    distance = squared(vectors, centroids[best])
    bound[np.arange(len(vectors)), best] = np.inf
    # an equal distance counts if its centroid has a smaller number; the square is lowered once more for its own rounding
    row, number = np.nonzero(bound * (1 - 1e-12) <= distance[:, None])
    measured = squared(vectors[row], centroids[number])
    # the least distance, then the least number, of each vector's candidates and its first one
    row, number = np.concatenate([row, np.arange(len(vectors))]), np.concatenate([number, best])
    measured = np.concatenate([measured, distance])
    order = np.lexsort((number, measured, row))
    first = order[np.unique(row[order], return_index=True)[1]]
    return number[first], measured[first], len(measured)


def _matrix(column: pa.ListArray) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def cluster(
    embeddings: DataFrame, number: int = 40, rounds: int = 5, dimension: int = 64, scale: int = SCALE, pivots: int = PIVOTS, seed: int = 2,
    vec_id: str = "vec_id", embedding: str = "embedding",
) -> DataFrame:
    """vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256 for each vector that takes part."""
    spark, folder = embeddings.sparkSession, shared_folder(embeddings.sparkSession)
    vectors = staged(integer_vectors(embeddings, dimension, scale, vec_id, embedding), folder, "integers")
    centroids = first_centroids(vectors, number, seed)
    kind = vectors.schema["vec_id"].dataType.simpleString()
    if not len(centroids):
        return spark.createDataFrame([], f"vec_id {kind}, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string")
    fixed = choose_pivots(centroids, pivots)

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            to_pivots = pivot_distances(_matrix(batch.column(1)), fixed)
            offsets = pa.array(np.arange(batch.num_rows + 1, dtype=np.int32) * len(fixed))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.ListArray.from_arrays(offsets, pa.array(to_pivots.ravel()))], names=["vec_id", "v", "d"])

    table = staged(map_batches(vectors, measure, f"vec_id {kind}, v array<long>, d array<double>"), folder, "pivots")

    def assigned(batches: Iterator[pa.RecordBatch], centroids: np.ndarray) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray, np.ndarray]]:
        of_centroids = pivot_distances(centroids, fixed)
        for batch in batches:
            for k in range(0, batch.num_rows, ROWS):
                part = batch.slice(k, ROWS)
                v = _matrix(part.column("v"))
                yield part, v, *nearest_centroids(v, _matrix(part.column("d")), centroids, of_centroids)[:2]

    for _ in range(rounds):

        def sums(batches: Iterator[pa.RecordBatch], centroids: np.ndarray = centroids) -> Iterator[pa.RecordBatch]:
            count, total = np.zeros(len(centroids), np.int64), np.zeros(centroids.shape, np.int64)
            for _, v, found, _ in assigned(batches, centroids):
                count += np.bincount(found, minlength=len(centroids))
                order = np.argsort(found, kind="stable")
                there, starts = np.unique(found[order], return_index=True)
                total[there] += np.add.reduceat(v[order], starts, axis=0)
            there = np.flatnonzero(count)
            yield pa.RecordBatch.from_pydict({"cluster": pa.array(there, pa.int32()), "n": count[there], "total": pa.array(total[there].tolist(), pa.list_(pa.int64()))})

        parts = map_batches(table.select("v", "d"), sums, "cluster int, n long, total array<long>")
        parts = parts.select("cluster", "n", F.posexplode("total").alias("place", "x"))
        exact = F.sum(F.col("x").cast("decimal(38,0)"))
        moved = centroids.copy()
        for r in parts.groupBy("cluster", "place").agg(exact.alias("total"), F.sum("n").alias("n")).collect():  # a row a cluster and component
            moved[r["cluster"], r["place"]] = int(r["total"]) // r["n"]
        centroids = moved

    def final(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, _, found, distance in assigned(batches, centroids):
            yield pa.RecordBatch.from_arrays([part.column("vec_id"), pa.array(found, pa.int32()), pa.array(distance, pa.int64())], names=["vec_id", "cluster", "distance"])

    found = staged(map_batches(table, final, f"vec_id {kind}, cluster int, distance long"), folder, "clusters")
    inertia = found.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("i")).collect()  # a row a cluster
    whole = sum(int(r["i"]) for r in inertia)
    digest = [hashlib.sha256(",".join(map(str, c.tolist())).encode()).hexdigest() for c in centroids]
    facts = spark.createDataFrame([(r["cluster"], int(r["i"]), whole, digest[r["cluster"]]) for r in inertia], "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return found.join(F.broadcast(facts), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
