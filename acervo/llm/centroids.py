"""Clusters about exact integer centroids, with n-simplex projection as the filter.

* A vector's distances to several pivots are measured once. They alone give its apex over the simplex of
  the pivots: coordinates along it, and a height above it. Apexes are stored beside the vectors.
* The Euclidean distance of two apexes is a lower bound of the vectors' distance; with one of them
  mirrored at the simplex it is an upper bound. A centroid whose lower bound is above another one's
  upper bound is out; those left are compared in integers.
* A round is one pass over the stored table: each task sums its vectors per cluster, and the sums
  of at most k clusters come to the driver, which makes the next k centroids.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from acervo.llm.common import cut, release

PIVOTS = 65
#: Vectors that pivots are chosen from: the first ones in the order that centroids start by.
SAMPLE = 256
#: The most a scaled component may be, so that squared distances of 64 components fit 64 bits.
LARGEST = 1 << 27
#: A pivot's least height above the others, against the first edge; what bounds may be off, relatively.
LEAST_HEIGHT, SLACK = 0.05, 4e-6
ROWS = 512  # vectors compared at once


class Simplex:
    """A simplex of pivots out of ``points``, each next one that highest above those before."""

    def __init__(self, points: np.ndarray, most: int = PIVOTS):
        points = points.astype(float)
        rest, axes, chosen = points - points[0], [], [0]
        while len(axes) < min(most - 1, len(points) - 1):
            heights = np.linalg.norm(rest, axis=1)
            best = int(heights.argmax())
            if heights[best] <= LEAST_HEIGHT * (np.linalg.norm(points[chosen[1]] - points[0]) if axes else 0.0):
                break
            axes.append(rest[best] / heights[best])
            rest = rest - np.outer(rest @ axes[-1], axes[-1])
            chosen.append(best)
        self.pivots = points[chosen]
        edges = self.pivots[1:] - self.pivots[0]
        self.lower = np.tril(edges @ np.array(axes).T) if axes else np.zeros((0, 0))
        self.squares = (edges**2).sum(axis=1)

    def apexes(self, vectors: np.ndarray) -> np.ndarray:
        """Coordinates over the simplex from the distances to the pivots, the height above it last."""
        square = np.stack([((vectors - p) ** 2).sum(axis=1) for p in self.pivots], axis=1)
        wanted = (square[:, :1] + self.squares - square[:, 1:]) / 2
        out = np.zeros((len(vectors), len(self.lower) + 1))
        for i, row in enumerate(self.lower):
            out[:, i] = (wanted[:, i] - out[:, :i] @ row[:i]) / row[i]
        out[:, -1] = np.sqrt(np.maximum(square[:, 0] - (out[:, :-1] ** 2).sum(axis=1), 0))
        return out


def bounds(one: np.ndarray, other: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(lower, upper) bounds of the distances between the vectors of two tables of apexes, safe against rounding."""
    along = (one[:, :-1] ** 2).sum(axis=1)[:, None] + (other[:, :-1] ** 2).sum(axis=1)[None]
    along = np.maximum(along - 2 * (one[:, :-1] @ other[:, :-1].T), 0)
    low = np.sqrt(along + (one[:, -1, None] - other[None, :, -1]) ** 2)
    high = np.sqrt(along + (one[:, -1, None] + other[None, :, -1]) ** 2)
    slack = SLACK * (np.linalg.norm(one, axis=1)[:, None] + np.linalg.norm(other, axis=1)[None])
    return low - slack, high + slack


def nearest(vectors: np.ndarray, apexes: np.ndarray, centroids: np.ndarray, tops: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """(nearest centroid, the smaller number of equal ones; squared distance; how many were compared in integers)."""
    clusters, distances, compared = [], [], 0
    for start in range(0, len(vectors), ROWS):
        x = vectors[start : start + ROWS]
        low, high = bounds(apexes[start : start + ROWS], tops)
        row, of = np.nonzero(low <= high.min(axis=1, keepdims=True))
        away = x[row] - centroids[of]
        square = np.einsum("ij,ij->i", away, away)
        firsts = np.searchsorted(row, np.arange(len(x)))
        least = np.minimum.reduceat(square, firsts)
        hit = np.flatnonzero(square == least[row])
        clusters.append(of[hit[np.searchsorted(row[hit], np.arange(len(x)))]])
        distances.append(least)
        compared += len(row)
    return np.concatenate(clusters), np.concatenate(distances), compared


def integer_vectors(df: DataFrame, key: str, vector: str, dimensions: int, scale: int) -> DataFrame:
    """id, x: floor(scale * component) of the vectors of exactly ``dimensions`` finite components."""
    parts = F.col(f"`{vector}`").cast("array<double>")
    finite = F.forall(parts, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(float("inf"))))

    def scaled(c):
        large = F.raise_error(F.lit(f"a component times {scale} is beyond {LARGEST}: squared distances would not fit 64 bits"))
        return F.when(F.abs(c * scale) < LARGEST, F.floor(c * scale).cast("int")).otherwise(large)

    whole = F.coalesce(F.size(parts) == dimensions, F.lit(False)) & F.coalesce(finite, F.lit(False))
    return df.where(whole).select(F.col(f"`{key}`").alias("id"), F.transform(parts, scaled).alias("x"))


def _matrix(column: pa.Array, kind) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(kind, copy=False)
    return flat.reshape(len(column), -1)


def _with_apexes(vectors: DataFrame, simplex: Simplex) -> DataFrame:
    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                made = simplex.apexes(_matrix(batch.column(1), float))
                edges = pa.array(np.arange(0, made.size + 1, made.shape[1]), pa.int32())
                apexes = pa.ListArray.from_arrays(edges, pa.array(made.ravel().astype(np.float32)))
                yield pa.RecordBatch.from_arrays([*batch.columns, apexes], ["id", "x", "apex"])

    return vectors.mapInArrow(project, f"id {vectors.schema['id'].dataType.simpleString()}, x array<int>, apex array<float>")


def _sums(stored: DataFrame, centroids: np.ndarray, tops: np.ndarray) -> dict[int, tuple[int, list[int]]]:
    """cluster -> (count, exact sums of the components), by partial sums per task."""
    k, size = centroids.shape

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count, total = np.zeros(k, np.int64), np.zeros((k, size), np.int64)
        for batch in batches:
            if batch.num_rows:
                x = _matrix(batch.column(0), np.int64)
                own, _, _ = nearest(x, _matrix(batch.column(1), float), centroids, tops)
                order = np.argsort(own, kind="stable")
                which, firsts = np.unique(own[order], return_index=True)
                total[which] += np.add.reduceat(x[order], firsts, axis=0)
                count += np.bincount(own, minlength=k)
        used = np.flatnonzero(count)
        sums = pa.array(total[used].tolist(), pa.list_(pa.int64()))
        yield pa.RecordBatch.from_arrays([pa.array(used, pa.int32()), pa.array(count[used]), sums], ["cluster", "n", "sums"])

    parts = stored.select("x", "apex").mapInArrow(add, "cluster int, n long, sums array<long>")
    summed = F.array(*[F.sum(F.col("sums")[i]) for i in range(size)])
    return {r["cluster"]: (r["n"], r["sums"]) for r in parts.groupBy("cluster").agg(F.sum("n").alias("n"), summed.alias("sums")).collect()}


def cluster(
    df: DataFrame,
    key: str = "vec_id",
    vector: str = "embedding",
    k: int = 40,
    rounds: int = 5,
    seed: str = "2:",
    dimensions: int = 64,
    scale: int = 256,
    pivots: int = PIVOTS,
) -> DataFrame:
    """A row per kept vector: ``key``, cluster, distance, cluster_inertia, inertia, centroid_sha256 and compared.

    Components count as floor(``scale`` * component). The first centroids are the ``k`` vectors with the
    smallest sha256 of ``seed`` and key; each round assigns all vectors and replaces a centroid by the
    floor of its vectors' mean; then vectors are assigned once more. ``distance`` is squared; nearest is
    the smaller number of equals. ``compared`` is how many centroids the bounds had left, over a batch.

    * Vectors null, of another length, or holding null or non-finite components take no part.
    * Repeated rows each take part. Rows with a null key do too, and start clusters only after all others.
    * Fewer vectors than ``k``: as many clusters. Equal first centroids: the later one stays empty.
    * A component beyond 2**27 after scaling raises an error. No vectors: no rows. Other columns are not read.
    """
    vectors = integer_vectors(df, key, vector, dimensions, scale)
    order = F.sha2(F.concat(F.lit(seed), F.col("id").cast("string")), 256)
    first = vectors.orderBy(order.asc_nulls_last(), "x").limit(max(k, SAMPLE)).collect()  # a fixed number of rows
    if not first:
        none = {"cluster": "int", "distance": "long", "cluster_inertia": "long", "inertia": "long", "centroid_sha256": "string", "compared": "double"}
        return vectors.select(F.col("id").alias(key), *[F.lit(None).cast(t).alias(c) for c, t in none.items()])
    first = np.array([r["x"] for r in first], np.int64)
    centroids, simplex = first[:k].copy(), Simplex(first, pivots)
    stored = cut(_with_apexes(vectors, simplex))
    for _ in range(rounds):
        for i, (n, sums) in _sums(stored, centroids, simplex.apexes(centroids)).items():
            centroids[i] = [s // n for s in sums]
    tops = simplex.apexes(centroids)

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                own, away, n = nearest(_matrix(batch.column(1), np.int64), _matrix(batch.column(2), float), centroids, tops)
                share = pa.array(np.full(len(own), n / len(own)))
                columns = [batch.column(0), pa.array(own, pa.int32()), pa.array(away), share]
                yield pa.RecordBatch.from_arrays(columns, ["id", "cluster", "distance", "compared"])

    kind = stored.schema["id"].dataType.simpleString()
    found = cut(stored.mapInArrow(assign, f"id {kind}, cluster int, distance long, compared double"))
    release(stored)
    inertia = {r["cluster"]: r["s"] for r in found.groupBy("cluster").agg(F.sum("distance").alias("s")).collect()}  # k rows
    own_sum = F.array(*[F.lit(inertia.get(i, 0)).cast("long") for i in range(len(centroids))])
    digest = F.array(*[F.lit(sha256(",".join(map(str, c)).encode()).hexdigest()) for c in centroids.tolist()])
    return found.select(
        F.col("id").alias(key),
        "cluster",
        "distance",
        own_sum[F.col("cluster")].alias("cluster_inertia"),
        F.lit(sum(inertia.values())).cast("long").alias("inertia"),
        digest[F.col("cluster")].alias("centroid_sha256"),
        "compared",
    )
