"""Clustering around centroids, with Ptolemaic pivots to leave out distances.

Vectors are scaled to whole numbers, so distances, sums and centroids are exact, and equal however the rows are spread. In
any Euclidean space d(o, c) * d(p, s) >= |d(o, s) * d(c, p) - d(o, p) * d(c, s)|. For pivots p and s that stay the same, a
vector's distances to the pivots are computed once and kept beside it; in each round the driver adds those of the centroids to
the pivots, and the inequality gives a lower bound of every distance from eight cached numbers. A centroid whose bound lies
above the distance to the best one so far is left out; the others are measured exactly. Bounds are rounded down by more
than the error of all operations in them, so rounding never leaves out a nearest centroid or a tie.

Pivots are the centroids that ``SAMPLE`` vectors at most, those with the smallest hashes, lead to. They lie close to the
centroids of later rounds, where the bounds are tight. They decide what is measured, never what comes out.

A task reads its vectors as a stream and returns one row of sums for each cluster; the driver sees ``clusters`` rows of sums.
The vectors with their cached distances are written to the shared folder once.

Vectors that are null, of another length, or hold a null or a component that isn't finite are left out. Rows that share a
vec_id are vectors of their own; a null vec_id counts as empty text in the hash. Rows with one hash are ordered by their
components. Fewer vectors than clusters make fewer clusters. An empty table gives no rows. A component beyond 2 ** 27 after
scaling is an error, because squared distances would not fit in 64 bits.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.frames import cut
from tidemark.llm.text import release
from tidemark.llm.vectors import kept, matrix, packed, unpacked

WIDTH = 64
SCALE = 1024
CLUSTERS = 8
ROUNDS = 10
SEED = 3
SAMPLE = 4096
MOST = 1 << 27
_RESULT = "vec_id long, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string"
# More than the relative error of the few operations in a bound.
_ERROR = 32 * np.finfo(np.float64).eps


@dataclass
class Pivots:
    """The pivots, and the distances between them."""

    points: np.ndarray
    between: np.ndarray

    @classmethod
    def of(cls, points: np.ndarray) -> Pivots:
        points = np.unique(points, axis=0)
        return cls(points, distances(points, points))


def squared(points: np.ndarray, centre: np.ndarray) -> np.ndarray:
    """Exact squared distances of whole points to one centre."""
    gap = points.astype(np.int64) - centre
    return np.einsum("ij,ij->i", gap, gap)


def distances(points: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return np.sqrt(np.stack([squared(points, c) for c in centres], axis=1).astype(np.float64))


def lower_bounds(cached: np.ndarray, to_pivots: np.ndarray, between: np.ndarray) -> np.ndarray:
    """No more than the squared distance of each point to a centre whose distances to the pivots are ``to_pivots``.

    The pairs are those of the centre's nearest pivot with each other one.
    """
    best, near = np.zeros(len(cached)), int(np.argmin(to_pivots))
    for other in range(len(between)):
        if not between[near, other]:
            continue
        one, two = to_pivots[near] * cached[:, other], to_pivots[other] * cached[:, near]
        gap = np.abs(one - two) - _ERROR * (one + two)
        np.maximum(best, gap / between[near, other], out=best)
    return best * best * (1 - _ERROR)


def nearest(points: np.ndarray, cached: np.ndarray, centres: np.ndarray, pivots: Pivots) -> tuple[np.ndarray, np.ndarray, int]:
    """The number of each point's nearest centre (the smaller in a tie), its squared distance, and how many were measured."""
    to_pivots = distances(centres, pivots.points)
    near = np.argmin(to_pivots, axis=1)
    # A first guess: the centre whose nearest pivot is closest.
    label = np.argmin(cached[:, near] + to_pivots[np.arange(len(centres)), near], axis=1)
    best = np.empty(len(points), dtype=np.int64)
    for j, centre in enumerate(centres):
        rows = np.flatnonzero(label == j)
        best[rows] = squared(points[rows], centre)
    guess, measured = label.copy(), len(points)
    for j, centre in enumerate(centres):
        bound = lower_bounds(cached, to_pivots[j], pivots.between)
        rows = np.flatnonzero((bound <= best.astype(np.float64)) & (guess != j))
        found = squared(points[rows], centre)
        measured += len(rows)
        better = (found < best[rows]) | ((found == best[rows]) & (j < label[rows]))
        label[rows[better]], best[rows[better]] = j, found[better]
    return label, best, measured


def moved(points: np.ndarray, centres: np.ndarray, rounds: int) -> np.ndarray:
    """Where a few points move the centres."""
    for _ in range(rounds):
        label = np.argmin(np.stack([squared(points, c) for c in centres], axis=1), axis=1)
        for j in np.unique(label):
            centres = centres.copy()
            centres[j] = points[label == j].sum(axis=0) // (label == j).sum()
    return centres


def _whole(vectors: pa.Array, width: int, scale: int) -> np.ndarray:
    points = np.floor(matrix(vectors, width) * scale)
    if len(points) and np.abs(points).max() > MOST:
        raise ValueError(f"a component lies beyond {MOST} after scaling by {scale}")
    return points.astype(np.int32)


def _first(vectors: DataFrame, width: int, scale: int, seed: int, most: int) -> np.ndarray:
    """The points of the vectors with the smallest hashes, in that order, at most so many."""
    spread = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("vec_id").cast("string"), F.lit(""))), 256)
    hashed = vectors.withColumn("_hash", spread)
    rows, some = vectors.count(), None
    if rows > 4 * most:
        # Twice as many as wanted pass, so few rows are ordered; if ids repeat and too few pass, all are.
        limit = f"{int(2 * most / rows * 2**32):08x}"
        some = hashed.where(F.col("_hash") < limit).orderBy("_hash", "vector").limit(most).select("vector").toArrow()
    if some is None or len(some) < most:
        some = hashed.orderBy("_hash", "vector").limit(most).select("vector").toArrow()
    return _whole(some["vector"], width, scale).astype(np.int64)


def _sums(points: DataFrame, centres: np.ndarray, pivots: Pivots, width: int) -> dict[int, tuple[int, list[int]]]:
    """The number of points of each cluster and the exact sums of their components."""
    sent = points.sparkSession.sparkContext.broadcast((centres, pivots))

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        centres, pivots = sent.value
        count, total = np.zeros(len(centres), np.int64), np.zeros((len(centres), width), np.int64)
        for batch in batches:
            rows, cached = unpacked(batch["point"], "<i4", width), unpacked(batch["cached"], "<f8", len(pivots.points))
            label = nearest(rows, cached, centres, pivots)[0]
            count += np.bincount(label, minlength=len(centres))
            for j in np.unique(label):
                total[j] += rows[label == j].sum(axis=0, dtype=np.int64)
        some = np.flatnonzero(count)
        columns = [pa.array(some.astype(np.int32)), pa.array(count[some]), pa.array(list(total[some]), pa.list_(pa.int64()))]
        yield pa.RecordBatch.from_arrays(columns, names=["cluster", "n", "total"])

    parts = points.mapInArrow(add, "cluster int, n long, total array<long>")
    each = parts.select("cluster", "n", F.posexplode("total").alias("at", "part")).groupBy("cluster", "at")
    out: dict[int, tuple[int, list[int]]] = {}
    for r in each.agg(F.sum("n").alias("n"), F.sum(F.col("part").cast("decimal(38,0)")).alias("total")).collect():
        out.setdefault(r.cluster, (r.n, [0] * width))[1][r.at] = int(r.total)
    return out


def cluster(
    df: DataFrame, vector: str = "embedding", width: int = WIDTH, scale: int = SCALE, k: int = CLUSTERS, rounds: int = ROUNDS, seed: int = SEED
) -> DataFrame:
    """vec_id, cluster, distance (squared, of scaled components), cluster_inertia, inertia and centroid_sha256."""
    spark = df.sparkSession
    vectors = kept(df, vector).where(F.size("vector") == width)
    first = _first(vectors, width, scale, seed, SAMPLE)
    if not len(first):
        return spark.createDataFrame([], _RESULT)
    centres = first[:k]
    pivots = Pivots.of(moved(first, centres, rounds))

    def cache(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            points = _whole(batch["vector"], width, scale)
            columns = [batch["vec_id"], packed(points.astype("<i4")), packed(distances(points, pivots.points).astype("<f8"))]
            yield pa.RecordBatch.from_arrays(columns, names=["vec_id", "point", "cached"])
        release()

    points = cut(vectors.mapInArrow(cache, "vec_id long, point binary, cached binary"))
    for _ in range(rounds):
        for j, (n, total) in _sums(points, centres, pivots, width).items():
            centres = centres.copy()
            centres[j] = [t // n for t in total]

    def label(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, cached = unpacked(batch["point"], "<i4", width), unpacked(batch["cached"], "<f8", len(pivots.points))
            found, far, _ = nearest(rows, cached, centres, pivots)
            yield pa.RecordBatch.from_arrays([batch["vec_id"], pa.array(found.astype(np.int32)), pa.array(far)], names=names)

    names = ["vec_id", "cluster", "distance"]
    labelled = cut(points.mapInArrow(label, "vec_id long, cluster int, distance long"))
    each = labelled.groupBy("cluster").agg(F.sum("distance").alias("s")).collect()
    every = sum(r.s for r in each)
    shown = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centres.tolist()]
    # One row for each cluster.
    facts = spark.createDataFrame(
        [(r.cluster, r.s, every, shown[r.cluster]) for r in each], "cluster int, cluster_inertia long, inertia long, centroid_sha256 string"
    )
    return labelled.join(F.broadcast(facts), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
