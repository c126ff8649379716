"""Centroid clustering whose assignment prunes centroids by Ptolemy's inequality.

For any two pivots p, q, a vector x and a centroid c:
d(x, c) * d(p, q) >= |d(x, p) * d(c, q) - d(x, q) * d(c, p)|.  The pivots are fixed, so a
vector's pivot distances are computed once and kept with it; a round only needs the
pivot distances of its few centroids.  A centroid is checked exactly, in whole numbers,
unless its bound, rounded down by more than all errors of its arithmetic, is above the
distance of a centroid that was checked.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from headway.llm.frames import written
from headway.llm.whole_vectors import lists, matrix, whole_vectors

#: Pivots, and the rows with the least hashes among which they are chosen.
PIVOTS = 8
PIVOT_SAMPLE = 1024
#: Rows handled at once in a task.
ROWS = 4096
#: Relative slack of bounds: some ninety units in the last place of a double.
SLACK = 1e-14


def squared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact squared distances of every row of ``a`` to every row of ``b``."""
    return np.stack([((a - row) ** 2).sum(axis=1) for row in b], axis=1) if len(b) else np.zeros((len(a), 0), np.int64)


def choose_pivots(sample: np.ndarray, most: int = PIVOTS) -> np.ndarray:
    """Rows far from each other: each next one is furthest from those chosen."""
    if not len(sample):
        return sample
    chosen, far = [0], squared(sample, sample[:1])[:, 0]
    while len(chosen) < most and far.max() > 0:
        chosen.append(int(far.argmax()))
        far = np.minimum(far, squared(sample, sample[chosen[-1:]])[:, 0])
    return sample[chosen]


def ptolemaic_bounds(to_pivots: np.ndarray, centroid_to_pivots: np.ndarray, between: np.ndarray) -> np.ndarray:
    """Squared lower bounds (rows x centroids) from plain distances to the pivots."""
    best = np.zeros((len(to_pivots), len(centroid_to_pivots)))
    for p, q in combinations(range(len(between)), 2):
        one = to_pivots[:, p, None] * centroid_to_pivots[None, :, q]
        two = to_pivots[:, q, None] * centroid_to_pivots[None, :, p]
        bound = np.abs(one - two) - SLACK * (one + two)
        np.maximum(best, bound * ((1 - SLACK) / between[p, q]), out=best)
    return best * best * (1 - SLACK)


def nearest(x: np.ndarray, to_pivots: np.ndarray, centroids: np.ndarray, pivots: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """Nearest centroid of each row (the least number among ties), its squared distance, and how many were checked."""
    bounds = ptolemaic_bounds(np.sqrt(to_pivots), np.sqrt(squared(centroids, pivots)), np.sqrt(squared(pivots, pivots)))
    which = bounds.argmin(axis=1)
    best = ((x - centroids[which]) ** 2).sum(axis=1)
    start, checked = which.copy(), len(x)
    for c in range(len(centroids)):
        ask = np.flatnonzero((bounds[:, c] <= best * (1 + SLACK)) & (start != c))
        checked += len(ask)
        d = ((x[ask] - centroids[c]) ** 2).sum(axis=1)
        better = (d < best[ask]) | ((d == best[ask]) & (c < which[ask]))
        which[ask[better]], best[ask[better]] = c, d[better]
    return which, best, checked


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for lo in range(0, batch.num_rows, ROWS):
            yield batch.slice(lo, ROWS)


def _cached(pivots: np.ndarray, width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _blocks(batches):
            far = squared(matrix(rows.column("v"), width), pivots)
            yield pa.record_batch([rows.column("vec_id"), rows.column("v"), lists(far, pa.int64())], ["vec_id", "v", "far"])
    return run


def _assigned(centroids: np.ndarray, pivots: np.ndarray):
    def each(batches: Iterator[pa.RecordBatch]):
        for rows in _blocks(batches):
            x = matrix(rows.column("v"), centroids.shape[1])
            which, best, _ = nearest(x, matrix(rows.column("far"), len(pivots)), centroids, pivots)
            yield rows, x, which, best

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """What a task adds to each centroid: at most one row per centroid."""
        count, total = np.zeros(len(centroids), np.int64), np.zeros_like(centroids)
        for _, x, which, _ in each(batches):
            count += np.bincount(which, minlength=len(centroids))
            for c in np.unique(which).tolist():
                total[c] += x[which == c].sum(axis=0)
        some = np.flatnonzero(count)
        yield pa.record_batch([pa.array(some, pa.int32()), pa.array(count[some]), lists(total[some], pa.int64())], ["cluster", "n", "total"])

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for given, _, which, best in each(batches):
            yield pa.record_batch([given.column("vec_id"), pa.array(which, pa.int32()), pa.array(best)], ["vec_id", "cluster", "distance"])
    return sums, rows


def _moved(points: DataFrame, centroids: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    """Centroids after one round: componentwise floor of the mean; empty ones stay."""
    sums, _ = _assigned(centroids, pivots)
    parts = points.select("v", "far").mapInArrow(sums, "cluster int, n long, total array<long>")
    added = parts.select("cluster", "n", F.posexplode("total").alias("at", "x")).groupBy("cluster", "at").agg(
        F.sum("n").alias("n"), F.sum(F.col("x").cast("decimal(38,0)")).alias("x"))
    out = centroids.copy()
    for r in added.collect():  # one row per centroid and component
        out[r.cluster, r.at] = int(r.x) // r.n
    return out


def clustered(rows: DataFrame, clusters: int = 16, rounds: int = 3, dimensions: int = 64, scale: int = 64) -> DataFrame:
    """Cluster of every usable vector after ``rounds`` rounds and a last assignment.

    ``rows``: (vec_id, embedding); vectors are turned into floor(scale * x).  The first
    centroids are the vectors with the least lower-case SHA-256 of ``1:<vec_id>``.
    Returns vec_id, cluster, distance (squared), cluster_inertia, inertia,
    centroid_sha256.  A vector takes part if it has exactly ``dimensions`` components, none
    null or non-finite, and none of 2^24 or more in size once scaled.  Rows that repeat
    a vec_id are vectors each (among equal hashes the smaller vector comes first); a null
    vec_id has no hash and comes last.  With fewer vectors than clusters all of them are
    centroids; equal centroids leave the later one empty.  An inertia that a long cannot
    hold is null.  Further columns are ignored; an empty table gives an empty result.
    """
    spark = rows.sparkSession
    vectors = whole_vectors(rows, scale, dimensions)

    def least(seed: str, n: int) -> np.ndarray:
        hashed = vectors.select(F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256).alias("h"), "v")
        found = hashed.orderBy(F.col("h").asc_nulls_last(), "v").limit(n).collect()
        return np.array([r.v for r in found], np.int64).reshape(len(found), dimensions)

    centroids, pivots = least("1", clusters), choose_pivots(least("2", PIVOT_SAMPLE))
    if not len(centroids):
        return spark.createDataFrame([], "vec_id long, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string")
    points = written(vectors.mapInArrow(_cached(pivots, dimensions), "vec_id long, v array<int>, far array<long>"), "points")
    for _ in range(rounds):
        centroids = _moved(points, centroids, pivots)
    found = written(points.mapInArrow(_assigned(centroids, pivots)[1], "vec_id long, cluster int, distance long"), "assigned")
    sums = {r.cluster: int(r.d) for r in found.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("d")).collect()}

    def fits(n: int) -> int | None:
        return n if n < 1 << 63 else None

    names = [(c, fits(d), fits(sum(sums.values())), hashlib.sha256(",".join(map(str, centroids[c].tolist())).encode()).hexdigest())
             for c, d in sums.items()]
    # One row per centroid: always small.
    each = spark.createDataFrame(names, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return found.join(F.broadcast(each), "cluster").select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
