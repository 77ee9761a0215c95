"""Exact integer k-means whose assignments run by Orchard's search.

Every centroid keeps the list of the other centroids sorted by distance.  A
vector walks the list of its best centroid so far.  When it finds a closer one
it jumps to that one's list; centroids it has met are marked and not measured
again.  It stops at the first entry strictly farther from its centroid than
twice the vector's own distance: by the triangle inequality nothing behind it
can be as near, so ties (smaller number wins) are settled too.

All arithmetic is on integers.  Vectors whose components stay below 2^27 run
in 64-bit numpy; larger ones in Python integers.  Sums leave a task in 32-bit
limbs, so Spark adds them exactly at any magnitude and table size; the driver
only ever holds the ``k`` centroids.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.llm.common import python_pass, written

SMALL = 1 << 27           # components below: squared distances of 64 or more of them fit in 64 bits
LONG = 1 << 63
LIMB = 32                 # bits of a limb of a sum


def scaled(x: float, scale: int) -> int:
    """floor(scale * x), also where the product leaves the doubles."""
    return int(x) * scale if abs(x) >= 1 << 53 else math.floor(scale * x)


def to_integers(x: np.ndarray, scale: int) -> np.ndarray:
    """floor(scale * x) of every component: int64, or Python integers where
    one of them is large."""
    if not x.size or np.abs(x).max() < SMALL / scale:
        return np.floor(x * scale).astype(np.int64)
    return np.array([[scaled(v, scale) for v in row] for row in x.tolist()], dtype=object).reshape(x.shape)


def _together(points: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Both in int64 if all components are small, else in Python integers."""
    wide = points.dtype == object or points.shape[1] * (4 * SMALL * SMALL) >= LONG
    if wide or np.abs(centroids).max() >= SMALL:
        return points.astype(object), centroids
    return points, centroids.astype(np.int64)


def neighbour_lists(centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each centroid the others by distance, and a quarter of the squared
    distance rounded up: the list entry lies strictly beyond twice a distance
    exactly if that quarter is greater than the distance squared."""
    k = len(centroids)
    gap = np.empty((k, k), dtype=centroids.dtype)
    for i in range(k):
        gap[i] = ((centroids - centroids[i]) ** 2).sum(axis=1)
    order = np.array([sorted((j for j in range(k) if j != i), key=lambda j, i=i: (gap[i, j], j)) for i in range(k)], np.int64).reshape(k, k - 1)
    return order, (np.take_along_axis(gap, order, 1) + 3) // 4


def orchard(points: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """Number of the nearest centroid and squared distance of every point, and
    how many distances were measured."""
    points, centroids = _together(points, centroids)
    order, quarter = neighbour_lists(centroids)
    n, k = len(points), len(centroids)
    here, place = np.zeros(n, np.int64), np.zeros(n, np.int64)
    best = ((points - centroids[0]) ** 2).sum(axis=1)
    met = np.zeros((n, k), bool)
    met[:, 0] = True
    walking, measured = np.arange(n), n
    while True:
        walking = walking[place[walking] < k - 1]
        if not len(walking):
            return here, best, measured
        at, on = here[walking], place[walking]
        go = (quarter[at, on] <= best[walking]).astype(bool)
        walking, at, on = walking[go], at[go], on[go]
        place[walking] += 1
        other = order[at, on]
        new = ~met[walking, other]
        who, other = walking[new], other[new]
        met[who, other] = True
        far = ((points[who] - centroids[other]) ** 2).sum(axis=1)
        measured += len(who)
        nearer = ((far < best[who]) | ((far == best[who]) & (other < here[who]))).astype(bool)
        jump = who[nearer]
        here[jump], best[jump], place[jump] = other[nearer], far[nearer], 0


def _limbs(values: list[int]) -> list[list[int]]:
    """The numbers as signed sums of limbs: sum of limb[i][j] << (LIMB * i)."""
    out = []
    while any(not -(1 << LIMB - 1) <= v < 1 << LIMB - 1 for v in values):
        out.append([v & ((1 << LIMB) - 1) for v in values])
        values = [v >> LIMB for v in values]
    return [*out, values]


def _batches(batches: Iterator[pa.RecordBatch], dim: int, scale: int) -> Iterator[tuple[pa.Array, np.ndarray]]:
    for batch in batches:
        if batch.num_rows:
            yield batch.column("id"), to_integers(np.asarray(batch.column("v").flatten(), np.float64).reshape(-1, dim), scale)


def _means(rows: DataFrame, centroids: np.ndarray, dim: int, scale: int) -> np.ndarray:
    """One round: the floored means of the vectors nearest to each centroid."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, counts = np.zeros((len(centroids), dim), dtype=object), np.zeros(len(centroids), np.int64)
        for _, points in _batches(batches, dim, scale):
            cluster = orchard(points, centroids)[0]
            by = np.argsort(cluster, kind="stable")
            own, first, size = np.unique(cluster[by], return_index=True, return_counts=True)
            sums[own] += np.add.reduceat(points[by], first, axis=0).astype(object)
            counts[own] += size
        out = [(int(c), j, int(counts[c]) if j == 0 else 0, limb)
               for c in np.flatnonzero(counts) for j, limb in enumerate(_limbs([int(x) for x in sums[c]]))]
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(
                zip(*out, strict=True), (pa.int32(), pa.int32(), pa.int64(), pa.list_(pa.int64())), strict=True)], names=["cluster", "limb", "n", "s"])

    parts = python_pass(rows, add, "cluster int, limb int, n long, s array<long>")
    added = parts.groupBy("cluster", "limb").agg(F.sum("n"), *[F.sum(F.col("s")[i]) for i in range(dim)]).collect()   # k rows per limb
    total: dict[int, list[int]] = {}
    count: dict[int, int] = {}
    for c, limb, n, *s in added:
        total[c] = [a + (b << LIMB * limb) for a, b in zip(total.get(c, [0] * dim), s, strict=True)]
        count[c] = count.get(c, 0) + n
    out = centroids.copy()
    for c in total:
        out[c] = [t // count[c] for t in total[c]]
    return out


def cluster_vectors(rows: DataFrame, k: int = 40, rounds: int = 5, dim: int = 64, scale: int = 256, salt: str = "2:",
                    id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """k-means of the vectors floor(scale * x), exact in integers.

    Kept are rows whose vector has ``dim`` components, none null or
    non-finite; all others are left out.  The first centroids are the ``k``
    kept vectors with the smallest SHA-256 of ``salt`` and id (ties of
    repeated ids: smaller vector; rows without an id come last); with fewer
    vectors every one is a centroid.  Each round assigns all vectors (ties:
    smaller number), then moves every non-empty centroid to the floored mean;
    a last assignment follows.

    Returns per kept row: id, ``cluster`` int, ``distance`` (squared),
    ``cluster_inertia`` and ``inertia`` (its sums) and ``centroid_sha256``.
    Numbers beyond 64 bits are null, though the clusters are right.  Repeated
    rows keep a row each, other columns are ignored whatever their names, no
    kept vector gives an empty result.  ``rows`` is read once per round: pass
    a stored table.
    """
    spark = rows.sparkSession
    plain = rows.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<double>").alias("v"))
    plain = plain.where((F.size("v") == dim) & F.forall("v", lambda x: x.isNotNull() & (F.abs(x) < F.lit(float("inf")))))
    key = F.sha2(F.concat(F.lit(salt), F.col("id").cast("string")), 256)
    first = plain.orderBy(key.asc_nulls_last(), "v").limit(k).collect()
    schema = T.StructType([T.StructField(id_col, T.LongType()), T.StructField("cluster", T.IntegerType()), *(
        T.StructField(c, T.LongType()) for c in ("distance", "cluster_inertia", "inertia")), T.StructField("centroid_sha256", T.StringType())])
    if not first:
        return spark.createDataFrame([], schema)
    centroids = np.array([[scaled(x, scale) for x in r.v] for r in first], dtype=object)
    for _ in range(rounds):
        centroids = _means(plain, centroids, dim, scale)

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, points in _batches(batches, dim, scale):
            cluster, far, _ = orchard(points, centroids)
            exact = pa.array([d if d < LONG else None for d in far.tolist()], pa.int64())
            yield pa.RecordBatch.from_arrays([ids, pa.array(cluster.astype(np.int32)), exact], names=["id", "cluster", "distance"])

    found = written(python_pass(plain, assign, "id long, cluster int, distance long"))
    big = F.sum(F.col("distance").cast("decimal(38,0)"))
    sums = found.groupBy("cluster").agg(F.when(F.count("distance") == F.count("*"), big).alias("s")).collect()          # k rows
    each = {r.cluster: None if r.s is None else int(r.s) for r in sums}
    whole = None if None in each.values() else sum(each.values())
    digest = [hashlib.sha256(",".join(str(x) for x in c).encode()).hexdigest() for c in centroids.tolist()]
    fits = (lambda x: x if x is not None and x < LONG else None)
    facts = spark.createDataFrame([(c, fits(s), fits(whole), digest[c]) for c, s in each.items()],
                                  "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return found.join(F.broadcast(facts), "cluster").select(F.col("id").alias(id_col), *schema.names[1:])   # at most k rows are broadcast
