"""Centroid clustering (Lloyd's rounds on integer vectors) with PCA-rotated filtering.

A kept vector has exactly ``DIMS`` components, none null or non-finite; each
becomes the integer floor(1024 * x).  The first centroids are the ``k`` kept
vectors with the smallest sha256 of ``<seed>:<vec_id>``.

**Filter.**  One pass sums the 65 x 65 moments (per partition, then by row of the
matrix); their 64 x 64 covariance gives the principal axes.  Each vector is
written once with its ``LEADING`` rotated coordinates p and the norm rho of the
rest.  Since the axes are orthonormal and the rests obey the triangle
inequality, |x - c|^2 >= |p_x - p_c|^2 + (rho_x - rho_c)^2.  A vector's exact
distance to the centroid of the least bound is computed in integers; only
centroids whose bound does not exceed it are verified, in integers too.  The
bound is lowered by ``SLACK`` of the largest norm, far above double rounding, so
axes and rounding decide how much is verified, never the result.

**Rounds.**  A task returns a count and exact 64-bit sums per centroid; Spark
adds them and the driver gets at most ``k`` rows, whatever the input.  A round
that changes no centroid ends the loop, as all later ones would be equal.

Results that are defined for odd input: rows with a null or unfit vector are
left out; a null ``vec_id`` is kept and sorts last among the first centroids;
repeated rows count and are returned each; fewer than ``k`` vectors give that
many centroids; equal distances go to the smaller number; an empty table gives
no rows; other columns are ignored.  Integers of 2^26 and more raise an error,
since their squared distances would leave 64 bits.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize, ship_package

DIMS = 64
#: leading rotated coordinates kept beside the residual norm
LEADING = 12
SLACK = 1e-9
LIMIT = 2 ** 26
RESULT = "vec_id long, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string"


class Rotation:
    """Leading principal axes about a centre: rows (coordinates ..., residual norm)."""

    def __init__(self, centre: np.ndarray, axes: np.ndarray):
        self.centre, self.axes = centre, axes

    @classmethod
    def of(cls, moments: np.ndarray, leading: int) -> Rotation:
        n = moments[-1, -1]
        centre = moments[-1, :-1] / n
        _, vectors = np.linalg.eigh(moments[:-1, :-1] / n - np.outer(centre, centre))
        return cls(centre, np.ascontiguousarray(vectors[:, ::-1][:, :leading]))

    def __call__(self, x: np.ndarray) -> np.ndarray:
        away = x - self.centre
        led = away @ self.axes
        rest = away - led @ self.axes.T
        return np.column_stack([led, np.sqrt(np.einsum("ij,ij->i", rest, rest))])


def distances(x: np.ndarray, centroid: np.ndarray) -> np.ndarray:
    apart = x - centroid
    return np.einsum("ij,ij->i", apart, apart)


def nearest(x: np.ndarray, rotated: np.ndarray, centroids: np.ndarray, rotated_c: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """Number of the nearest centroid, squared distance (both exact), and how many distances were computed."""
    bound = np.stack([((rotated - c) ** 2).sum(axis=1) for c in rotated_c], axis=1)
    scale = np.sqrt(max((rotated ** 2).sum(axis=1).max(initial=0), (rotated_c ** 2).sum(axis=1).max(initial=0)))
    bound = np.maximum(np.sqrt(bound) * (1 - SLACK) - SLACK * scale, 0) ** 2 * (1 - SLACK)
    number = bound.argmin(axis=1)
    best = np.empty(len(x), np.int64)
    for k in range(len(centroids)):
        rows = np.flatnonzero(number == k)
        best[rows] = distances(x[rows], centroids[k])
    first, verified = number.copy(), len(x)
    for k in range(len(centroids)):
        rows = np.flatnonzero((bound[:, k] <= best) & (first != k))
        d = distances(x[rows], centroids[k])
        closer = (d < best[rows]) | ((d == best[rows]) & (k < number[rows]))
        best[rows[closer]], number[rows[closer]] = d[closer], k
        verified += len(rows)
    return number, best, verified


def _matrix(column: pa.Array, width: int, kind: type) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, width).astype(kind, copy=False)


def _moments(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = np.zeros((DIMS + 1, DIMS + 1))
    for batch in batches:
        x = np.column_stack([_matrix(batch.column("v"), DIMS, np.float64), np.ones(batch.num_rows)])
        total += x.T @ x
    yield pa.RecordBatch.from_arrays([pa.array(range(DIMS + 1), pa.int32()), pa.array(list(total), pa.list_(pa.float64()))], ["i", "m"])


def _rotated(turn: Rotation):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            r = turn(_matrix(batch.column("v"), DIMS, np.float64))
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), batch.column("v"), pa.array(list(r), pa.list_(pa.float64()))], ["vec_id", "v", "r"])
    return run


def _assigned(batch: pa.RecordBatch, centroids: np.ndarray, rotated_c: np.ndarray):
    x = _matrix(batch.column("v"), DIMS, np.int64)
    return x, *nearest(x, _matrix(batch.column("r"), rotated_c.shape[1], np.float64), centroids, rotated_c)


def _sums(centroids: np.ndarray, rotated_c: np.ndarray):
    """Per centroid of one task: count, exact sums, and how many distances were computed."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        k = len(centroids)
        n, s, tried = np.zeros(k, np.int64), np.zeros((k, DIMS), np.int64), np.zeros(k, np.int64)
        for batch in batches:
            x, number, _, verified = _assigned(batch, centroids, rotated_c)
            tried[0] += verified
            for c in range(k):
                rows = number == c
                n[c] += rows.sum()
                s[c] += x[rows].sum(axis=0)
        yield pa.RecordBatch.from_arrays([pa.array(range(k), pa.int32()), pa.array(n), pa.array(list(s), pa.list_(pa.int64())), pa.array(tried)],
                                         ["cluster", "n", "s", "verified"])
    return run


def _labels(centroids: np.ndarray, rotated_c: np.ndarray):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            _, number, best, _ = _assigned(batch, centroids, rotated_c)
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), pa.array(number.astype(np.int32)), pa.array(best)], ["vec_id", "cluster", "distance"])
    return run


def kept_vectors(vectors: DataFrame) -> DataFrame:
    """vec_id and the integer components ``v`` of every fit vector."""
    fit = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return (vectors.filter((F.size("embedding") == DIMS) & fit)
            .select("vec_id", F.transform("embedding", lambda x: F.floor(F.lit(1024.0) * x.cast("double"))).alias("v")))


def clustered(vectors: DataFrame, k: int = 8, rounds: int = 10, seed: int = 3, leading: int = LEADING,
              report: list[tuple[int, int]] | None = None) -> DataFrame:
    """vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256 for every kept vector.

    ``report`` gets per round how many distances the filter let through and how many there were.
    """
    spark = vectors.sparkSession
    ship_package(spark)
    ints = materialize(kept_vectors(vectors), "centroid_ints")
    top = ints.agg(F.max(F.greatest(F.array_max("v"), -F.array_min("v")))).first()[0]
    if top is None:
        return spark.createDataFrame([], RESULT)
    if top >= LIMIT:
        raise ValueError(f"components must stay below {LIMIT} in size: {top}")

    drawn = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256)
    first = ints.orderBy(drawn.asc_nulls_last(), "vec_id", "v").limit(k).collect()
    centroids = np.array([row["v"] for row in first], np.int64)

    sums = ints.mapInArrow(_moments, "i int, m array<double>").groupBy("i").agg(Summarizer.sum(array_to_vector("m")).alias("m"))
    moments = np.array([row["m"] for row in sums.orderBy("i").select(vector_to_array("m").alias("m")).collect()])
    turn = Rotation.of(moments, leading)
    rows = materialize(ints.mapInArrow(_rotated(turn), "vec_id long, v array<long>, r array<double>"), "centroid_rows")

    for _ in range(rounds):
        parts = rows.select("v", "r").mapInArrow(_sums(centroids, turn(centroids)), "cluster int, n long, s array<long>, verified long")
        told = parts.groupBy("cluster").agg(F.sum("n").alias("n"), F.sum("verified").alias("verified"),
                                            *(F.sum(F.col("s")[i]).alias(f"s{i}") for i in range(DIMS))).collect()
        if report is not None:
            report.append((sum(t["verified"] for t in told), len(centroids) * sum(t["n"] for t in told)))
        moved = centroids.copy()
        for t in told:
            if t["n"]:
                moved[t["cluster"]] = [t[f"s{i}"] // t["n"] for i in range(DIMS)]
        if (moved == centroids).all():
            break
        centroids = moved

    labels = materialize(rows.mapInArrow(_labels(centroids, turn(centroids)), "vec_id long, cluster int, distance long"), "centroid_labels")
    inertia = dict(labels.groupBy("cluster").agg(F.sum("distance")).collect())
    digests = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids.tolist()]
    told = spark.createDataFrame([(c, inertia.get(c, 0), sum(inertia.values()), digest) for c, digest in enumerate(digests)],
                                 "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")   # k rows
    return (labels.join(F.broadcast(told), "cluster")
            .select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"))
