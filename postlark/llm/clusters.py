"""Centroid clustering of integer vectors by progressive search in the Walsh-Hadamard domain."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postlark.session import stage

DIMS = 64
SCALE = 64
CLUSTERS = 16
ROUNDS = 3
LEVELS = (0, 1, 2, 4, 8, 16, 32, 64)
LARGEST = 2**27  # components beyond are taken for it, so that every distance fits a long
FAST_LARGEST = 2**23  # up to here sums of squared coefficients fit a long
RESULTS = ("cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
_LONGEST = 2**63 - 1


def finite(vector: Column) -> Column:
    """Whether a vector is there with all its components, none of them infinite or not a number."""
    return F.coalesce(
        F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))), F.lit(False))


def integers(vector: Column, scale: int, largest: int) -> Column:
    """The components as floor(scale * x), between -largest and largest."""
    return F.transform(vector, lambda x: F.floor(
        F.greatest(F.least(x.cast("double") * scale, F.lit(float(largest))), F.lit(float(-largest)))).cast("long"))


def transform(rows: np.ndarray) -> np.ndarray:
    """The Walsh-Hadamard transform of each row, exactly, with the coefficients that change sign least often first."""
    out, half = rows, 1
    while half < rows.shape[1]:
        pairs = out.reshape(len(rows), -1, 2, half)
        out = np.stack([pairs[:, :, 0] + pairs[:, :, 1], pairs[:, :, 0] - pairs[:, :, 1]], axis=2).reshape(rows.shape)
        half *= 2
    return out[:, _sequency(rows.shape[1])]


def _sequency(dims: int) -> np.ndarray:
    signs = np.array([[(i & j).bit_count() & 1 for j in range(dims)] for i in range(dims)])
    return np.argsort(np.abs(np.diff(signs, axis=1)).sum(axis=1), kind="stable")


def nearest(vectors: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each vector the number of the nearest centroid, the smaller one among equals, and the squared distance.

    Squared coefficient differences add up, coarse ones first, to 64 times the distance. What the fine ones can still add
    lies between the squared difference and sum of the two remaining lengths. A centroid whose lower bound exceeds
    another's upper bound is strictly worse and left out; the others are summed over all coefficients.
    """
    dims, largest = vectors.shape[1], max(map(abs, (vectors.max(initial=0), vectors.min(initial=0), centroids.max(), centroids.min())))
    kind = np.int64 if largest <= FAST_LARGEST else object
    x, c = transform(vectors.astype(kind)), transform(centroids.astype(kind))
    sums = np.zeros((len(x), len(c)), kind)
    alive = np.ones(sums.shape, bool)
    x_left, c_left = (x * x).sum(axis=1).astype(float), (c * c).sum(axis=1).astype(float)
    for low, high in zip(LEVELS, LEVELS[1:], strict=False):
        for j in range(len(c)):
            rows = np.flatnonzero(alive[:, j])
            apart = x[rows, low:high] - c[j, low:high]
            sums[rows, j] += (apart * apart).sum(axis=1)
        if high < dims:
            x_left = np.maximum(x_left - (x[:, low:high] ** 2).sum(axis=1).astype(float), 0)
            c_left = np.maximum(c_left - (c[:, low:high] ** 2).sum(axis=1).astype(float), 0)
            now, middle = sums.astype(float), x_left[:, None] + c_left
            reach = 2 * np.sqrt(x_left)[:, None] * np.sqrt(c_left)
            slack = 1 + 1e-9 * (now + middle + reach)  # wider than what floats can lose
            best = np.where(alive, now + middle + reach + slack, np.inf).min(axis=1)
            alive &= now + middle - reach - slack <= best[:, None]
    whole = np.where(alive, sums, dims * 2**63 if kind is object else 2**62)
    chosen = whole.argmin(axis=1).astype(np.int64)
    return chosen, (whole[np.arange(len(x)), chosen] // dims).astype(np.int64)


def _matrix(column: pa.Array, dims: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dims)


def _summed(centroids: np.ndarray):
    """Counts and componentwise sums of the vectors of each cluster, a task's share of them."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(len(centroids), np.int64)
        sums = np.zeros(centroids.shape, object)
        for batch in batches:
            vectors = _matrix(batch.column("ints"), centroids.shape[1])
            chosen, _ = nearest(vectors, centroids)
            counts += np.bincount(chosen, minlength=len(centroids))
            for j in np.unique(chosen):
                sums[j] += vectors[chosen == j].sum(axis=0)
        found = np.flatnonzero(counts)
        places = range(centroids.shape[1])
        yield pa.RecordBatch.from_arrays([
            pa.array([int(j) for j in found for _ in places], pa.int32()),
            pa.array([i for _ in found for i in places], pa.int32()),
            pa.array([int(counts[j]) for j in found for _ in places], pa.int64()),
            pa.array([Decimal(int(sums[j, i])) for j in found for i in places], pa.decimal128(38, 0)),
        ], names=["cluster", "place", "n", "total"])

    return task


def _assigned(centroids: np.ndarray):
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            chosen, distance = nearest(_matrix(batch.column("ints"), centroids.shape[1]), centroids)
            yield pa.RecordBatch.from_arrays(
                [batch.column("_row"), pa.array(chosen, pa.int32()), pa.array(distance, pa.int64())], names=["_row", "cluster", "distance"])

    return task


def _moved(vectors: DataFrame, centroids: np.ndarray) -> np.ndarray:
    """The centroids after a round: the floor of the mean of each cluster's vectors, an empty cluster's as it was."""
    shares = vectors.select("ints").mapInArrow(_summed(centroids), "cluster int, place int, n long, total decimal(38,0)")
    after = centroids.copy()
    for r in shares.groupBy("cluster", "place").agg(F.sum("n").alias("n"), F.sum("total").cast("decimal(38,0)").alias("total")).collect():
        after[r.cluster, r.place] = int(r.total) // r.n  # a row for each cluster and component, whatever the input
    return after


def digest(centroid: Sequence[int]) -> str:
    return hashlib.sha256(",".join(str(int(x)) for x in centroid).encode()).hexdigest()


def cluster(rows: DataFrame, key: str = "vec_id", vector: str = "embedding", keep: Sequence[str] = (), clusters: int = CLUSTERS,
            rounds: int = ROUNDS, scale: int = SCALE, dims: int = DIMS, seed: str = "1") -> DataFrame:
    """``key`` and the columns in ``keep`` of every vector of ``dims`` finite components (a power of two up to 64), with its
    ``cluster``, squared ``distance``, ``cluster_inertia``, ``inertia`` and ``centroid_sha256``.

    Components become floor(scale * x). The first centroids are the vectors whose ``seed:key`` has the smallest SHA-256. In
    each round every task sends its share of each cluster's count and sums, so what is shuffled grows with tasks, not rows,
    and only the centroids themselves come to the driver.

    Vectors that are null, of another size or with a null or non-finite component are left out. With fewer vectors than
    ``clusters`` there are as many clusters as vectors; no vectors give no rows. Repeated rows count as often as they stand
    there, also as first centroids (equal hashes go by components); a null key comes last among these. Components beyond
    2**27 count as 2**27; inertias beyond a long as the largest long. Columns not named are ignored; columns of ``keep``
    that are called like a result are replaced by it.
    """
    names = [c for c in dict.fromkeys([key, *keep]) if c.lower() not in RESULTS]
    whole = rows.filter((F.size(vector) == dims) & finite(F.col(vector)))
    vectors = stage(whole.select(
        F.struct(*names).alias("_row"), F.col(key).cast("string").alias("_key"), integers(F.col(vector), scale, LARGEST).alias("ints")), "vectors")
    first = vectors.select(F.sha2(F.concat(F.lit(f"{seed}:"), F.col("_key")), 256).alias("h"), "ints").orderBy(
        F.col("h").asc_nulls_last(), "ints").limit(clusters).collect()
    results = "cluster int, distance long"
    kept = f"_row {vectors.schema['_row'].dataType.simpleString()}"
    if not first:
        none = vectors.select("_row.*").limit(0)
        return none.select("*", *[F.lit(None).cast(t).alias(c) for c, t in zip(RESULTS, ("int", "long", "long", "long", "string"), strict=True)])
    centroids = np.array([r.ints for r in first], np.int64)
    for _ in range(rounds):
        centroids = _moved(vectors, centroids)
    assigned = stage(vectors.select("_row", "ints").mapInArrow(_assigned(centroids), f"{kept}, {results}"), "assigned")
    inertia = {r.cluster: int(r.inertia) for r in assigned.groupBy("cluster").agg(
        F.sum(F.col("distance").cast("decimal(20,0)")).cast("decimal(38,0)").alias("inertia")).collect()}
    total = min(sum(inertia.values()), _LONGEST)
    of_cluster = vectors.sparkSession.createDataFrame(
        [(j, min(n, _LONGEST), total, digest(centroids[j])) for j, n in sorted(inertia.items())],
        "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return assigned.join(F.broadcast(of_cluster), "cluster").select("_row.*", *RESULTS)  # a row for each cluster
