"""Operator 11: centroid clustering over a zone map in the order of a space-filling curve.

Vectors are turned into integers, projected to the ``AXES`` directions of largest variance and sorted by their
place on a Hilbert curve through these axes. Runs of ``BLOCK`` neighbours are stored as one row with the smallest
and largest value of each component: the block's box. In every round a block keeps as candidates the centroids
that are not, by the box alone, farther from every point of it than another centroid; its vectors are compared
with the candidates only, exactly and all at once. Whatever the curve does, results are exact: it decides how
tight the boxes are.

Blocks are written once and read in each round. A task returns one partial sum for each centroid that it used;
Spark adds them up, and the driver receives at most ``clusters`` x components sums.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voltlake.llm.common import written

DIMENSIONS, SCALE = 64, 256
CLUSTERS, ROUNDS, SEED = 40, 5, 2
#: Axes and bits for each of the curve: at most 63 bits together.
AXES, BITS = 9, 7
BLOCK = 512
#: Integers are below this, so that squared distances of 64 components fit into 64 bits.
LARGEST = 1 << 28
#: Up to this size products of 64 components are exact in doubles, so that matrix products may be used.
EXACT = 1 << 22

BLOCK_SCHEMA = "ids array<bigint>, vectors binary, low array<bigint>, high array<bigint>"


def integer_vectors(rows: DataFrame, dimensions: int = DIMENSIONS, scale: int = SCALE) -> DataFrame:
    """``vec_id, v`` (array of bigint) of vectors with ``dimensions`` components, none null or not finite."""
    x = F.transform("embedding", lambda c: F.floor(c.cast("double") * scale))
    usable = (F.size("embedding") == dimensions) & F.forall(
        "embedding", lambda c: F.coalesce(F.abs(c.cast("double") * scale) < LARGEST, F.lit(False))
    )
    return rows.where(F.coalesce(usable, F.lit(False))).select("vec_id", x.alias("v"))


def matrix(column: pa.Array, dimensions: int) -> np.ndarray:
    return column.flatten().to_numpy().reshape(-1, dimensions)


def principal_axes(vectors: DataFrame, dimensions: int, axes: int) -> tuple[np.ndarray, np.ndarray]:
    """Directions of largest variance of all vectors, in units of their deviation, and the mean of all.

    A task sends its sums only.
    """
    width = dimensions * (dimensions + 1)

    def moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count, total = 0, np.zeros(width)
        for batch in batches:
            x = matrix(batch.column(1), dimensions).astype(np.float64)
            count += len(x)
            total += np.concatenate([x.sum(axis=0), (x.T @ x).reshape(-1)])
        rows = [pa.array(np.full(width, count)), pa.array(np.arange(width)), pa.array(total)]
        yield pa.record_batch(rows, ["n", "k", "total"])

    sums = vectors.mapInArrow(moments, "n bigint, k bigint, total double").groupBy("k")
    rows = sorted(map(tuple, sums.agg(F.sum("n"), F.sum("total")).collect()))
    if not rows or not rows[0][1]:
        return np.eye(dimensions)[:, :axes], np.zeros(dimensions)
    total = np.array([r[2] for r in rows]) / rows[0][1]
    mean, square = total[:dimensions], total[dimensions:].reshape(dimensions, dimensions)
    variance, directions = np.linalg.eigh(square - np.outer(mean, mean))
    return (directions / np.sqrt(np.maximum(variance, 1)))[:, ::-1][:, :axes], mean


def hilbert(cells: np.ndarray, bits: int) -> np.ndarray:
    """Place of each row of ``cells`` (integers of ``bits`` bits) on the Hilbert curve.

    After Skilling, "Programming the Hilbert curve" (2004). From the highest bit down, the sub-cube of a point is found in the curve's current frame: an entry corner
    and an axis order, which are changed by reflection and exchange as the curve goes on within the sub-cube.
    """
    x = cells.astype(np.int64).copy()
    axes = x.shape[1]
    for level in range(bits - 1, 0, -1):
        below = (1 << level) - 1
        for k in range(axes):
            inside = (x[:, k] >> level & 1).astype(bool)
            x[inside, 0] ^= below
            swap = np.where(inside, 0, (x[:, 0] ^ x[:, k]) & below)
            x[:, 0] ^= swap
            x[:, k] ^= swap
    for k in range(1, axes):
        x[:, k] ^= x[:, k - 1]
    flip = np.zeros(len(x), dtype=np.int64)
    for level in range(bits - 1, 0, -1):
        flip ^= np.where(x[:, -1] >> level & 1, (1 << level) - 1, 0)
    x ^= flip[:, None]
    place = np.zeros(len(x), dtype=np.int64)
    for level in range(bits - 1, -1, -1):
        for k in range(axes):
            place = place << 1 | (x[:, k] >> level & 1)
    return place


def blocks(vectors: DataFrame, dimensions: int = DIMENSIONS, block: int = BLOCK, axes: int = AXES) -> DataFrame:
    """Zone map of ``vectors``: neighbours on the curve as one row with their box."""
    axes = min(axes, dimensions)
    directions, mean = principal_axes(vectors, dimensions, axes)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = (matrix(batch.column(1), dimensions) - mean) @ directions
            # Half of the cells for values within one standard deviation, the rest for all others.
            cells = np.floor((0.5 + np.arctan(x) / np.pi) * (1 << BITS))
            cells = np.clip(cells, 0, (1 << BITS) - 1)
            yield pa.record_batch([*batch.columns, pa.array(hilbert(cells, BITS))], ["vec_id", "v", "place"])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = matrix(batch.column(1), dimensions)
            for start in range(0, len(x), block):
                own = x[start : start + block]
                columns = [
                    pa.array([batch.column(0).slice(start, block).to_pylist()], pa.list_(pa.int64())),
                    pa.array([own.astype("<i4").tobytes()], pa.binary()),
                    *(pa.array([e.tolist()], pa.list_(pa.int64())) for e in (own.min(axis=0), own.max(axis=0))),
                ]
                yield pa.record_batch(columns, ["ids", "vectors", "low", "high"])

    placed = vectors.mapInArrow(place, "vec_id bigint, v array<bigint>, place bigint")
    # The id as well, so that copies of one vector may be spread over tasks.
    order = placed.repartitionByRange("place", "vec_id").sortWithinPartitions("place", "vec_id")
    return order.mapInArrow(cut, BLOCK_SCHEMA)


def candidates(low: np.ndarray, high: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """Centroids that can be nearest (ties included) to a point of the box ``low`` to ``high``.

    A centroid is out if its smallest distance to the box is above another's largest, or if the one nearest
    to the middle of the box is nearer at every point: the difference of two squared distances is linear, so its
    extreme over the box lies in a corner that each component chooses for itself.
    """
    nearest = np.maximum(np.maximum(low - centroids, centroids - high), 0)
    farthest = np.maximum(np.abs(centroids - low), np.abs(centroids - high))
    within = np.flatnonzero((nearest**2).sum(axis=1) <= (farthest**2).sum(axis=1).min())
    middle = (low + high) // 2
    best = centroids[within[((centroids[within] - middle) ** 2).sum(axis=1).argmin()]]
    # |x - best|^2 - |x - c|^2 = 2 x (c - best) + best^2 - c^2, at its largest over the box.
    c = centroids[within]
    corner = np.where(c > best, high, low)
    ahead = ((c - best) * (2 * corner - best - c)).sum(axis=1)
    return within[ahead >= 0]


def nearest(vectors: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Place of the first nearest centroid of each vector and the squared distance, exactly."""
    largest = max(np.abs(vectors).max(initial=0), np.abs(centroids).max(initial=0))
    if largest < EXACT:
        x, c = vectors.astype(np.float64), centroids.astype(np.float64)
        distance = (x * x).sum(axis=1)[:, None] - 2 * (x @ c.T) + (c * c).sum(axis=1)
        at = distance.argmin(axis=1)
        return at, distance[np.arange(len(at)), at].astype(np.int64)
    at, best = np.zeros(len(vectors), dtype=np.int64), None
    for k, c in enumerate(centroids):
        distance = ((vectors - c) ** 2).sum(axis=1)
        if best is None:
            best = distance
        closer = distance < best
        at[closer], best[closer] = k, distance[closer]
    return at, best


def assigned(batch: pa.RecordBatch, centroids: np.ndarray) -> Iterator[tuple[list, np.ndarray, np.ndarray, np.ndarray]]:
    """Ids, vectors, cluster and squared distance of each block."""
    dimensions = centroids.shape[1]
    for k in range(batch.num_rows):
        low, high = (np.array(batch.column(c)[k].as_py()) for c in (2, 3))
        own = candidates(low, high, centroids)
        x = np.frombuffer(batch.column(1)[k].as_py(), dtype="<i4").reshape(-1, dimensions).astype(np.int64)
        at, distance = nearest(x, centroids[own])
        yield batch.column(0)[k].as_py(), x, own[at], distance


def first_centroids(vectors: DataFrame, clusters: int, seed: int) -> np.ndarray:
    """The vectors whose ids have the smallest hashes, in their order; equal ids by their components."""
    key = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("vec_id").cast("string"), F.lit(""))), 256)
    rows = vectors.select(key.alias("key"), "v").orderBy("key", "v").limit(clusters).collect()
    return np.array([r["v"] for r in rows], dtype=np.int64)


def moved(zones: DataFrame, centroids: np.ndarray) -> np.ndarray:
    """Each centroid replaced by the rounded-down mean of its vectors, if it has any."""
    shared = zones.sparkSession.sparkContext.broadcast(centroids)
    clusters, dimensions = centroids.shape

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = np.zeros(clusters, dtype=np.int64)
        total = np.zeros((clusters, dimensions), dtype=np.int64)
        for batch in batches:
            for _, x, cluster, _ in assigned(batch, shared.value):
                order = np.argsort(cluster, kind="stable")
                found, first = np.unique(cluster[order], return_index=True)
                total[found] += np.add.reduceat(x[order], first)
                count += np.bincount(cluster, minlength=clusters)
        used = np.flatnonzero(count)
        columns = [
            pa.array(np.repeat(used, dimensions)),
            pa.array(np.tile(np.arange(dimensions), len(used))),
            pa.array(np.repeat(count[used], dimensions)),
            pa.array(total[used].reshape(-1)),
        ]
        yield pa.record_batch(columns, ["cluster", "k", "n", "total"])

    sums = zones.mapInArrow(add, "cluster bigint, k bigint, n bigint, total bigint").groupBy("cluster", "k")
    out = centroids.copy()
    wide = F.sum(F.col("total").cast("decimal(38,0)"))
    for cluster, k, n, total in sums.agg(F.sum("n"), wide).collect():
        out[cluster, k] = int(total) // n
    return out


def clusters(
    rows: DataFrame,
    clusters: int = CLUSTERS,
    rounds: int = ROUNDS,
    seed: int = SEED,
    dimensions: int = DIMENSIONS,
    block: int = BLOCK,
) -> DataFrame:
    """``vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256`` of every vector kept.

    Of ``rows`` (vec_id bigint, embedding array) vectors with exactly ``dimensions`` components, none null or not
    finite, take part as integers floor(256 * x). Components of 2**20 and more would not give distances of 64
    bits; vectors with one are left out like those that are not finite. Repeated rows count again, each with its
    result; a null vec_id is hashed as an empty one. With fewer vectors than ``clusters`` each starts a
    centroid; of equal centroids the first takes all. Without vectors there are no rows. Other columns are not read.
    """
    spark = rows.sparkSession
    vectors = written(integer_vectors(rows, dimensions), "vectors")
    zones = written(blocks(vectors, dimensions, block), "zones")
    centroids = first_centroids(vectors, clusters, seed)
    if len(centroids):
        for _ in range(rounds):
            centroids = moved(zones, centroids)
    else:
        centroids = np.zeros((1, dimensions), dtype=np.int64)
    shared = spark.sparkContext.broadcast(centroids)

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for ids, _, cluster, distance in assigned(batch, shared.value):
                columns = [pa.array(ids, pa.int64()), pa.array(cluster, pa.int32()), pa.array(distance, pa.int64())]
                yield pa.record_batch(columns, ["vec_id", "cluster", "distance"])

    found = written(zones.mapInArrow(assign, "vec_id bigint, cluster int, distance bigint"), "clusters")
    # At most one row a centroid.
    sums = dict(map(tuple, found.groupBy("cluster").agg(F.sum("distance")).collect()))
    total = sum(sums.values())
    digests = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids.tolist()]
    about = spark.createDataFrame(
        [(k, sums[k], total, digests[k]) for k in sorted(sums)],
        "cluster int, cluster_inertia bigint, inertia bigint, centroid_sha256 string",
    )
    return found.join(F.broadcast(about), "cluster").select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"
    )
