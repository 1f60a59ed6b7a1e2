"""Centroid clustering of integer vectors, with N-simplex projection as the filter.

A few pivots are chosen once. The distances from a vector to the pivots fix its apex over the simplex of the pivots:
coordinates in as many dimensions as there are pivots, the last one being its height above the pivots' span. Between
two apexes the Euclidean distance is a lower bound of the distance of the vectors, and the distance to the apex
mirrored at the span is an upper one. The apexes are computed once and stored with the vectors; in each round a
centroid is compared in whole numbers only with the vectors whose lower bound does not exceed their least upper one.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from .common import stored

COMPONENTS = 64
SCALE = 64
CENTROIDS = 16
ROUNDS = 3
PIVOTS = 8
#: Components beyond this magnitude count as this much, so that squared distances fit a long.
LIMIT = 1 << 27
#: A pivot must be so far above the span of the others, as a share of the largest distance between pivots.
HEIGHT = 0.02
#: What rounding may add to a bound, as a share of the distances it was computed from.
SLACK = 1e-5
#: Rows are compared in pieces of so many.
PIECE = 4096


class Simplex:
    """The base simplex of some pivots (rows of whole numbers); the first pivot is its origin.

    ``base`` holds the pivots' coordinates, a triangle: pivot i has i of them. Pivots that lie (nearly) in the span
    of those before are left out, so there may be fewer than offered, down to one.
    """

    def __init__(self, candidates: np.ndarray, count: int = PIVOTS):
        chosen, base = [0], np.zeros((1, 0))
        if len(candidates) > 1:
            gaps = _squared(candidates, candidates).astype(float)
            widest = np.sqrt(gaps.max())
            while len(chosen) < min(count, len(candidates)) and widest > 0:
                apexes = _apexes(base, gaps[:, chosen])
                best = int(np.argmax(apexes[:, -1]))
                if best in chosen or apexes[best, -1] < HEIGHT * widest:
                    break
                base = np.vstack([np.hstack([base, np.zeros((len(base), 1))]), apexes[best]])
                chosen.append(best)
        self.pivots, self.base = candidates[chosen], base

    def apexes(self, vectors: np.ndarray) -> np.ndarray:
        """A row of coordinates per vector, the last its height above the pivots."""
        return _apexes(self.base, _squared(vectors, self.pivots).astype(float))


def _squared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact squared distances of the rows of ``a`` to the rows of ``b``."""
    return np.stack([((a.astype(np.int64) - row.astype(np.int64)) ** 2).sum(axis=1) for row in b], axis=1)


def _apexes(base: np.ndarray, gaps: np.ndarray) -> np.ndarray:
    """Apex coordinates from squared distances to the pivots, coordinate by coordinate along the triangle."""
    out = np.zeros((len(gaps), base.shape[1] + 1))
    for i in range(1, len(base)):
        known = out[:, :i - 1] @ base[i, :i - 1]
        out[:, i - 1] = ((gaps[:, 0] - gaps[:, i] + (base[i] ** 2).sum()) / 2 - known) / base[i, i - 1]
    out[:, -1] = np.sqrt(np.maximum(gaps[:, 0] - (out[:, :-1] ** 2).sum(axis=1), 0))
    return out


def bounds(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Lower and upper bounds of the distances between the vectors behind two sets of apexes, widened by what
    rounding may change."""
    flat = ((a[:, None, :-1] - b[None, :, :-1]) ** 2).sum(axis=2)
    low = np.sqrt(flat + (a[:, None, -1] - b[None, :, -1]) ** 2)
    high = np.sqrt(flat + (a[:, None, -1] + b[None, :, -1]) ** 2)
    slack = SLACK * (1 + np.sqrt((a ** 2).sum(axis=1))[:, None] + np.sqrt((b ** 2).sum(axis=1))[None, :])
    return low - slack, high + slack


def nearest(vectors: np.ndarray, apexes: np.ndarray, centroids: np.ndarray, tops: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """Number and exact squared distance of the nearest centroid of each vector (the smaller number wins a tie), and
    how many exact distances that took."""
    numbers, distances, exact = [], [], 0
    centroids = centroids.astype(np.int64)
    for at in range(0, len(vectors), PIECE):
        some = vectors[at:at + PIECE].astype(np.int64)
        low, high = bounds(apexes[at:at + PIECE], tops)
        rows, tried = np.nonzero(low <= high.min(axis=1, keepdims=True))
        found = np.full((len(some), len(centroids)), np.iinfo(np.int64).max)
        for k in range(len(centroids)):
            mine = rows[tried == k]
            found[mine, k] = ((some[mine] - centroids[k]) ** 2).sum(axis=1)
        best = found.argmin(axis=1)
        numbers.append(best)
        distances.append(found[np.arange(len(some)), best])
        exact += len(rows)
    return (np.concatenate(numbers), np.concatenate(distances), exact) if numbers else (np.zeros(0, int), np.zeros(0, int), 0)


# The frames.

def _whole(batch: pa.RecordBatch) -> np.ndarray:
    """The vectors of a batch as whole numbers."""
    values = batch.column("_v").flatten().to_numpy(zero_copy_only=False)
    return np.clip(np.floor(values * SCALE), -LIMIT, LIMIT).astype(np.int32).reshape(batch.num_rows, -1)


def _matrix(column: pa.Array, kind) -> np.ndarray:
    """A column of equally long byte strings as the rows of a matrix."""
    return np.frombuffer(b"".join(column.to_pylist()), kind).reshape(len(column), -1)


def usable(vectors: DataFrame, id_col: str, vector_col: str, components: int) -> DataFrame:
    """``_id`` and ``_v`` of the rows whose vector has that many components, all of them finite numbers."""
    rows = vectors.select(F.col(f"`{id_col}`").cast("long").alias("_id"), F.col(f"`{vector_col}`").cast("array<double>").alias("_v"))
    finite = F.forall("_v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return rows.where((F.size("_v") == components) & F.coalesce(finite, F.lit(False)))


def seeds(rows: DataFrame, count: int) -> np.ndarray:
    """The whole-number vectors of the ``count`` rows whose hash of the id is smallest, in the order of the hash; equal
    ids are ordered by their components, and a null id hashes as an empty one."""
    key = F.sha2(F.concat(F.lit("1:"), F.coalesce(F.col("_id").cast("string"), F.lit(""))), 256)
    whole = F.transform("_v", lambda x: F.floor(F.least(F.greatest(x, F.lit(-LIMIT / SCALE)), F.lit(LIMIT / SCALE)) * SCALE))
    first = rows.select(key.alias("_h"), whole.alias("_w")).orderBy("_h", "_w").limit(count).collect()
    return np.array([r["_w"] for r in first], np.int32)


def placed(rows: DataFrame, simplex: Simplex) -> DataFrame:
    """Stored: the id, the whole numbers and the apex of each vector, the two latter as bytes."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                whole = _whole(batch)
                apexes = simplex.apexes(whole)
                yield pa.RecordBatch.from_pydict({
                    "_id": batch.column("_id"), "_w": pa.array([r.tobytes() for r in whole], pa.binary()),
                    "_a": pa.array([r.tobytes() for r in apexes], pa.binary())})
    return stored(rows.mapInArrow(run, "_id long, _w binary, _a binary"), "simplex-vectors")


def moved(vectors: DataFrame, simplex: Simplex, centroids: np.ndarray) -> np.ndarray:
    """The centroids after one round: the floor of the exact mean of their vectors; without vectors unchanged.

    A task hands on one sum per centroid and component, whatever the number of its rows.
    """
    tops, width = simplex.apexes(centroids), centroids.shape[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, counts = np.zeros((len(centroids), width), np.int64), np.zeros(len(centroids), np.int64)
        for batch in batches:
            if batch.num_rows:
                whole = _matrix(batch.column("_w"), np.int32)
                number, _, _ = nearest(whole, _matrix(batch.column("_a"), np.float64), centroids, tops)
                for k in np.unique(number):
                    sums[k] += whole[number == k].sum(axis=0, dtype=np.int64)
                counts += np.bincount(number, minlength=len(centroids))
        some = np.flatnonzero(counts)
        if len(some):
            yield pa.RecordBatch.from_pydict({
                "cluster": pa.array(np.repeat(some, width), pa.int32()), "component": pa.array(np.tile(np.arange(width), len(some)), pa.int32()),
                "total": pa.array(sums[some].ravel(), pa.int64()), "n": pa.array(np.repeat(counts[some], width), pa.int64())})

    parts = vectors.mapInArrow(run, "cluster int, component int, total long, n long")
    whole = parts.groupBy("cluster", "component").agg(F.sum(F.col("total").cast("decimal(38,0)")).alias("total"), F.sum("n").alias("n"))
    out = centroids.copy()
    for r in whole.collect():  # a row per centroid and component
        out[r["cluster"], r["component"]] = int(r["total"]) // r["n"]
    return out


def assigned(vectors: DataFrame, simplex: Simplex, centroids: np.ndarray) -> DataFrame:
    """``_id``, ``cluster`` and ``distance`` (squared) of every vector."""
    tops = simplex.apexes(centroids)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                number, distance, _ = nearest(_matrix(batch.column("_w"), np.int32), _matrix(batch.column("_a"), np.float64), centroids, tops)
                yield pa.RecordBatch.from_pydict({"_id": batch.column("_id"), "cluster": pa.array(number, pa.int32()),
                                                  "distance": pa.array(distance, pa.int64())})
    return vectors.mapInArrow(run, "_id long, cluster int, distance long")


def _digest(centroid: np.ndarray) -> str:
    return hashlib.sha256(",".join(map(str, centroid.tolist())).encode()).hexdigest()


def cluster(vectors: DataFrame, *, id_col: str = "vec_id", vector_col: str = "embedding", components: int = COMPONENTS,
            centroids: int = CENTROIDS, rounds: int = ROUNDS, pivots: int = PIVOTS) -> tuple[DataFrame, np.ndarray]:
    """Rows ``id_col``, ``cluster``, ``distance``, ``cluster_inertia``, ``inertia``, ``centroid_sha256``, and the final
    centroids.

    Vectors that are null, have another length, or hold null, NaN or infinity are left out. Repeated rows are vectors
    of their own, a null id stays null. With fewer vectors than centroids every vector starts one; equal centroids
    are allowed, the first of them takes the vectors. Without vectors there are no rows. Other columns are not read.
    Components beyond 2^27 count as 2^27. A sum beyond a long is null.
    """
    spark: SparkSession = vectors.sparkSession
    rows = usable(vectors, id_col, vector_col, components)
    at = seeds(rows, centroids)
    schema = "cluster int, cluster_inertia long, inertia long, centroid_sha256 string"
    if not len(at):
        none = rows.select("_id", F.lit(0).alias("cluster"), F.lit(0).cast("long").alias("distance")).join(
            spark.createDataFrame([], schema), "cluster")
        return none.select(F.col("_id").alias(id_col), "cluster", "distance", *schema.replace(",", "").split()[2::2]), at
    simplex = Simplex(at, pivots)
    kept = placed(rows, simplex)
    for _ in range(rounds):
        at = moved(kept, simplex, at)
    last = stored(assigned(kept, simplex, at), "simplex-assigned")
    sums = last.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("s")).collect()  # a row per centroid
    total = sum(int(r["s"]) for r in sums)
    fits = lambda n: n if n < 1 << 63 else None
    found = spark.createDataFrame([(r["cluster"], fits(int(r["s"])), fits(total), _digest(at[r["cluster"]])) for r in sums], schema)
    out = last.join(F.broadcast(found), "cluster")  # a row per centroid
    return out.select(F.col("_id").alias(id_col), "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"), at
