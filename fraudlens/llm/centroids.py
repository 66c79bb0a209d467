"""Clustering of whole-number vectors around centroids, with bounds from an n-simplex projection.

Every vector's distances to a few pivots are computed once.  The pivots span a simplex; a vector is the apex over
it that has these distances: coordinates in the simplex's own space, and a height above it that is known but for
its side.  The Euclidean distance of two apexes with heights on one side is a lower bound of the distance of the two vectors,
with heights on opposite sides an upper bound.  The pivots are the starting centroids, whose own heights are zero, and once more the
centroids after the first round, which move the most; later centroids stay close to the simplex.  The apexes are stored
beside the vectors and serve all rounds until then or from then on.

An assignment drops the centroids whose lower bound is above the least upper bound of any centroid and compares
the others by exact integer distances.  The bounds are widened by more than their rounding error, so no nearest centroid and no
tie is lost.  If the pivots are badly placed (all equal, say) fewer of them are used; with none, all centroids are compared.

A round adds up components by cluster in the tasks, then in Spark; only one row a centroid reaches the driver.
Vectors, apexes and assignments are written to the shared folder, so a lost executor's tasks are run again from there.

Defined cases: vectors that are null, of another length, or hold a null, a NaN, an infinity or a component of ``TOO_LARGE`` or more in
size (distances would not fit a long) are left out; a null ``vec_id`` is clustered, starts no centroid, and stays null; repeated
rows are clustered one by one, and equal start hashes are ordered by their components; with fewer vectors than centroids there
are as many centroids as vectors with an id; without any, and on an empty table, no rows; ties go to the smaller number; an empty
cluster keeps its centroid; sums that do not fit a long are null.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from fraudlens.session import fresh_path

CENTROIDS, ROUNDS, LENGTH, PIVOTS = 16, 3, 64, 16
TOO_LARGE = 2.0**20  # of a component before it is scaled
SCALE = 64
#: Rows whose bounds and differences a task holds at once.
CHUNK = 4096


class Simplex(NamedTuple):
    """Pivots (whole numbers), their coordinates in the space they span, and its inverse."""

    pivots: np.ndarray  # p x length
    base: np.ndarray  # (p - 1) x (p - 1), rows: pivots 1 .. p - 1 with pivot 0 at the origin
    inverse: np.ndarray
    slack: float  # more than the rounding error of squared bounds, as a share of the sizes


# --- Geometry ---------------------------------------------------------------------


def squared(vectors: np.ndarray, points: np.ndarray) -> np.ndarray:
    """Exact squared distances, vectors x points."""
    out = np.empty((len(vectors), len(points)), np.int64)
    for j, point in enumerate(points):
        gap = vectors - point
        out[:, j] = np.einsum("nd,nd->n", gap, gap)
    return out


def simplex(candidates: np.ndarray, limit: int = PIVOTS) -> Simplex | None:
    """Pivots chosen one by one as the candidate highest above the simplex of the ones before.

    Stops before a pivot whose height is too small against the first edge, which bounds the rounding errors.
    """
    if len(candidates) < 2:
        return None
    picked, coordinates = [0], np.zeros((len(candidates), 0))
    left = squared(candidates, candidates[:1])[:, 0].astype(float)  # squared height of each candidate
    edge = np.sqrt(left.max())
    while len(picked) < min(limit, len(candidates)):
        best = int(np.argmax(left))
        height = np.sqrt(max(left[best], 0.0))
        if height == 0 or height < edge * 1e-3:
            break
        gap = (candidates - candidates[0]).astype(float)
        along = (gap @ gap[best] - coordinates @ coordinates[best]) / height
        coordinates = np.column_stack([coordinates, along])
        left = left - along**2
        picked.append(best)
    if len(picked) < 2:
        return None
    base = np.tril(coordinates[picked[1:]])
    inverse = np.linalg.inv(base)
    condition = np.linalg.norm(base) * np.linalg.norm(inverse)
    # a squared height is off by its rounding times the condition squared, so a small height by the root of that
    return Simplex(candidates[picked], base, inverse, 8 * condition * np.sqrt(1e-15 * len(base)))


def apex(shape: Simplex, distances: np.ndarray) -> np.ndarray:
    """Coordinates and, last, the height above the simplex, from squared distances to the pivots."""
    to_first = distances[:, :1].astype(float)
    half = (to_first - distances[:, 1:] + (shape.base**2).sum(1)) / 2
    inside = half @ shape.inverse.T
    height = np.sqrt(np.maximum(to_first[:, 0] - (inside**2).sum(1), 0))
    return np.column_stack([inside, height])


def bounds(shape: Simplex, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Lower and upper bounds of all squared distances between the vectors of two sets of apexes, a x b."""
    inside = ((a[:, None, :-1] - b[None, :, :-1]) ** 2).sum(2)
    size = (a**2).sum(1)[:, None] + (b**2).sum(1)[None, :] + (shape.base**2).sum(1).max()
    margin = shape.slack * size
    lower = inside + (a[:, None, -1] - b[None, :, -1]) ** 2 - margin
    upper = inside + (a[:, None, -1] + b[None, :, -1]) ** 2 + margin
    return lower, upper


def nearest(shape: Simplex | None, vectors: np.ndarray, tops: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Number of and exact squared distance to the nearest centroid; ties go to the smaller number."""
    if shape is None:
        open_ = np.ones((len(vectors), len(centroids)), bool)
    else:
        lower, upper = bounds(shape, tops, apex(shape, squared(centroids, shape.pivots)))
        open_ = lower <= upper.min(1, keepdims=True)
    best = np.full(len(vectors), np.iinfo(np.int64).max)
    number = np.zeros(len(vectors), np.int32)
    for c in range(len(centroids)):
        rows = np.flatnonzero(open_[:, c])
        gap = vectors[rows] - centroids[c]
        distance = np.einsum("nd,nd->n", gap, gap)
        closer = distance < best[rows]
        best[rows[closer]], number[rows[closer]] = distance[closer], c
    return number, best


# --- On Spark -----------------------------------------------------------------------


def whole_numbers(embeddings: DataFrame, length: int = LENGTH, scale: int = SCALE) -> DataFrame:
    """``vec_id, v``: usable vectors with each component as floor(scale * x)."""
    x = F.col("embedding").cast("array<double>")
    usable = lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(TOO_LARGE))
    return (
        embeddings.select(F.col("vec_id").cast("long").alias("vec_id"), x.alias("x"))
        .where((F.size("x") == length) & F.forall("x", usable))
        .select("vec_id", F.transform("x", lambda c: F.floor(c * scale).cast("int")).alias("v"))
    )


def starting(vectors: DataFrame, k: int = CENTROIDS) -> np.ndarray:
    """The k vectors whose id has the smallest hash, at most k rows."""
    key = F.sha2(F.concat(F.lit("1:"), F.col("vec_id").cast("string")), 256)
    rows = vectors.where("vec_id is not null").orderBy(key, "v").limit(k).select("v").collect()
    return np.array([r.v for r in rows], np.int64)


def _matrix(column: pa.Array, kind) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(kind, copy=False).reshape(len(column), -1)


def _lists(rows: np.ndarray) -> pa.ListArray:
    cuts = np.arange(len(rows) + 1, dtype=np.int32) * rows.shape[1]
    return pa.ListArray.from_arrays(pa.array(cuts), pa.array(rows.ravel()))


def _pieces(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, CHUNK):
            yield batch.slice(at, CHUNK)


def with_apexes(vectors: DataFrame, shape: Simplex | None) -> DataFrame:
    """``vec_id, v, apex`` as a stored table; the apex caches what the distances to the pivots say."""
    def run(batches):
        for piece in _pieces(batches):
            v = _matrix(piece.column(1), np.int64)
            tops = np.zeros((len(v), 1)) if shape is None else apex(shape, squared(v, shape.pivots))
            yield pa.RecordBatch.from_arrays([piece.column(0), piece.column(1), _lists(tops)], ["vec_id", "v", "apex"])

    path = fresh_path(vectors.sparkSession, "apexes")
    vectors.select("vec_id", "v").mapInArrow(run, "vec_id long, v array<int>, apex array<double>").write.parquet(path)
    return vectors.sparkSession.read.parquet(path)


def _assigned(batches: Iterable[pa.RecordBatch], shape: Simplex | None, centroids: np.ndarray):
    for piece in _pieces(batches):
        v = _matrix(piece.column(1), np.int64)
        yield piece, v, *nearest(shape, v, _matrix(piece.column(2), float), centroids)


def assign(stored: DataFrame, shape: Simplex | None, centroids: np.ndarray) -> DataFrame:
    """``vec_id, cluster, distance`` (squared) of every vector."""
    def run(batches):
        for piece, _, number, distance in _assigned(batches, shape, centroids):
            yield pa.RecordBatch.from_arrays([piece.column(0), pa.array(number), pa.array(distance)], ["vec_id", "cluster", "distance"])

    return stored.mapInArrow(run, "vec_id long, cluster int, distance long")


def moved(stored: DataFrame, shape: Simplex | None, centroids: np.ndarray) -> np.ndarray:
    """The centroids after one round: floor of the mean of each cluster's vectors."""
    k, length = centroids.shape

    def run(batches):
        total, count = np.zeros((k, length), object), np.zeros(k, np.int64)
        for _, v, number, _ in _assigned(batches, shape, centroids):
            order = np.argsort(number, kind="stable")
            present, first = np.unique(number[order], return_index=True)
            total[present] += np.add.reduceat(v[order], first, axis=0)  # of a piece: fits 64 bits
            count += np.bincount(number, minlength=k)
        for c in np.flatnonzero(count).tolist():
            sums = pa.array([[int(x) for x in total[c]]], pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([pa.array([c], pa.int32()), pa.array([count[c]]), sums], ["cluster", "n", "sums"])

    parts = stored.select("vec_id", "v", "apex").mapInArrow(run, "cluster int, n long, sums array<long>")
    at = parts.select("cluster", F.posexplode("sums").alias("at", "s")).groupBy("cluster", "at")
    sums = at.agg(F.sum(F.col("s").cast("decimal(38,0)")).alias("s"))
    counts = parts.groupBy("cluster").agg(F.sum("n").alias("n"))
    out = centroids.copy()
    for row in sums.join(counts, "cluster").collect():  # centroids x length rows
        out[row["cluster"], row["at"]] = int(row["s"]) // row["n"]
    return out


def cluster(embeddings: DataFrame, k: int = CENTROIDS, rounds: int = ROUNDS, length: int = LENGTH, scale: int = SCALE) -> tuple[DataFrame, np.ndarray]:
    """``vec_id, cluster, distance, cluster_inertia, inertia`` of every usable vector, and the final centroids."""
    spark = embeddings.sparkSession
    vectors = whole_numbers(embeddings, length, scale)
    centroids = starting(vectors, k)
    if not len(centroids):
        kinds = {"vec_id": "long", "cluster": "int", "distance": "long", "cluster_inertia": "long", "inertia": "long"}
        return spark.createDataFrame([], ", ".join(f"{n} {t}" for n, t in kinds.items())), centroids
    shape = simplex(centroids)
    stored = with_apexes(vectors, shape)
    for done in range(rounds):
        centroids = moved(stored, shape, centroids)
        if done == 0:
            shape = simplex(centroids)
            stored = with_apexes(stored, shape)
    path = fresh_path(spark, "assigned")
    assign(stored, shape, centroids).write.parquet(path)
    final = spark.read.parquet(path)
    per = final.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("s"))
    per = {r["cluster"]: int(r["s"]) for r in per.collect()}  # one row a centroid
    fit = lambda x: F.lit(x if x < 2**63 else None).cast(T.LongType())
    own = F.coalesce(*[F.when(F.col("cluster") == c, fit(s)) for c, s in sorted(per.items())], F.lit(None).cast("long"))
    return final.select("*", own.alias("cluster_inertia"), fit(sum(per.values())).alias("inertia")), centroids


def digests(centroids: np.ndarray) -> list[str]:
    """SHA-256 of each centroid's components as decimal integers joined by commas."""
    return [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids.tolist()]
