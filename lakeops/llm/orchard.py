"""Centroid clustering with Orchard's search for the nearest centroid (operator 13).

Vectors become whole numbers once, ``floor(scale * x)``, and are stored packed. The start centroids are
the vectors whose hashed ids come first. Each round finds every vector's nearest centroid in Arrow
tasks, sums components there, adds up the tasks' sums (clusters x dimensions rows a task) on Spark,
and takes exact whole-number means on the driver, which only ever holds clusters x dimensions numbers.

Orchard's search: each centroid lists the others by their distance from it. A vector walks the list of
the best centroid so far; a closer one found makes the walk go on in that one's list, from its head;
marked centroids are not measured twice. The walk ends strictly beyond twice the distance to the best
centroid: by the triangle inequality all further ones are farther away, and those as far have been seen,
so ties go to the smaller number. All vectors of a block take their steps together in numpy.

Edge cases: vectors that are null, have another number of components, or hold a null, a NaN or an infinity
are left out, also from the result. Repeated ids count each; equal hashes of ids go by the components. A
null id hashes as the empty text. Fewer vectors than clusters: each is a start centroid. No vectors: no
rows. A centroid without vectors stays where it is; equal centroids leave the larger number empty.
Components of 2^27 or more after scaling, whose squared distances may not fit 64 bits, raise an error.
Other columns are unused, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .store import stored

_LIMIT = 1 << 27
# Vectors that step together: bounds the marks (vectors x clusters) and the gathered components.
_BLOCK_CELLS = 1 << 22


@dataclass(frozen=True)
class Rule:
    clusters: int = 8
    rounds: int = 10
    dims: int = 64
    scale: int = 1024
    seed: str = "3"
    id: str = "vec_id"
    vector: str = "embedding"


def packed(vectors: DataFrame, rule: Rule = Rule()) -> DataFrame:
    """Rows (vec_id, v): the usable vectors as little-endian 32-bit whole numbers."""
    dims, scale = rule.dims, rule.scale

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch.column(1)
            fits = pc.equal(pc.list_value_length(rows), dims)
            ids = batch.column(0).filter(fits)
            x = pc.list_flatten(rows.filter(fits)).cast(pa.float64()).to_numpy(zero_copy_only=False).reshape(-1, dims)
            fine = np.isfinite(x).all(axis=1)  # a null component arrives as NaN
            q = np.floor(x[fine] * scale)
            if (np.abs(q) >= _LIMIT).any():
                raise ValueError(f"components must stay below {_LIMIT} after scaling")
            cells = q.astype("<i4").tobytes()
            values = pa.Array.from_buffers(pa.binary(dims * 4), len(q), [None, pa.py_buffer(cells)])
            yield pa.RecordBatch.from_arrays([ids.filter(pa.array(fine)), values.cast(pa.binary())], ["vec_id", "v"])

    own = vectors.select(F.col(f"`{rule.id}`").cast("bigint").alias("vec_id"), F.col(f"`{rule.vector}`").alias("x"))
    return own.where(F.col("x").isNotNull()).mapInArrow(pack, "vec_id bigint, v binary")


def neighbour_lists(centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each centroid the others by distance (ties by number), itself first, and those squared distances."""
    gaps = ((centroids[:, None, :] - centroids[None, :, :]) ** 2).sum(axis=2)
    np.fill_diagonal(gaps, -1)
    order = np.argsort(gaps, axis=1, kind="stable")
    np.fill_diagonal(gaps, 0)
    return order, np.take_along_axis(gaps, order, axis=1)


def nearest(x: np.ndarray, centroids: np.ndarray, order: np.ndarray, gaps: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Number of the nearest centroid of each row of ``x`` (ties: the smaller) and the squared distance."""
    k, n = len(centroids), len(x)
    best, at = np.zeros(n, dtype=np.int64), np.ones(n, dtype=np.int64)
    far = ((x - centroids[0]) ** 2).sum(axis=1)
    marked = np.zeros((n, k), dtype=bool)
    marked[:, 0] = True
    going = np.arange(n)
    while True:
        going = going[at[going] < k]
        # sqrt(gap) > 2 sqrt(far), without roots
        going = going[gaps[best[going], at[going]] <= 4 * far[going]]
        if not len(going):
            return best, far
        candidate = order[best[going], at[going]]
        at[going] += 1
        fresh = ~marked[going, candidate]
        rows, candidate = going[fresh], candidate[fresh]
        marked[rows, candidate] = True
        d = ((x[rows] - centroids[candidate]) ** 2).sum(axis=1)
        closer = (d < far[rows]) | ((d == far[rows]) & (candidate < best[rows]))
        rows = rows[closer]
        best[rows], far[rows], at[rows] = candidate[closer], d[closer], 1


def _blocks(batch: pa.RecordBatch, dims: int, clusters: int) -> Iterator[tuple[int, np.ndarray]]:
    cells = batch.column(1).cast(pa.large_binary())
    _, index, data = cells.buffers()
    offsets = np.frombuffer(index, dtype=np.int64)[cells.offset : cells.offset + len(cells) + 1]
    if not len(cells):
        return
    x = np.frombuffer(data, dtype="<i4", count=len(cells) * dims, offset=offsets[0]).reshape(-1, dims)
    step = max(1, _BLOCK_CELLS // max(dims, clusters))
    for i in range(0, len(x), step):
        yield i, x[i : i + step].astype(np.int64)


def _sums(table: DataFrame, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Component sums and sizes of all clusters."""
    k, dims = centroids.shape

    def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lists = neighbour_lists(centroids)
        total, size = np.zeros((k, dims), dtype=np.int64), np.zeros(k, dtype=np.int64)
        for batch in batches:
            for _, x in _blocks(batch, dims, k):
                best, _ = nearest(x, centroids, *lists)
                by = np.argsort(best, kind="stable")
                present, first = np.unique(best[by], return_index=True)
                total[present] += np.add.reduceat(x[by], first, axis=0)
                size += np.bincount(best, minlength=k)
        some = np.flatnonzero(size)
        where = [np.repeat(some, dims), np.tile(np.arange(dims), len(some)), total[some].ravel(), np.repeat(size[some], dims)]
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in where], ["c", "d", "total", "size"])

    parts = table.mapInArrow(part, "c bigint, d bigint, total bigint, size bigint")
    found = parts.groupBy("c", "d").agg(F.sum("total").alias("total"), F.sum("size").alias("size")).collect()  # clusters x dims
    total, size = np.zeros((k, dims), dtype=np.int64), np.zeros(k, dtype=np.int64)
    for r in found:
        total[r["c"], r["d"]] = r["total"]
        size[r["c"]] = r["size"]
    return total, size


def start_centroids(table: DataFrame, rule: Rule) -> np.ndarray:
    code = F.sha2(F.concat_ws(":", F.lit(rule.seed), F.coalesce(F.col("vec_id").cast("string"), F.lit(""))), 256)
    first = table.select(code.alias("h"), "v").orderBy("h", "v").limit(rule.clusters).collect()
    return np.array([np.frombuffer(r["v"], dtype="<i4") for r in first], dtype=np.int64).reshape(-1, rule.dims)


def clustered(vectors: DataFrame, rule: Rule = Rule()) -> DataFrame:
    """Rows (vec_id, cluster, distance, cluster_inertia, inertia, centroid): the cluster of each usable
    vector, its squared distance, that summed over the cluster and over all, and the final centroid."""
    spark = vectors.sparkSession
    table = stored(packed(vectors, rule), "vectors")
    centroids = start_centroids(table, rule)
    schema = "vec_id bigint, cluster int, distance bigint"
    if not len(centroids):
        return spark.createDataFrame([], f"{schema}, cluster_inertia bigint, inertia bigint, centroid array<bigint>")
    for _ in range(rule.rounds):
        total, size = _sums(table, centroids)
        some = size > 0
        centroids = centroids.copy()
        centroids[some] = total[some] // size[some, None]  # rounds down, also below zero

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lists = neighbour_lists(centroids)
        for batch in batches:
            for i, x in _blocks(batch, rule.dims, len(centroids)):
                best, far = nearest(x, centroids, *lists)
                columns = [batch.column(0).slice(i, len(x)), pa.array(best, pa.int32()), pa.array(far, pa.int64())]
                yield pa.RecordBatch.from_arrays(columns, ["vec_id", "cluster", "distance"])

    found = stored(table.mapInArrow(assign, schema), "clusters")
    parts = {r["cluster"]: r["d"] for r in found.groupBy("cluster").agg(F.sum("distance").alias("d")).collect()}  # clusters
    rows = [(c, d, sum(parts.values()), centroids[c].tolist()) for c, d in sorted(parts.items())]
    each = spark.createDataFrame(rows, "cluster int, cluster_inertia bigint, inertia bigint, centroid array<bigint>")
    return found.join(each, "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid")

