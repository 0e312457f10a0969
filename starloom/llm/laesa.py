"""Clustering of integer vectors with a LAESA pivot table.

The distances of every vector to a few fixed pivots are stored once beside the
vector. In each round the differences between a vector's and a centroid's pivot
distances bound their distance from below, so only the centroids whose bound
does not exceed the best distance found so far get an exact integer distance.
Every round is one scan of the stored table; the tasks send back sums by
cluster, and no more than the centroids passes through the driver.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.llm.common import written

#: Largest absolute component: squared distances of so wide vectors fit 64 bits up to 128 components.
WIDEST = 1 << 27
#: Rows that the pivots are chosen from, by the order that chooses the first centroids.
PIVOT_SAMPLE = 256
#: Rows whose bounds are held at once.
BLOCK = 4096


def whole_vectors(vectors: DataFrame, dim: int, scale: int, id_col: str, vector_col: str) -> DataFrame:
    """Rows (vec_id, v): the vectors of exactly ``dim`` components, none null or
    non-finite, each turned into floor(scale * x). A component beyond WIDEST fails the
    job, since its distances need not fit 64 bits."""
    wide = F.transform(F.col(vector_col), lambda x: F.lit(float(scale)) * x.cast("double"))
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))
    small = F.forall("wide", lambda x: F.abs(x) <= float(WIDEST))
    return (vectors.select(F.col(id_col).alias("vec_id"), wide.alias("wide"))
            .where((F.size("wide") == dim) & F.forall("wide", finite))
            .select("vec_id", F.when(small, F.transform("wide", lambda x: F.floor(x).cast("int"))).otherwise(
                F.raise_error(F.lit(f"a component is beyond {WIDEST}"))).alias("v")))


def farthest_first(rows: np.ndarray, n: int) -> np.ndarray:
    """Up to ``n`` rows, each the farthest from those before it (ties: the earlier row)."""
    if not len(rows):
        return rows
    chosen, far = [0], squared(rows, rows[0])
    while len(chosen) < n and far.max() > 0:
        chosen.append(int(far.argmax()))
        far = np.minimum(far, squared(rows, rows[chosen[-1]]))
    return rows[chosen]


def squared(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Exact squared distances of rows of 64-bit integers."""
    d = x - y
    return np.einsum("ij,ij->i", d, d)


def to_pivots(x: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    """Distances of the rows of ``x`` to every pivot."""
    return np.sqrt(np.stack([squared(x, p) for p in pivots], 1).astype(np.float64))


def nearest(x: np.ndarray, stored: np.ndarray, centroids: np.ndarray, theirs: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """(number of the nearest centroid, squared distance) of every row of ``x``, ties to
    the smaller number, and how many exact distances that took. ``stored`` and ``theirs``
    are the pivot distances of rows and centroids."""
    n, k = len(x), len(centroids)
    lower = np.zeros((n, k))
    for p in range(stored.shape[1]):
        np.maximum(lower, np.abs(stored[:, p, None] - theirs[:, p]), out=lower)
    # distances are rounded to doubles: a bound counts only as far as that is certain
    lower -= 1e-12 * (stored.max(1)[:, None] + theirs.max(1))
    order = np.argsort(lower, 1, kind="stable")
    best, who = np.full(n, np.iinfo(np.int64).max), np.full(n, k)
    active, exact = np.arange(n), 0
    for j in range(k):
        c = order[active, j]
        alive = lower[active, c] <= np.sqrt(best[active].astype(np.float64)) * (1 + 1e-12)
        active, c = active[alive], c[alive]
        if not len(active):
            break
        d = squared(x[active], centroids[c])
        exact += len(active)
        better = (d < best[active]) | ((d == best[active]) & (c < who[active]))
        best[active[better]], who[active[better]] = d[better], c[better]
    return who, best, exact


def _vectors(batch: pa.RecordBatch, dim: int) -> np.ndarray:
    return batch.column("v").flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(-1, dim)


def pivot_table(rows: DataFrame, pivots: np.ndarray) -> DataFrame:
    """``rows`` (vec_id, v) with ``far``, the distances to the pivots; written once."""
    dim, kind = pivots.shape[1], rows.schema["vec_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            far = to_pivots(_vectors(batch, dim), pivots)
            offsets = pa.array(np.arange(len(far) + 1, dtype=np.int32) * len(pivots))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.ListArray.from_arrays(offsets, pa.array(far.ravel()))],
                                             ["vec_id", "v", "far"])

    return written(rows.mapInArrow(run, f"vec_id {kind}, v array<int>, far array<double>"), "pivot-table")


def _blocks(batches: Iterator[pa.RecordBatch], centroids: np.ndarray, pivots: np.ndarray) -> Iterator[tuple]:
    """Blocks of rows of the pivot table with their vectors, nearest centroids and distances."""
    theirs = to_pivots(centroids, pivots)
    for batch in batches:
        for first in range(0, batch.num_rows, BLOCK):
            part = batch.slice(first, BLOCK)
            x = _vectors(part, centroids.shape[1])
            stored = part.column("far").flatten().to_numpy(zero_copy_only=False).reshape(len(x), -1)
            yield part, x, *nearest(x, stored, centroids, theirs)[:2]


def _moved(table: DataFrame, centroids: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    """The centroids after one round: exact floors of the means of their vectors."""
    k, dim = centroids.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, sums = np.zeros(k, np.int64), np.zeros((k, dim), np.int64)
        for _, x, who, _ in _blocks(batches, centroids, pivots):
            counts += np.bincount(who, minlength=k)
            np.add.at(sums, who, x)
        used = np.flatnonzero(counts)  # a task's sums: 2^27 times its rows at most
        offsets = pa.array(np.arange(len(used) + 1, dtype=np.int32) * dim)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(counts[used]), pa.ListArray.from_arrays(
            offsets, pa.array(sums[used].ravel()))], ["cluster", "n", "sums"])

    total = [F.sum(F.col("sums")[i].cast("decimal(20,0)")).alias(f"s{i}") for i in range(dim)]
    found = (table.select("v", "far").mapInArrow(run, "cluster long, n long, sums array<long>")
             .groupBy("cluster").agg(F.sum("n").alias("n"), *total).collect())  # a row a centroid
    after = centroids.copy()
    for r in found:
        after[r["cluster"]] = [int(r[f"s{i}"]) // r["n"] for i in range(dim)]
    return after


def cluster(vectors: DataFrame, k: int = 40, rounds: int = 5, dim: int = 64, scale: int = 256, pivots: int = 16,
            salt: str = "2", id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """Rows (vec_id, cluster, distance, cluster_inertia, inertia, centroid): every kept
    vector with its centroid after ``rounds`` rounds, the squared distance to it, the sums of
    the distances over the cluster and over all, and the centroid's components.

    Vectors of another length than ``dim``, null ones and those with a null or non-finite
    component are left out. The first centroids are the ``k`` vectors (all, if fewer) with the
    smallest sha256 of "salt:id", null ids last, ties by components. Repeated rows and ids
    are vectors of their own; an empty centroid stays where it is. Other columns are
    ignored. No kept vector, no rows. A component beyond WIDEST after scaling, or an inertia
    beyond 64 bits, fails the job.
    """
    spark = vectors.sparkSession
    rows = whole_vectors(vectors, dim, scale, id_col, vector_col)
    first = F.sha2(F.concat(F.lit(f"{salt}:"), F.col("vec_id").cast("string")), 256)
    start = rows.orderBy(first.asc_nulls_last(), "v").limit(max(k, PIVOT_SAMPLE)).select("v").collect()  # PIVOT_SAMPLE rows
    kind = rows.schema["vec_id"].dataType.simpleString()
    schema = f"vec_id {kind}, cluster int, distance long"
    if not start:
        return spark.createDataFrame([], f"{schema}, cluster_inertia long, inertia long, centroid array<bigint>")
    sample = np.array([r["v"] for r in start], np.int64)
    centroids, fixed = sample[:k], farthest_first(sample, pivots)
    table = pivot_table(rows, fixed)
    for _ in range(rounds):
        centroids = _moved(table, centroids, fixed)
    last = centroids

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, _, who, distance in _blocks(batches, last, fixed):
            yield pa.RecordBatch.from_arrays([part.column("vec_id"), pa.array(who, pa.int32()), pa.array(distance)],
                                             ["vec_id", "cluster", "distance"])

    assigned = written(table.mapInArrow(run, schema), "assigned")
    sums = assigned.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(20,0)")).alias("s")).collect()
    each = [(r["cluster"], int(r["s"]), last[r["cluster"]].tolist()) for r in sums]  # a row a centroid
    whole = sum(s for _, s, _ in each)
    if whole >= 1 << 63:
        raise OverflowError("the inertia is beyond 64 bits")
    known = spark.createDataFrame(each, "cluster int, cluster_inertia long, centroid array<bigint>")
    return (assigned.join(F.broadcast(known), "cluster")  # k rows
            .select("vec_id", "cluster", "distance", "cluster_inertia", F.lit(whole).cast("long").alias("inertia"), "centroid"))
