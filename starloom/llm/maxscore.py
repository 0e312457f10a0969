"""Exact top-k search by MaxScore over sharded postings.

Vectors become integer term weights: dimension t is a term, its postings are the
vectors with their weight there. In each shard a term's largest and smallest weight
bound what it can add to a score. Once a query is known to have k vectors with some
score, its terms split: the terms whose bounds together stay clear of that score
are non-essential. The postings of the essential terms are traversed (a
product over a block of queries), and the other terms are probed, in descending order
of their bounds, only for vectors that can still compete. The shards' results
are merged.

Weights may be negative, so a term's contribution is counted above its lower bound in
the shard: then all contributions are at least 0, as MaxScore needs.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from starloom.llm.common import written


#: Length times square of the largest weight stays below this in every vector, so all
#: scores and their bounds fit 64 bits.
LARGEST = 2.0 ** 61


@dataclass(frozen=True)
class Settings:
    """``shard``: vectors of a shard; ``batch``: queries that meet a shard together;
    ``share``: share of the distance to the known score that the terms left to
    probing may make up (1 is the bound itself; less traverses more postings); ``probe``:
    terms probed between two looks at the bounds; ``blocks``: blocks of queries that share one reading of
    a shard."""

    shard: int = 4_096
    batch: int = 256
    share: float = 0.1
    probe: int = 4
    blocks: int = 16


class Shard:
    """The postings of a shard: the weights of its vectors by term, and their bounds."""

    def __init__(self, ids: np.ndarray, weights: np.ndarray):
        order = np.argsort(ids, kind="stable")
        self.ids, self.weights = ids[order], np.ascontiguousarray(weights[order])
        self.low, self.high = weights.min(0), weights.max(0)
        self.largest = int(np.abs(weights).max(initial=0))

    def _product(self, queries: np.ndarray) -> np.ndarray:
        """Exact integer products: in the narrowest floating type that holds every sum."""
        bound = self.largest * int(np.abs(queries).sum(1).max(initial=0))
        if bound < 1 << 53:
            kind = np.float32 if bound < 1 << 24 else np.float64
            return (queries.astype(kind) @ self.weights.T.astype(kind)).astype(np.int64)
        return queries @ self.weights.T

    def top(self, names: np.ndarray, queries: np.ndarray, floors: np.ndarray, k: int,
            settings: Settings) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(query position, vector position, score) of each query's ``k`` best vectors
        here that reach its floor (a score known to be reached by k vectors), ties to smaller
        ids. A vector with the query's own name is no candidate."""
        ends = np.stack((queries * self.low, queries * self.high))
        lowest, reach = ends.min(0), ends.max(0) - ends.min(0)
        order = np.argsort(-reach, axis=1, kind="stable")
        sorted_reach = np.take_along_axis(reach, order, 1)
        # rest[:, i]: what the terms from place i on can add above their lower bounds
        rest = np.concatenate((np.cumsum(sorted_reach[:, ::-1], 1)[:, ::-1], np.zeros((len(queries), 1), np.int64)), 1)
        base = lowest.sum(1)
        slack = np.where(floors > np.iinfo(np.int64).min // 2, np.maximum(floors - base, 0), 0) * settings.share
        essential = (rest > slack[:, None]).sum(1)  # terms before the first place that stays clear
        place = np.empty_like(order)
        np.put_along_axis(place, order, np.broadcast_to(np.arange(order.shape[1]), order.shape), 1)
        first = place < essential[:, None]
        partial = self._product(np.where(first, queries, 0)) + np.where(first, 0, lowest).sum(1)[:, None]
        left = np.take_along_axis(rest, essential[:, None], 1)[:, 0]
        partial[names[:, None] == self.ids[None, :]] = np.iinfo(np.int64).min // 2
        if len(self.ids) > k:  # k vectors have their partial score at least
            floors = np.maximum(floors, np.partition(partial, -k, axis=1)[:, -k])
        q, v = np.nonzero((partial + left[:, None] >= floors[:, None]) & (partial > np.iinfo(np.int64).min // 2))
        score, at = partial[q, v], essential[q]
        while len(q):
            open_ = at < order.shape[1]
            if not open_.any():
                break
            for _ in range(settings.probe):
                term = order[q, np.minimum(at, order.shape[1] - 1)]
                more = queries[q, term] * self.weights[v, term] - lowest[q, term]
                score = score + np.where(at < order.shape[1], more, 0)
                at = np.minimum(at + 1, order.shape[1])
            keep = score + rest[q, at] >= floors[q]
            if not keep.all():
                q, v, score, at = q[keep], v[keep], score[keep], at[keep]
        best = np.lexsort((v, -score, q))
        q, v, score = q[best], v[best], score[best]
        start = np.searchsorted(q, q)
        kept = np.arange(len(q)) - start < k
        return q[kept], v[kept], score[kept]


def _search(k: int, settings: Settings):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        shard, held = None, None
        for batch in batches:
            for row in batch.itertuples(index=False):
                key = (row.dim, row.shard, row.portion)
                names, weights = np.asarray(row.ids), np.frombuffer(row.weights, np.int64).reshape(-1, row.dim)
                if row.turn == 0:  # a shard, before the blocks of queries that meet it
                    shard, held = Shard(names, weights), key
                elif held == key:  # else the shard has no vectors
                    q, v, score = shard.top(names, weights, np.asarray(row.floors), k, settings)
                    yield pd.DataFrame({"query_id": names[q], "vec_id": shard.ids[v], "score": score})

    return run


def _integers(scale: float):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for vec_id, values in zip(batch["vec_id"].tolist(), batch["embedding"]):
                v = None if values is None else np.array([np.nan if x is None else x for x in values], np.float64)
                if v is not None and len(v) and np.isfinite(v).all():
                    weights = np.floor(scale * v)
                    if not len(v) * np.abs(weights).max() ** 2 < LARGEST:
                        raise OverflowError(f"scores of vector {vec_id} do not fit 64 bits")
                    rows.append((vec_id, len(v), weights.astype(np.int64).tobytes()))
            yield pd.DataFrame(rows, columns=["vec_id", "dim", "weights"])

    return run


def _packed(rows: pd.DataFrame) -> pd.DataFrame:
    """One row of a shard's or batch's vectors (about as many as the settings say)."""
    rows = rows.sort_values("vec_id")
    out = {"dim": [rows["dim"].iloc[0]], "place": [rows["place"].iloc[0]], "ids": [rows["vec_id"].tolist()],
           "weights": [b"".join(rows["weights"])]}
    if "floor" in rows:
        out["floors"] = [rows["floor"].tolist()]
    return pd.DataFrame(out)


def _placed(rows: DataFrame, size: int) -> DataFrame:
    """Rows with ``place``: about ``size`` rows of one dimension share one."""
    places = rows.groupBy("dim").agg(F.ceil(F.count(F.lit(1)) / size).cast("int").alias("places"))
    return rows.join(F.broadcast(places), "dim").withColumn(  # one row per length of a vector
        "place", F.pmod(F.xxhash64(F.lit("place"), "vec_id"), F.col("places")).cast("int"))


def _portion(settings: Settings):
    return F.floor(F.col("place") / settings.blocks).cast("int")


def _pairs(queries: DataFrame, shards: DataFrame, portions: DataFrame, k: int, settings: Settings) -> DataFrame:
    """Results of every block of queries in the shards up to its ``shards``.

    Blocks go to a shard in portions; within a task the shard's row comes before the blocks of its
    portion, so its postings are read once a portion and the blocks stream past them. ``portions``:
    the last portion of each length of a vector."""
    asked = queries.select("dim", _portion(settings).alias("portion"), F.explode(F.expr("sequence(0, shards - 1)")).alias("shard"),
                           F.lit(1).alias("turn"), "ids", "weights", "floors")
    held = (shards.join(F.broadcast(portions), "dim")  # one row per length of a vector
            .select("dim", F.explode(F.expr("sequence(0, last)")).alias("portion"), F.col("place").alias("shard"),
                    F.lit(0).alias("turn"), "ids", "weights", F.lit(None).cast("array<long>").alias("floors")))
    met = asked.unionByName(held).repartition("dim", "shard", "portion")
    return met.sortWithinPartitions("dim", "shard", "portion", "turn").mapInPandas(
        _search(k, settings), "query_id long, vec_id long, score long")


def _ranked(found: DataFrame, k: int) -> DataFrame:
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def top_k(vectors: DataFrame, k: int = 20, every: int = 20, scale: float = 64.0, settings: Settings = Settings(),
          id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """query_id, rank (from 1), vec_id, score: the ``k`` best vectors by integer inner
    product of floor(``scale`` * component) for each vector whose id is divisible by
    ``every``, itself left out; ties to smaller ids.

    Vectors that are null, empty or hold null or non-finite components take no part, nor
    do rows without an id; vectors meet those of their own length. Rows that repeat
    an id are one vector (the smallest). Components so large that a score need not fit
    64 bits are an error. Other columns are ignored; an empty table gives no rows.
    """
    rows = vectors.where(F.col(id_col).isNotNull()).select(
        F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).alias("embedding"))
    if not rows.groupBy("vec_id").count().where("count > 1").isEmpty():
        rows = rows.groupBy("vec_id").agg(F.min("embedding").alias("embedding"))
    whole = written(rows.mapInPandas(_integers(scale), "vec_id long, dim int, weights binary"), "weights")
    packed = "dim int, place int, ids array<long>, weights binary"
    shards = written(_placed(whole, settings.shard).groupBy("dim", "place").applyInPandas(_packed, packed), "shards")
    count = shards.groupBy("dim").agg((F.max("place") + 1).alias("shards"))
    asked = _placed(whole.where(F.col("vec_id") % every == 0), settings.batch)
    portions = asked.groupBy("dim").agg(F.max(_portion(settings)).alias("last"))
    unknown = np.iinfo(np.int64).min

    def blocks(queries: DataFrame) -> DataFrame:
        return (queries.groupBy("dim", "place").applyInPandas(_packed, packed + ", floors array<long>")
                .join(F.broadcast(count), "dim"))

    # a first shard gives each query a score that k vectors reach
    first = _pairs(blocks(asked.withColumn("floor", F.lit(unknown))).withColumn("shards", F.lit(1)),
                   shards.where("place = 0"), portions, k, settings)
    reached = (first.groupBy("query_id").agg(F.count(F.lit(1)).alias("n"), F.min("score").alias("least"))
               .where(F.col("n") >= k).select(F.col("query_id").alias("vec_id"), "least"))
    floored = asked.join(reached, "vec_id", "left").withColumn("floor", F.coalesce("least", F.lit(unknown))).drop("least")
    return _ranked(_pairs(written(blocks(floored), "queries"), shards, portions, k, settings), k)
