"""Connected components of a distributed edge table (alternating stars), and
helpers to compare the members of groups in block pairs of bounded size."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.llm.common import written


def _large_star(edges: DataFrame) -> DataFrame:
    """Link every neighbour above a node to the least of its neighbourhood."""
    both = edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = written(both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")), "least")
    return both.where("v > u").join(least, "u").select(F.col("m").alias("u"), "v").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Link every neighbour below a node, and the node, to the least of them."""
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    moved = down.join(least, "u").where("v <> m").select(F.col("m").alias("u"), "v")
    return moved.unionByName(least.select(F.col("m").alias("u"), F.col("u").alias("v"))).distinct()


def _are_stars(edges: DataFrame) -> bool:
    """Whether every v has one u (u < v) and no u is a v of another edge."""
    ends = edges.select(F.col("u").alias("node"), F.lit(0).alias("below")).unionByName(
        edges.select(F.col("v").alias("node"), F.lit(1).alias("below")))
    return (ends.groupBy("node").agg(F.sum("below").alias("above"), F.min("below").alias("least"))
            .where("above > 1 or (above = 1 and least = 0)").isEmpty())


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, component) for the nodes of ``edges(u, v)``; a component is named by
    its smallest node. Null ends and loops are ignored; no edges, no rows.

    Alternating large-star and small-star steps reach a forest of stars in
    about log^2 of the component size rounds; none is needed if the edges are
    stars from the start. Every round is a written table, so a lost executor costs one
    round at most. A node's minimum is a partial aggregate. In the large star, where a
    node may hold a large share of all edges, the minima are written too: so the edges
    and they meet in a plain join of two shuffled scans, which adaptive execution can split.
    """
    now = written(edges.where("u is not null and v is not null and u <> v")
                  .select(F.greatest("u", "v").alias("v"), F.least("u", "v").alias("u")).distinct(), "edges")
    while not _are_stars(now):
        now = written(_small_star(_large_star(now)), "stars")
    return (now.select(F.col("v").alias("node"), F.col("u").alias("component"))
            .unionByName(now.select(F.col("u").alias("node"), F.col("u").alias("component")).distinct()))


def block_pairs(members: DataFrame, keys: list[str], blocks: str) -> DataFrame:
    """Each member once for every block pair (a <= b) that holds its block."""
    other = F.explode(F.sequence(F.lit(0), (F.col(blocks) - 1).cast("int")))
    return (members.withColumn("block", F.pmod(F.xxhash64(F.lit("block"), "rep"), F.col(blocks)).cast("int"))
            .withColumn("other", other)
            .withColumn("a", F.least("block", "other")).withColumn("b", F.greatest("block", "other"))
            .drop("other", blocks)
            .repartition(*keys, "a", "b").sortWithinPartitions(*keys, "a", "b"))


def grouped(batches: Iterator[pd.DataFrame], keys: list[str]) -> Iterator[pd.DataFrame]:
    """Batches cut at group borders: rows of a group lie next to each other and
    come together (a group has bounded size)."""
    held = None
    for batch in batches:
        if not len(batch):
            continue
        held = batch if held is None else pd.concat([held, batch], ignore_index=True)
        cut = _tail(held, keys)
        if cut:
            yield held.iloc[:cut]
            held = held.iloc[cut:]
    if held is not None and len(held):
        yield held


def _tail(rows: pd.DataFrame, keys: list[str]) -> int:
    """Where the last group of ``rows`` begins."""
    differs = np.zeros(len(rows), bool)
    for key in keys:
        values = rows[key].to_numpy()
        differs |= values != values[-1]
    at = np.flatnonzero(differs)
    return int(at[-1]) + 1 if len(at) else 0


def spanning(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """The least index each of n nodes reaches over the links (i, j)."""
    label = np.arange(n)
    while len(i):
        before = label.copy()
        low = np.minimum(label[i], label[j])
        np.minimum.at(label, i, low)
        np.minimum.at(label, j, low)
        label = label[label]
        if (label == before).all():
            break
    return label
