"""Level-wise mining of frequent itemsets over transactions of any number of items.

:mod:`starloom.operators.rules` counts every projection of a row with one item an
attribute, which grows with the binomials of the attributes. Here a level of itemsets is
made from the one below: sets that share all but their last item are joined, a set with
an infrequent subset is dropped unseen, and only the rest is counted.

Counting reads a vertical copy of the transactions: for every block of 32,768
transactions and every frequent item a bitmap of the transactions that hold it. A set's count is the
number of bits that all its items' bitmaps share, so a transaction's length does not
matter, and no transaction is read again.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from starloom.session import scratch_path

#: Candidates that a pass over the bitmaps counts at most, about.
CANDIDATES = 200_000
#: Candidates whose shared bits are held at once.
BLOCK = 2048
#: 64-bit words of a bitmap.
WORDS = 512


def _stored(df: DataFrame, name: str) -> DataFrame:
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def item_bitmaps(tx: DataFrame, items_col: str = "items") -> DataFrame:
    """(block, item, bits): which of a block's transactions hold the item.

    Transactions are numbered within their task, so a block lies in one task and its bitmaps
    are whole before any shuffle, however frequent an item is."""
    numbered = tx.select(F.array_distinct(F.filter(items_col, lambda x: x.isNotNull())).alias("items"),
                         F.monotonically_increasing_id().alias("id"))
    return (numbered.select(F.explode("items").alias("item"), F.bitmap_bucket_number(F.col("id") + 1).alias("block"),
                            F.bitmap_bit_position(F.col("id") + 1).alias("bit"))
            .groupBy("block", "item").agg(F.bitmap_construct_agg("bit").alias("bits")))


def candidates(level: DataFrame, size: int) -> DataFrame:
    """Sets (codes) of ``size`` items all of whose subsets of one item less are in ``level``
    (sorted arrays ``codes`` of ``size - 1`` items)."""
    prefix = F.slice("codes", 1, size - 2)
    left = level.select("codes", prefix.alias("prefix"), F.element_at("codes", -1).alias("last"))
    right = level.select(prefix.alias("prefix"), F.element_at("codes", -1).alias("next"))
    made = left.join(right, "prefix").where("next > last").select(F.concat("codes", F.array("next")).alias("codes"))
    if size < 3:
        return made
    without = F.transform(F.sequence(F.lit(0), F.lit(size - 1)), lambda i: F.filter("codes", lambda _, j: j != i))
    subsets = made.select("codes", F.explode(without).alias("subset"))
    known = subsets.join(level.select(F.col("codes").alias("subset")), "subset", "left_semi")
    return known.groupBy("codes").count().where(F.col("count") == size).select("codes")


def _shared(sets: np.ndarray, n_items: int):
    """How many transactions of the blocks of a task hold all items of each set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals = np.zeros(len(sets), np.int64)
        for batch in batches:
            for codes, bitmaps in zip(batch.column("codes").to_pylist(), batch.column("bitmaps").to_pylist()):
                rows = np.zeros((len(codes) + 1, WORDS), np.uint64)  # the last row: an item that the block lacks
                rows[:-1] = np.frombuffer(b"".join(bitmaps), np.uint64).reshape(-1, WORDS)
                place = np.full(n_items, len(codes))
                place[codes] = np.arange(len(codes))
                for first in range(0, len(sets), BLOCK):
                    own = place[sets[first:first + BLOCK]]
                    bits = rows[own[:, 0]]
                    for j in range(1, own.shape[1]):
                        bits &= rows[own[:, j]]
                    totals[first:first + BLOCK] += np.bitwise_count(bits).sum(1, dtype=np.int64)
        used = np.flatnonzero(totals)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(totals[used])], ["set", "n"])

    return run


def _counted(blocks: DataFrame, made: DataFrame, n_items: int) -> DataFrame:
    """(codes, count) of the candidates that occur, in as many passes as bound their number."""
    spark, parts = blocks.sparkSession, max(1, -(-made.count() // CANDIDATES))
    found = []
    for part in range(parts):
        own = made.where(F.pmod(F.xxhash64("codes"), F.lit(parts)) == part).orderBy("codes").collect()  # CANDIDATES rows, about
        if own:
            sets = np.array([r["codes"] for r in own], np.int32)
            counts = blocks.mapInArrow(_shared(sets, n_items), "set long, n long").groupBy("set").agg(F.sum("n").alias("n"))
            named = spark.createDataFrame(list(enumerate(sets.tolist())), "set long, codes array<int>")
            found.append(named.join(counts, "set").select("codes", F.col("n").alias("count")))
    if not found:
        return spark.createDataFrame([], "codes array<int>, count long")
    whole = found[0]
    for more in found[1:]:
        whole = whole.unionByName(more)
    return whole


def level_wise_itemsets(tx: DataFrame, min_support: float = 0.05, max_len: int | None = 3,
                        items_col: str = "items") -> DataFrame:
    """M3 for any array of items: itemsets (sorted array ``items``) with ``count``, ``total``
    (the number of transactions), ``support`` and ``size``; support >= ``min_support`` (compared as
    the double ``count / total``), size <= ``max_len`` (None: as far as there are any).

    A repeated item counts once, null items not at all; a transaction without items counts in
    ``total``. The frequent items, no more than the mean items of a transaction over
    ``min_support``, are the only table that is broadcast. The levels are written to the shared
    scratch folder one by one. An empty table has no itemsets.
    """
    spark = tx.sparkSession
    total = tx.count()
    vertical = _stored(item_bitmaps(tx, items_col), "item-bitmaps")
    frequent = F.col("count") / F.lit(total) >= F.lit(min_support)
    single = (vertical.groupBy("item").agg(F.sum(F.bitmap_count("bits")).alias("count")).where(frequent)
              .withColumn("code", (F.row_number().over(Window.orderBy("item")) - 1).cast("int")))
    single = _stored(single, "frequent-items")
    blocks = _stored(vertical.join(F.broadcast(single), "item").groupBy("block")
                     .agg(F.sort_array(F.collect_list(F.struct("code", "bits"))).alias("x"))
                     .select(F.col("x.code").alias("codes"), F.col("x.bits").alias("bitmaps")), "block-bitmaps")
    n_items = single.count()
    levels = [single.select(F.array("code").alias("codes"), "count")]
    while max_len is None or len(levels) < max_len:
        size = len(levels) + 1
        made = _stored(candidates(levels[-1].select("codes"), size), "candidates")
        level = _stored(_counted(blocks, made, n_items).where(frequent), "level")
        if level.isEmpty():
            break
        levels.append(level)
    whole = levels[0]
    for level in levels[1:]:
        whole = whole.unionByName(level)
    names = single.agg(F.transform(F.sort_array(F.collect_list(F.struct("code", "item"))), lambda x: x["item"])).scalar()
    items = F.transform("codes", lambda c: F.element_at(F.col("names"), c + 1))
    out = whole.withColumn("names", names).select(items.alias("items"), "count", F.lit(total).cast("bigint").alias("total"))
    return out.select("items", "count", "total", (F.col("count") / F.col("total")).alias("support"), F.size("items").alias("size"))
