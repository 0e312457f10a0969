"""Mixing sources to target weights by blocks of words.

The words of each source form one stream (its documents in an order that only their
content decides), cut into blocks of fixed length. A source fills as many slots as its
target needs at its mean block length. Its slots are dealt to the output shards by
multinomial draws, one for each chunk of slots, so the counts of a shard are a multinomial
draw of all sources while every source's total stays exact. A source's slots, numbered over all
shards, run through its blocks in a pseudorandom order, a new one for each pass; slots
and blocks are joined by block index.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import AtomicType

from starloom.llm.common import written
from starloom.llm.feistel import permute

#: A word, and the white space that ends it.
WORD, GAP = r"[^\x20\x09-\x0D]+", r"[\x20\x09-\x0D]*"
WEIGHTS = (5, 2, 1)
#: Times that a block may be taken.
PASSES = 3
#: Documents of a source whose stream offsets one task sums up.
CHUNK_ROWS = 8192
#: Slots of a source that one draw deals out.
CHUNK_SLOTS = 4096


def source_targets(sizes: DataFrame, weights: Sequence[float] = WEIGHTS, share: float = 1.0) -> DataFrame:
    """For rows (source, size): one row per source with its position
    ``source_no`` by code point (null last), ``documents``, ``source_size`` and
    ``target`` words.

    A target is the source's share by weight of ``share`` times all sizes, at most
    PASSES times its size; what is over goes to the others by weight, until none
    is above. So targets are min(PASSES * size, level * weight) for one level,
    which the sources sorted by the level that fills them give in one pass (a
    window over the sources alone)."""
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("source_no") % len(weights) + 1).cast("int"))
    by_source = sizes.groupBy("source").agg(F.sum("size").cast("long").alias("source_size"),
                                            F.count(F.lit(1)).alias("documents"))
    numbered = (by_source.withColumn("source_no", F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1)
                .withColumn("weight", weight))
    fill = Window.orderBy(F.col("source_size") * PASSES / F.col("weight"), "source_no")
    cap = F.col("source_size") * float(PASSES)
    everything = Window.partitionBy()
    below = F.coalesce(F.sum(cap).over(fill.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    open_weight = F.sum("weight").over(fill.rowsBetween(0, Window.unboundedFollowing))
    level = (F.sum("source_size").over(everything) * share - below) / open_weight
    leveled = numbered.withColumn("level", level).withColumn("open", F.col("level") * F.col("weight") <= cap)
    final = F.min(F.when(F.col("open"), F.struct(F.col("source_size") * PASSES / F.col("weight"), "source_no", "level"))
                  ).over(everything)["level"]
    return leveled.select("source", "source_no", "documents", "source_size",
                          F.when(F.col("open"), F.least(cap, final * F.col("weight"))).otherwise(cap).alias("target"))


def _deal(shards: int, seed: int):
    """The block, pass and shard of every slot of some chunks of slots."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for row in batch.itertuples(index=False):
                k = row.chunk * CHUNK_SLOTS + np.arange(min(CHUNK_SLOTS, row.slots - row.chunk * CHUNK_SLOTS))
                counts = np.random.default_rng([seed, row.source_no, row.chunk])
                shard = np.sort(counts.integers(0, shards, len(k)))  # a multinomial draw of the chunk's counts
                turn = k // row.blocks
                key = (seed << 40) + (row.source_no << 8) + turn
                yield pd.DataFrame({"source_no": row.source_no, "block": permute(k % row.blocks, row.blocks, key),
                                    "turn": turn.astype(np.int32), "shard": shard})

    return run


def slots_of(sources: DataFrame, block_words: int) -> DataFrame:
    """``sources`` (source_targets) with ``blocks`` and ``slots``: a slot brings the source's
    mean block, so target / mean block of them, at most PASSES a block."""
    blocks = F.ceil(F.col("source_size") / block_words)
    slots = F.least(F.round(F.col("target") * F.col("blocks") / F.greatest("source_size", F.lit(1))).cast("long"),
                    PASSES * F.col("blocks"))
    return sources.withColumn("blocks", blocks).withColumn("slots", slots)


def dealt(sources: DataFrame, per_shard: int, seed: int) -> DataFrame:
    """A row (source_no, block, turn, shard) for every slot. A hot source's slots are as many
    tasks' work as any others'."""
    spark = sources.sparkSession
    shards = max(1, -(-(sources.agg(F.sum("slots")).first()[0] or 0) // per_shard))
    outer = F.expr(f"sequence(0L, (slots - 1) div {CHUNK_SLOTS ** 2})")  # two steps, so that no array is long
    inner = F.expr(f"sequence(outer * {CHUNK_SLOTS}, least(outer * {CHUNK_SLOTS} + {CHUNK_SLOTS - 1}, (slots - 1) div {CHUNK_SLOTS}))")
    chunks = (sources.where("slots > 0").select("source_no", "blocks", "slots", F.explode(outer).alias("outer"))
              .select("source_no", "blocks", "slots", F.explode(inner).alias("chunk")))
    # few short rows stand for many slots: adaptive execution must not merge their tasks
    chunks = chunks.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "source_no", "chunk")
    return chunks.mapInPandas(_deal(shards, seed), "source_no int, block long, turn int, shard long")


def _plan(rows: DataFrame, block_words: int, per_shard: int, weights: Sequence[float], share: float,
          seed: int) -> tuple[DataFrame, DataFrame]:
    """For written rows (uid, h1, h2, source, size): the sources with their targets, and a
    row (uid, turn, first, words) for each run of words that is taken.

    A stream is ordered by the 128 bits of h1 and h2, made from the row's content; ``uid``
    only names the row. It decides between equal rows, which have equal words."""
    sources = written(slots_of(source_targets(rows, weights, share), block_words), "sources")
    chunk = F.pmod("h1", F.ceil(F.col("documents") / CHUNK_ROWS))
    keyed = (rows.where("size > 0").join(sources, rows["source"].eqNullSafe(sources["source"]))
             .select("uid", "h1", "h2", "size", "source_no", chunk.alias("chunk")))
    per_chunk = keyed.groupBy("source_no", "chunk").agg(F.sum("size").alias("words"))
    preceding = Window.unboundedPreceding, -1
    bases = per_chunk.select("source_no", "chunk", F.coalesce(F.sum("words").over(
        Window.partitionBy("source_no").orderBy("chunk").rowsBetween(*preceding)), F.lit(0)).alias("base"))
    inside = F.coalesce(F.sum("size").over(Window.partitionBy("source_no", "chunk").orderBy("h1", "h2", "size", "uid")
                                           .rowsBetween(*preceding)), F.lit(0))
    placed = (keyed.withColumn("inside", inside).join(bases, ["source_no", "chunk"])
              .select("uid", "size", "source_no", (F.col("base") + F.col("inside")).alias("start")))
    begin = F.greatest("start", F.col("block") * block_words)
    segments = (placed.withColumn("block", F.explode(F.expr(
        f"sequence(start div {block_words}, (start + size - 1) div {block_words})")))
        .select("uid", "source_no", "block", (begin - F.col("start")).alias("first"),
                (F.least(F.col("start") + F.col("size"), (F.col("block") + 1) * block_words) - begin).alias("words")))
    # far more rows than the sources that they are made from let the planner guess: never broadcast
    chosen = dealt(sources, per_shard, seed).hint("merge")
    return sources, segments.join(chosen, ["source_no", "block"]).select("uid", "turn", "first", "words")


def _named(content: Sequence[Column]) -> list[Column]:
    """Columns uid, h1 and h2 of a row of this content."""
    return [F.monotonically_increasing_id().alias("uid"), F.xxhash64(F.lit("one"), *content).alias("h1"),
            F.xxhash64(F.lit("two"), *content).alias("h2")]


def taken_words(docs: DataFrame, block_words: int = 64, per_shard: int = 4096, weights: Sequence[float] = WEIGHTS,
                share: float = 1.0, seed: int = 17, id_col: str = "doc_id", text_col: str = "text",
                source_col: str = "source") -> DataFrame:
    """One row per row of ``docs``: doc_id, source, size, source_size, target (both its
    source's) and ``taken``, the words of it that the mix takes, repeats counted.

    Null and empty texts have size 0 and nothing taken; null sources are one source,
    the last; repeated rows and ids are documents of their own. No rows, no result
    rows. Other columns are ignored. A source takes its target but for half a block and what its
    last, shorter block lacks. Reruns over the same rows agree, however they are split.
    """
    size = F.coalesce(F.regexp_count(text_col, F.lit(WORD)), F.lit(0)).cast("long")
    rows = written(docs.select(F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"), size.alias("size"),
                               *_named([F.col(id_col), F.col(source_col), F.col(text_col)])), "sizes")
    sources, runs = _plan(rows, block_words, per_shard, weights, share, seed)
    taken = runs.groupBy("uid").agg(F.sum("words").alias("taken"))
    return (rows.join(sources.select(F.col("source").alias("of"), "source_size", "target"),
                      F.col("source").eqNullSafe(F.col("of")))
            .join(taken, "uid", "left")
            .select("doc_id", "source", "size", "source_size", "target",
                    F.coalesce("taken", F.lit(0)).cast("long").alias("taken")))


def mix(docs: DataFrame, block_words: int = 64, per_shard: int = 4096, weights: Sequence[float] = WEIGHTS,
        share: float = 1.0, seed: int = 17, text_col: str = "text", source_col: str = "source") -> DataFrame:
    """The mixed documents: for every row of ``docs`` and every pass that takes words of
    it one row, its text cut down to these words (whole if all are taken) and
    followed by ``turn`` (0 to PASSES - 1), which replaces a column of that name. Rows without a
    taken word go. Cases as in ``taken_words``; rows that differ in other columns than numbers and
    texts alone count as equal."""
    names = [c for c in docs.columns if c != "turn"]
    plain = [F.col(f"`{f.name}`") for f in docs.schema.fields if f.name != "turn" and isinstance(f.dataType, AtomicType)]
    whole = written(docs.select(F.struct(*[F.col(f"`{c}`") for c in names]).alias("doc"), *_named(plain)), "mix-input")
    text = F.col("doc").getField(text_col)
    rows = written(whole.select("uid", "h1", "h2", F.col("doc").getField(source_col).alias("source"),
                                F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long").alias("size")), "sizes")
    _, runs = _plan(rows, block_words, per_shard, weights, share, seed)
    parts = (runs.groupBy("uid", "turn")
             .agg(F.sort_array(F.collect_list(F.struct("first", "words"))).alias("runs"),
                  F.sum("words").alias("taken")))  # a document's blocks, as many as its words need
    pieces = F.when(F.col("taken") < F.col("size"), F.regexp_extract_all(text, F.lit(WORD + GAP), F.lit(0)))
    cut = F.array_join(F.flatten(F.transform("runs", lambda r: F.slice(
        "pieces", (r["first"] + 1).cast("int"), r["words"].cast("int")))), "")
    found = (whole.select("doc", "uid").join(parts.join(rows.select("uid", "size"), "uid"), "uid")
             .withColumn("pieces", pieces).withColumn("cut", F.when(F.col("taken") < F.col("size"), cut).otherwise(text)))
    return found.select(*[(F.col("cut") if c == text_col else F.col("doc").getField(c)).alias(c) for c in names], "turn")
