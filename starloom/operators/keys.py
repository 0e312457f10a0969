"""Surrogate keys and first-row-wins deduplication (inventory W3, A6, J5).

Row order in the reference is the pandas row index. Here order is an explicit,
comparable column (``_row``: a number or a struct such as
``(file_path, block_start, position)``), so results never depend on how Spark
happened to partition the data.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from starloom.session import SCRATCH_CODEC, scratch_path

_LOW_BITS = (1 << 33) - 1


def _cols(order: str | Column | Sequence[str | Column]) -> list[Column]:
    if isinstance(order, (str, Column)):
        order = [order]
    return [F.col(o) if isinstance(o, str) else o for o in order]


def dense_ids(df: DataFrame, order: str | Column | Sequence[str | Column], id_col: str,
              num_partitions: int | None = None, break_ties: bool = False,
              columns: Sequence[str] | None = None) -> DataFrame:
    """``range(0, len(df))`` in the order given by ``order``. The result has the ``columns`` of
    ``df`` (by default all) and the id; the written copy holds no others.

    Distributed, with no single-task window:

    1. range-partition on the order (Spark samples the key distribution).
       With a unique order (a source position) this spreads evenly and is
       fully deterministic if a lost task is recomputed. ``break_ties=True``
       adds a per-row tie-breaker so that even a third of all rows being exact
       copies of one row spread over many partitions (copies are
       interchangeable); its values follow arrival order, so use it where the
       input order is fixed (rows straight from files) or a recompute cannot
       move a copy across a range bound;
    2. sort within each partition and take each row's position from
       ``monotonically_increasing_id`` (documented layout: partition index in
       the upper 31 bits, position within the partition in the lower 33);
    3. count rows per partition (one row per partition, bounded by the
       partition count), prefix-sum the counts, broadcast the offsets back.

    Range bounds come from sampling, and sampling a shuffled input depends on
    the order rows arrive in, so two evaluations of the range exchange may
    partition differently. The positioned rows are therefore written once (as
    Parquet under ``spark.checkpoint.dir``); counts and ids both come from
    that one copy, which also survives executor loss.
    """
    order_cols = _cols(order)
    spark = df.sparkSession
    work = df
    keys = list(order_cols)
    if break_ties:
        work = work.withColumn("__tie", F.monotonically_increasing_id())
        keys.append(F.col("__tie"))
    # Without an explicit count the range exchange starts from the session's
    # shuffle partition count and AQE may merge adjacent ranges, which keeps
    # the global order; the ids are stamped once, in the job writing the copy.
    ranged = (work.repartitionByRange(*([num_partitions] if num_partitions else []), *keys)
              .sortWithinPartitions(*keys)
              .withColumn("__mid", F.monotonically_increasing_id())
              .withColumn("__pid", F.shiftright(F.col("__mid"), 33))
              .withColumn("__pos", F.col("__mid").bitwiseAND(F.lit(_LOW_BITS)))
              .drop("__mid", "__tie"))
    if columns is not None:
        ranged = ranged.select(*columns, "__pid", "__pos")
    # One written copy (Parquet under spark.checkpoint.dir): counts and ids
    # both read it, the count pass only its partition-id column.
    path = scratch_path(spark, "dense-ids")
    ranged.write.mode("overwrite").parquet(path, compression=SCRATCH_CODEC)
    ranged = spark.read.parquet(path)
    counts = ranged.groupBy("__pid").agg(F.count(F.lit(1)).alias("__n"))
    # The counts table has one row per range partition: bounded by n.
    offsets = counts.select(
        "__pid",
        (F.sum("__n").over(Window.orderBy("__pid").rowsBetween(Window.unboundedPreceding, -1)))
        .alias("__off"))
    out = (ranged.join(F.broadcast(offsets), "__pid")
           .withColumn(id_col, F.coalesce(F.col("__off"), F.lit(0)) + F.col("__pos")))
    return out.drop("__tie", "__mid", "__pid", "__pos", "__off")


def keep_first(df: DataFrame, key: str | Sequence[str], row_col: str = "_row") -> DataFrame:
    """``drop_duplicates(subset=key)``, first row (smallest ``row_col``) wins.

    ``dropDuplicates`` keeps an arbitrary survivor; here the survivor is chosen
    by ``min_by`` inside a hash aggregate, so partial aggregation collapses a
    hot key map-side before the shuffle.
    """
    keys = [key] if isinstance(key, str) else list(key)
    others = [c for c in df.columns if c not in keys]
    packed = F.struct(*[F.col(c) for c in others])
    agg = df.groupBy(*keys).agg(F.min_by(packed, F.col(row_col)).alias("__first"))
    return agg.select(*keys, *[F.col("__first")[c].alias(c) for c in others]).select(*df.columns)

