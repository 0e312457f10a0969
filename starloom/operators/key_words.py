"""Whole-number keys checked as words of 64 bits (inventory K5, K6, J10).

A key check only has to find the few keys that offend. Here the keys of a table are first
reduced to words: word ``k >> 6`` holds a bit for each of its 64 keys that occurs, and the number of
rows. The shuffle then moves one row (24 bytes) for up to 64 keys of a task instead of one a key. Two facts follow
exactly from the words, whatever the keys are:

* a word with fewer bits than rows holds a repeated key (K5);
* a bit that a child's word has and the parent's word has not is an orphan (K6).

Only then are rows read again, and only those that may offend: the offending words are folded into
a filter of 2^20 bits (at most 16,384 rows, so it may be broadcast at any size of the data), which
has no false negatives, and what passes is grouped by the key itself. The filter only saves work, the
grouping decides. A clean table has no such word, adaptive execution sees the empty filter, and the
second read does not take place.

Keys in the order of the files (surrogate numbers, order numbers, days) fill their words in each task.
Keys scattered over all tasks make about one word a key, somewhat more than shuffling the keys
would move; a table that lies partitioned on its key needs no shuffle at all and is better checked in place (see
:mod:`starloom.operators.quality`). A hot key is one row a task.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Bits of the filter of offending words; a power of two. It has at most a 64th of that many rows.
FILTER_BITS = 1 << 20
_WHOLE = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)


def is_whole(df: DataFrame, key: str) -> bool:
    """Whether column ``key`` has a type that words can hold: a whole number or a date."""
    return isinstance(df.schema[key].dataType, (*_WHOLE, T.DateType))


def _number(df: DataFrame, key: str) -> Column:
    return F.unix_date(key) if isinstance(df.schema[key].dataType, T.DateType) else F.col(key).cast("bigint")


def _bit(place: Column) -> Column:
    """A long whose only bit is the one of ``place`` modulo 64."""
    return F.call_function("shiftleft", F.lit(1).cast("bigint"), place.bitwiseAND(F.lit(63)).cast("int"))


def _word(number: Column) -> Column:
    return F.shiftright(number.cast("bigint"), 6)


def words(df: DataFrame, key: str) -> DataFrame:
    """One row a word: ``word`` (null for null keys), ``bits`` (null there), ``n_rows``."""
    number = _number(df, key)
    return (df.select(_word(number).alias("word"), _bit(number).alias("bit"))
            .groupBy("word").agg(F.bit_or("bit").alias("bits"), F.count(F.lit(1)).alias("n_rows")))


def _filter(found: DataFrame) -> DataFrame:
    """The words of ``found`` as a filter: rows ``slot``, ``mask`` of one bit a hash value."""
    place = F.pmod(F.xxhash64("word"), F.lit(FILTER_BITS))
    return found.groupBy(F.shiftright(place, 6).alias("slot")).agg(F.bit_or(_bit(place)).alias("mask"))


def _passing(rows: DataFrame, word: Column, found: DataFrame) -> DataFrame:
    """The rows whose word is in ``found``, and a few more where hash values meet."""
    kept = rows.columns
    place = F.pmod(F.xxhash64(word), F.lit(FILTER_BITS))
    placed = rows.withColumn("__place", place).withColumn("__slot", F.shiftright("__place", 6))
    hit = F.col("mask").bitwiseAND(_bit(F.col("__place"))) != 0
    slots = F.broadcast(_filter(found))  # at most FILTER_BITS / 64 rows
    return placed.join(slots, F.col("__slot") == F.col("slot")).where(hit).select(*kept)


def repeated_or_null(df: DataFrame, key: str) -> DataFrame:
    """K5: the values of ``key`` that are null or occur in two rows and more, as ``key`` and ``n_rows``."""
    doubtful = words(df, key).where(F.col("word").isNull() | (F.bit_count("bits") < F.col("n_rows")))
    keys = df.select(F.col(key).alias("key"), _number(df, key).alias("number"))
    counted = (_passing(keys, _word(F.col("number")), doubtful)
               .groupBy("key").agg(F.count(F.lit(1)).alias("n_rows")))
    return counted.where((F.col("n_rows") > 1) | F.col("key").isNull())


def orphans(children: Sequence[tuple[DataFrame, str]], parent: DataFrame, parent_key: str) -> DataFrame:
    """The values that a child column has and ``parent_key`` has not, as ``key`` (the number; days since
    1970 for dates) with the rows of each child that carry it in ``n0``, ``n1``, ...

    Null keys are no orphans; the parent may repeat keys. The children are united before they are reduced, so
    each parent is compared once."""
    united = reduce(DataFrame.unionByName, [
        df.select(F.lit(i).alias("child"), _number(df, key).cast("bigint").alias("key")).where(F.col("key").isNotNull())
        for i, (df, key) in enumerate(children)])
    there = words(parent.where(F.col(parent_key).isNotNull()), parent_key).select("word", F.col("bits").alias("known"))
    without = (words(united, "key").join(there, "word", "left")
               .select("word", F.col("bits").bitwiseAND(F.bitwise_not(F.coalesce("known", F.lit(0).cast("bigint")))).alias("bits"))
               .where("bits <> 0"))
    counted = (_passing(united, _word(F.col("key")), without)
               .groupBy("key").agg(*[F.count_if(F.col("child") == i).alias(f"n{i}") for i in range(len(children))]))
    each = without.select("word", "bits", F.explode(F.sequence(F.lit(0), F.lit(63))).alias("place"))
    keys = each.where(F.col("bits").bitwiseAND(_bit(F.col("place"))) != 0).select(
        F.shiftleft("word", 6).bitwiseOR(F.col("place").cast("bigint")).alias("key"))
    return counted.join(keys, "key", "left_semi")
