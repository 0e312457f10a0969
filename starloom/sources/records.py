"""Records of delimited files whose cells may hold line breaks, from files cut into splits.

A split does not know whether it begins inside a quoted cell. So every split is
first read for both cases: where does it end if it begins outside, and where if inside a
cell. These two answers are one of four functions of a bit; composing them over the splits of a
file in order (running sums over one row a split) tells each split how it begins. Then the
lines are joined to records inside their split, and what a split border cuts in two
is joined over the border. Files stay splittable at any size.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from starloom.session import SCRATCH_CODEC, scratch_path, stored

#: Where a record lies: number of its file in path order, start of the split it begins in, and its number among the
#: records that begin there (blank lines are no records).
AT = ("file", "block", "nth")


@dataclass(frozen=True)
class Dialect:
    """One-character separator, quote and escape (a quote doubled, by default)."""

    sep: str = ","
    quote: str = '"'
    escape: str = '"'

    def options(self) -> dict[str, str]:
        return {"sep": self.sep, "quote": self.quote, "escape": self.escape}


def ends_inside(line: str, inside: bool, dialect: Dialect = Dialect()) -> bool:
    """Whether a line that begins inside a quoted cell, or at the start of a record, ends
    inside a quoted cell. Only a quote at the start of a cell opens it; after the closing quote
    the rest of the cell is plain text."""
    sep, quote, escape = dialect.sep, dialect.quote, dialect.escape
    at, end = 0, len(line)
    while True:
        if not inside:
            if not line.startswith(quote, at):
                at = line.find(sep, at) + 1
                if not at:
                    return False
                continue
            at += 1
        while at < end:  # to the closing quote
            if line[at] == escape and escape != quote:
                at += 2
            elif line[at] != quote:
                marks = [k for k in (line.find(quote, at), line.find(escape, at)) if k >= 0]
                at = min(marks) if marks else end
            elif escape == quote and line.startswith(quote, at + 1):
                at += 2
            else:
                break
        if at >= end:
            return True
        at = line.find(sep, at + 1) + 1
        if not at:
            return False
        inside = False


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """(file, block, rows of them) of consecutive lines of one split."""
    for batch in batches:
        if not batch.num_rows:
            continue
        files, blocks = batch.column("file"), batch.column("block")
        other = pc.or_(pc.not_equal(files[1:], files[:-1]), pc.not_equal(blocks[1:], blocks[:-1]))
        firsts = [0, *(np.flatnonzero(other.to_numpy(zero_copy_only=False)) + 1).tolist()]
        for first, end in zip(firsts, [*firsts[1:], batch.num_rows]):
            yield files[first].as_py(), blocks[first].as_py(), batch.slice(first, end - first)


def _functions(dialect: Dialect):
    """How each split ends, for both ways to begin. A line without a quote changes nothing and comes as null."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, ends = None, [False, True]
        out: list[tuple] = []
        for file, block, rows in _runs(batches):
            if (file, block) != key:
                if key is not None:
                    out.append((*key, *ends))
                key, ends = (file, block), [False, True]
            for line in rows.column("value").drop_null().to_pylist():
                ends = [ends_inside(line, e, dialect) for e in ends]
        if key is not None:
            out.append((*key, *ends))
        columns = list(zip(*out)) or [()] * 4
        yield pa.RecordBatch.from_arrays([pa.array(columns[0], pa.string()), pa.array(columns[1], pa.int64()),
                                          pa.array(columns[2], pa.bool_()), pa.array(columns[3], pa.bool_())],
                                         ["file", "block", "outside", "inside"])

    return run


def split_starts(ends: DataFrame) -> DataFrame:
    """(file, block, begins): whether each split begins inside a cell, from (file, block,
    outside, inside), its ends for both ways to begin.

    A split either forgets how it began (both ends alike) or keeps or flips it; so a
    split begins as the last one before it that forgets, flipped once for each split in
    between that flips. The first begins outside."""
    order = Window.partitionBy("file").orderBy("block")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    flips = (F.col("outside") & ~F.col("inside")).cast("int")
    counted = (ends.withColumn("flips", F.coalesce(F.sum(flips).over(before), F.lit(0)))
               .withColumn("fixed", F.when(F.col("outside") == F.col("inside"), F.struct(
                   F.col("outside").cast("int").alias("to"), F.col("flips").alias("then")))))
    last = F.last("fixed", ignorenulls=True).over(before)
    begins = F.coalesce(last["to"], F.lit(0)) + F.col("flips") - F.coalesce(last["then"], F.lit(0))
    return counted.select("file", "block", (begins % 2 == 1).alias("begins"))


_PARTS = "file long, block long, nth long, opened boolean, closed boolean, record string"


def _joined(dialect: Dialect):
    """The records of each split, and the pieces of records that its borders cut."""

    kinds = (pa.int64(), pa.int64(), pa.int64(), pa.bool_(), pa.bool_(), pa.string())
    names = ["file", "block", "nth", "opened", "closed", "record"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, inside, held, opened, nth = None, False, [], True, 0
        out: list[tuple] = []  # records of several lines, and pieces

        def flush() -> pa.RecordBatch:
            columns = list(zip(*out))
            out.clear()
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)

        for file, block, rows in _runs(batches):
            if (file, block) != key:
                if held:
                    out.append((*key, nth, opened, False, "\n".join(held)))
                key, held, nth = (file, block), [], 0
                inside = rows.column("begins")[0].as_py()
                opened = not inside
            values = rows.column("value")
            quoted = np.flatnonzero(pc.match_substring(values, dialect.quote).to_numpy(zero_copy_only=False))
            # only a line with a quote can begin or end a cell of several lines; every other line outside is a record
            single = ~pc.or_(pc.equal(values, ""), pc.utf8_is_space(values)).to_numpy(zero_copy_only=False)
            ends, at = [], 0  # where records of several lines end; the first line of the one at hand
            for i, line in zip(quoted.tolist(), values.take(pa.array(quoted)).to_pylist()):
                was, inside = inside, ends_inside(line, inside, dialect)
                if inside and not was:
                    at = i
                elif was and not inside:
                    held += values.slice(at, i + 1 - at).to_pylist()
                    single[at:i + 1] = False
                    ends.append((i, opened, "\n".join(held)))
                    held, opened = [], True
            if inside:
                held += values.slice(at).to_pylist()
                single[at:] = False
            begun = single.astype(np.int64)
            begun[[i for i, whole, _ in ends if whole]] = 1
            number = nth + np.cumsum(begun) - begun
            out += [(*key, int(number[i]), whole, True, record) for i, whole, record in ends]
            nth += int(begun.sum())
            found = values.filter(pa.array(single))
            same = [pa.repeat(pa.scalar(v, k), len(found)) for v, k in zip((file, block, True, True), (*kinds[:2], *kinds[3:5]))]
            yield pa.RecordBatch.from_arrays([*same[:2], pa.array(number[single]), *same[2:], found.cast(pa.string())], names)
            if len(out) >= 10_000:
                yield flush()
        if held:
            out.append((*key, nth, opened, False, "\n".join(held)))
        if out:
            yield flush()

    return run


def _cleaned() -> Column:
    """A record without the carriage return at its end and the byte order mark at its file's start."""
    record = F.col("record")
    clean = F.when(record.contains("\r"), F.regexp_replace(record, "\\r$", "")).otherwise(record)
    first = (F.col("block") == 0) & (F.col("nth") == 0)
    return F.when(first, F.regexp_replace(clean, "^\\x{FEFF}", "")).otherwise(clean)


def quoted_records(spark: SparkSession, path: str, dialect: Dialect = Dialect()) -> DataFrame:
    """(file, block, nth, record): every record of the UTF-8 files under ``path``, which are numbered in path order.

    A record ends at a line feed outside of quoted cells; a carriage return before it and a byte
    order mark at the start of a file go, line breaks inside cells stay as they are. Blank lines
    between records are none. A cell whose quote is never closed reaches to the end of its
    file. The records are written once to the shared scratch folder, after one pass over the lines
    that finds how the splits begin; a task holds one record at a time, of which a
    split has no more than its size.
    """
    meta = F.col("_metadata")
    lines = spark.read.option("lineSep", "\n").text(path).select(
        meta.getField("file_path").alias("file"), meta.getField("file_block_start").alias("block"), "value")
    quoted = F.when(F.col("value").contains(dialect.quote), F.col("value"))
    ends = lines.withColumn("value", quoted).mapInArrow(_functions(dialect), "file string, block long, outside boolean, inside boolean")
    # one row per input split: the input's size over the split size bounds them. From here on a file is a number,
    # since its path is longer than most records
    starts = split_starts(ends).withColumn("number", F.dense_rank().over(Window.orderBy("file")).cast("long"))
    numbered = lines.join(F.broadcast(starts), ["file", "block"]).select(F.col("number").alias("file"), "block", "begins", "value")
    parts = numbered.mapInArrow(_joined(dialect), _PARTS)
    out = scratch_path(spark, "records")
    # a record is cleaned here, once; a piece when it is joined
    written = F.when(F.col("opened") & F.col("closed"), _cleaned()).otherwise(F.col("record"))
    parts.withColumn("record", written).write.parquet(out, compression=SCRATCH_CODEC)
    parts = spark.read.schema(_PARTS).parquet(out)
    # two pieces a split at most: the last one's end, and the next one's beginning
    cut = parts.where("not (opened and closed)").withColumn("chain", F.sum(F.col("opened").cast("int")).over(
        Window.partitionBy("file").orderBy("block", "opened")))
    joined = cut.groupBy("file", "chain").agg(
        F.min(F.when(F.col("opened"), F.struct("block", "nth"))).alias("at"),
        F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("block", "opened", "record"))),
                                 lambda x: x["record"]), "\n").alias("record"))
    joined = joined.select("file", F.col("at.block").alias("block"), F.col("at.nth").alias("nth"), "record")
    return parts.where("opened and closed").select(*AT, "record").unionByName(joined.withColumn("record", _cleaned()))


def record_ordinal(records: DataFrame, heads: DataFrame | None, col: str) -> DataFrame:
    """The records below the header of their file (``heads``: file, head = struct(block, nth);
    a file without a row there keeps all) with ``col``, a dense 0-based number over all files in path order.
    Counts of one row per split give each split's offset, so no record is sorted or moved. The offsets are
    counted and written once, whatever number of plans reads the result."""
    place = F.struct("block", "nth")
    if heads is None:
        headed = records.withColumn("head", F.lit(None).cast("struct<block:bigint,nth:bigint>"))
    else:
        headed = records.join(F.broadcast(heads), "file", "left")  # one row a file
    kept = headed.where(F.col("head").isNull() | (place > F.col("head")))
    skipped = F.when(F.col("head.block") == F.col("block"), F.col("head.nth") + 1).otherwise(0)
    splits = kept.groupBy("file", "block").agg(F.count(F.lit(1)).alias("n"))
    before = Window.orderBy("file", "block").rowsBetween(Window.unboundedPreceding, -1)
    offsets = stored(splits.select("file", "block", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset")),
                     scratch_path(records.sparkSession, "offsets"))
    return (kept.withColumn("skipped", skipped).join(F.broadcast(offsets), ["file", "block"])  # one row per split
            .withColumn(col, F.col("offset") + F.col("nth") - F.col("skipped")).drop("head", "skipped", "offset"))


def first_records(records: DataFrame, condition: Column | None = None) -> DataFrame:
    """(file, head): the place of each file's first record, or of its first one that meets
    ``condition``; found and written once, a row a file."""
    rows = records.where("nth = 0" if condition is None else condition)  # a file begins with the first record of a split
    return stored(rows.groupBy("file").agg(F.min(F.struct("block", "nth")).alias("head")),
                  scratch_path(records.sparkSession, "heads"))
