"""Delimited sources (inventory S1-S4) and source-order capture.

pandas keeps rows in file order; Spark does not. Every reader here adds an
orderable ``_row`` column (file path, split start, position within the
split, or a dense ordinal) at ingest, before any shuffle, so first-row-wins and dense
numbering stay defined after the data is spread over a cluster.
"""

from __future__ import annotations

import csv
import io
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructType

from starloom.sources.records import AT, Dialect, first_records, quoted_records, record_ordinal

ROW = "_row"


def file_ordinal(df: DataFrame, col: str = ROW) -> DataFrame:
    """Dense 0-based ordinal in file order for a DataFrame read straight from
    files (row-local filters allowed), without any shuffle or sort.

    Within one file split, rows keep file order and their task assigns
    ``monotonically_increasing_id`` in sequence; so per split (file path,
    split start) the rows are ``min id .. min id + count - 1``. A table of one
    row per split (bounded by the number of splits) gives each split's
    offset by a prefix sum in (file, split) order; it is broadcast back. Scan
    partitions are fixed by the file listing, so both passes see the same ids
    and a recomputed task reproduces them.
    """
    meta = F.col("_metadata")
    stamped = (df.withColumn("__file", meta.getField("file_path"))
               .withColumn("__split", meta.getField("file_block_start"))
               .withColumn("__mid", F.monotonically_increasing_id()))
    return _numbered(stamped, col)


def _numbered(stamped: DataFrame, col: str) -> DataFrame:
    """``col`` from (``__file``, ``__split``, ``__mid``): see :func:`file_ordinal`."""
    splits = stamped.groupBy("__file", "__split").agg(F.count(F.lit(1)).alias("__n"), F.min("__mid").alias("__first"))
    w = Window.orderBy("__file", "__split").rowsBetween(Window.unboundedPreceding, -1)
    offsets = splits.select("__file", "__split", "__first", F.coalesce(F.sum("__n").over(w), F.lit(0)).alias("__off"))
    # one row per input split: the input's size over the split size bounds them
    out = stamped.join(F.broadcast(offsets), ["__file", "__split"])
    return (out.withColumn(col, F.col("__off") + F.col("__mid") - F.col("__first"))
            .drop("__file", "__split", "__mid", "__first", "__off"))


def _integer(col, dtype: str):
    """Integer text to ``dtype``: exact integer parse first (large keys keep
    full precision), else through double so ``2023.0`` or ``1e3`` parse too,
    as pandas' numeric parsing does; anything else is null."""
    return F.coalesce(col.try_cast(dtype), col.try_cast("double").try_cast(dtype))


def header_record(spark: SparkSession, path: str, key: str, records: DataFrame | None = None) -> str:
    """The raw text of the record that holds the labels: the first record, in file order,
    with a cell that is exactly ``key``, however many banner lines stand above it and
    however many lines it spans. Executors look for it; this one record comes to the driver.
    ``records`` are the records of ``path``, where they are at hand (:func:`quoted_records`)."""
    records = quoted_records(spark, path) if records is None else records
    cell = "(?s)^(.*[,\\n])?\"?" + _quoted(key) + "\"?([,\\r\\n].*)?$"
    found = records.where(F.col("record").contains(key) & F.col("record").rlike(cell)).orderBy(*AT).limit(1).select("record").collect()
    if not found:
        raise ValueError(f"{path}: no record has a cell {key!r}")
    return found[0][0]


def header_labels(record: str) -> list[str]:
    """The labels of a raw header record."""
    return next(csv.reader(io.StringIO(record, newline="")))


def _quoted(text: str) -> str:
    """``text`` as a literal of a regular expression."""
    return "\\Q" + text + "\\E"


def read_sheet_csv(spark: SparkSession, path: str, schema: StructType | str, header: str | None = None,
                   options: dict[str, str] | None = None, dense_order: bool = False,
                   integers: tuple[str, ...] = (), records: DataFrame | None = None) -> DataFrame:
    """One exported sheet with an explicit schema (no inference pass).

    Labels come from the schema *by position*, so headers that differ only in
    case or hold newlines survive. A quoted cell may hold line breaks, commas and doubled
    quotes, also where a split ends inside it (:func:`quoted_records`). Without ``header`` the first
    record of every file is its header. With ``header``, the raw header record (:func:`header_record`),
    everything in a file up to that record is banner or header and goes by its
    place; a file without it keeps all its records. Every other record is kept, also
    one whose key is empty or cannot be parsed (that cell is null); only blank lines
    are no records. ``_row`` is the file position, or with ``dense_order`` a dense
    0-based ordinal. ``records`` are the records of ``path``, where they are at hand.
    """
    st = StructType.fromDDL(schema) if isinstance(schema, str) else schema
    labels = [f.name for f in st.fields]
    # ``integers``: labels read as text and converted by :func:`_integer`.
    internal = StructType([f.__class__(f"_c{i}", StringType() if f.name in integers else f.dataType, f.nullable)
                           for i, f in enumerate(st.fields)])
    records = quoted_records(spark, path) if records is None else records
    heads = first_records(records, None if header is None else F.rtrim("record") == header.rstrip())
    if dense_order:
        body = record_ordinal(records, heads, ROW)
    else:
        body = (records.join(F.broadcast(heads), "file", "left")  # one row a file
                .where(F.col("head").isNull() | (F.struct("block", "nth") > F.col("head")))
                .withColumn(ROW, F.struct("file", "block", F.col("nth").alias("pos"))))
    cells = F.from_csv("record", ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in internal.fields),
                       {"mode": "PERMISSIVE", **Dialect().options(), **(options or {})})
    # generated, so a record is parsed once: a filter on its cells would else be pushed below the
    # projection, with a copy of the parser for each cell that it mentions
    df = body.select(ROW, F.inline(F.array(cells)))
    return df.select(*[(_integer(F.col(f"_c{i}"), f.dataType.simpleString()) if f.name in integers else F.col(f"_c{i}"))
                       .alias(label) for i, (f, label) in enumerate(zip(st.fields, labels))], ROW)


# Where the records of the dwellings file lie, and its columns.
DWELLING_PREAMBLE, DWELLING_FIRST, DWELLING_LAST = 7, 2, 5
DWELLING_COLUMNS = ("lga_name", "dwelling_count")


def read_trimmed_csv(spark: SparkSession, path: str, names: Sequence[str] = DWELLING_COLUMNS,
                     skip_lines: int = DWELLING_PREAMBLE, drop_first: int = DWELLING_FIRST,
                     drop_last: int = DWELLING_LAST) -> DataFrame:
    """S2+S3: a delimited file with a preamble and a footer, trimmed by place.

    The first ``skip_lines`` lines go, blank lines are no records, then the first
    ``drop_first`` and the last ``drop_last`` records go; every other record is
    kept, whatever its spelling: a name may be quoted or not and hold quotes or commas,
    further cells are ignored, a count that is no whole number is null. Places over all
    files, in path order, come from ordinals (:func:`file_ordinal`), without a shuffle.
    """
    text = file_ordinal(spark.read.text(path), "__line").where(F.col("__line") >= skip_lines).where(F.trim("value") != "")
    first = text.orderBy("__line").limit(drop_first).agg(F.max("__line")).scalar()
    last = text.orderBy(F.desc("__line")).limit(drop_last).agg(F.min("__line")).scalar()
    kept = text
    if drop_first:
        kept = kept.where(F.col("__line") > first)
    if drop_last:
        kept = kept.where(F.col("__line") < last)
    cells = F.from_csv("value", ", ".join(f"`{n}` string" for n in names), {"mode": "PERMISSIVE", "escape": '"'})
    out = kept.select(cells.alias("__r"), F.col("__line").alias(ROW)).select("__r.*", ROW)
    return out.withColumn(names[1], _integer(F.trim(names[1]), "bigint"))
