"""Helpers shared by the operators: written intermediate tables, fixed-rate
bounded samples of labelled rows, hash folds."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.session import scratch_path


def written(df: DataFrame, name: str, compression: str | None = None, **options) -> DataFrame:
    """Write ``df`` under the shared checkpoint folder, with further ``options`` of the
    writer, and read it back.

    This cuts the lineage and survives the loss of any executor, since the
    files lie in shared storage."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.options(**options).parquet(path, compression=compression)
    return spark.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    """The named columns of a given table."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet").select(*columns)


def crc_fold(column: str, folds: int) -> Column:
    """crc32 of the id written as text, modulo ``folds``; null ids are fold 0."""
    return F.coalesce(F.crc32(F.col(column).cast("string").cast("binary")) % folds, F.lit(0))


def bounded_sample(rows: DataFrame, key: str, limit: int) -> DataFrame:
    """About ``limit`` rows at most in expectation, chosen by a hash of
    ``key`` (all rows if there are no more than ``limit``). The choice depends on
    the data alone, so reruns agree."""
    total = rows.count()
    if total <= limit:
        return rows
    cut = int(limit / total * (1 << 30))
    return rows.where(F.pmod(F.xxhash64(F.lit("sample"), F.col(key)), F.lit(1 << 30)) < cut)


def labelled_sample(docs: DataFrame, labels: DataFrame, limit: int, id_col: str = "doc_id") -> DataFrame:
    """``docs`` (id, text) of about ``limit`` labelled rows at most, with ``label``.

    ``labels`` has the id and ``label``; null ids and null labels are left out, and of
    several labels of an id the largest counts. The ids are drawn from the labels
    alone, so no more than the sample (``limit`` ids) is broadcast."""
    known = (labels.where(F.col(id_col).isNotNull() & F.col("label").isNotNull())
             .groupBy(id_col).agg(F.max("label").alias("label")))
    return docs.join(F.broadcast(bounded_sample(known, id_col, limit)), id_col)


def free_names(docs: DataFrame, n: int) -> list[str]:
    """``n`` column names that ``docs`` does not have, whatever their case."""
    taken, out, at = {c.lower() for c in docs.columns}, [], 0
    while len(out) < n:
        name = f"_made{at}"
        if name not in taken:
            out.append(name)
        at += 1
    return out
