"""The ETL job on exported source sheets: read, conform, build, load, export,
check keys. The counterpart of running the reference's ETL script.

Sheets arrive as delimited exports (one folder or file per sheet). Their
labels are taken from the file's own header record, by position, so labels
that differ only in case or contain newlines are kept exactly; every column is
read as text except the few the build needs typed (a failed parse is null,
never an error, and never a lost row).

    python -m starloom.plans.etl --fatalities F --crashes C \\
        --fatality-counts FC --crash-counts CC [--dwellings D] --out OUT
"""

from __future__ import annotations

import argparse
from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.operators import quality
from starloom.operators.conform import SALT_BUCKETS
from starloom.plans import warehouse as wh
from starloom.session import scratch_scope
from starloom.sinks.tables import BUCKETS_KEY, write_csv, write_warehouse
from starloom.sources.delimited import header_labels, header_record, read_sheet_csv, read_trimmed_csv
from starloom.sources.records import quoted_records

# The columns read with a type (everything else is text).
RECORD_TYPES = {"Crash ID": "bigint", "Year": "int", "Month": "int", "Age": "int"}
COUNT_TYPES = {"Date": "date", "Number Fatalities": "bigint", "Number of fatal crashes": "bigint"}


def read_exported_sheet(spark: SparkSession, path: str, types: Mapping[str, str], key: str,
                        date_format: str = "yyyy-MM-dd", dense_order: bool = False) -> DataFrame:
    """One exported sheet; its labels come from its header record, the one with a
    cell ``key``, and every record below is kept. ``_row`` is the file position, or a dense ordinal
    (``dense_order``)."""
    records = quoted_records(spark, path)
    record = header_record(spark, path, key, records)
    labels = header_labels(record)
    ddl = ", ".join(f"`{lab.replace('`', '``')}` {types.get(lab, 'string')}" for lab in labels)
    integers = tuple(lab for lab in labels if types.get(lab) in ("int", "bigint"))
    return read_sheet_csv(spark, path, ddl, header=record, options={"dateFormat": date_format}, dense_order=dense_order,
                          integers=integers, records=records)


def key_is_unique(df: DataFrame, key: str) -> bool:
    """True if no key value (null included) occurs twice."""
    return key_facts(df, key)[0]


def key_facts(df: DataFrame, key: str) -> tuple[bool, bool]:
    """Whether no key value (null included) occurs twice, and whether a key is null: one aggregate
    over the keys, one row returned."""
    most, null = df.groupBy(key).count().agg(F.max("count"), F.max(F.col(key).isNull())).first()
    return (most or 0) < 2, bool(null)


@dataclass
class SheetPaths:
    fatalities: str
    crashes: str
    fatality_counts: str
    crash_counts: str
    dwellings: str | None = None


@dataclass
class EtlResult:
    tables: dict[str, str]        # table name -> location (see sinks.read_warehouse)
    processed: dict[str, str]
    conflicts: DataFrame
    decisions: dict
    buckets: int | None = None

    @property
    def locations(self) -> dict[str, str]:
        """Locations including the bucket count, for ``read_warehouse``."""
        out = dict(self.tables)
        if self.buckets:
            out[BUCKETS_KEY] = str(self.buckets)
        return out


def run(spark: SparkSession, paths: SheetPaths, out: str, buckets: int | None = None,
        enforce_keys: bool = True, salt_buckets: int | None = SALT_BUCKETS) -> EtlResult:
    """The whole job. Everything it returns lies under ``out``; its intermediate tables are
    removed at the end. Tables whose keys offend are not loaded: the job raises and a warehouse loaded
    earlier stays current."""
    with scratch_scope(spark):
        return _run(spark, paths, out.rstrip("/"), buckets, enforce_keys, salt_buckets)


def _run(spark: SparkSession, paths: SheetPaths, out: str, buckets: int | None, enforce_keys: bool,
         salt_buckets: int | None) -> EtlResult:
    # The fatality sheet's row order is its file order: number the rows at the
    # scan (no shuffle). If every crash key is unique the merge keeps one row
    # per fatality, so that number is the fatality id and the build skips
    # sorting the largest table; otherwise the general numbering runs.
    fat = read_exported_sheet(spark, paths.fatalities, RECORD_TYPES, "Crash ID", dense_order=True)
    crash = read_exported_sheet(spark, paths.crashes, RECORD_TYPES, "Crash ID")
    one_to_one, null_keys = key_facts(crash, "Crash ID")
    if one_to_one:
        crash = crash.drop("_row")
    fcount = read_exported_sheet(spark, paths.fatality_counts, COUNT_TYPES, "Date")
    ccount = read_exported_sheet(spark, paths.crash_counts, COUNT_TYPES, "Date")
    dwell = read_trimmed_csv(spark, paths.dwellings) if paths.dwellings else None

    # without a null crash key there is nothing that a null fatality key could match
    conformed = wh.conform_records(fat, crash, null_safe=null_keys, salt_buckets=salt_buckets)
    counts = wh.conform_counts(fcount, ccount)
    processed = {name: f"{out}/processed/{name}" for name in ("records", "daily_counts", "conflicts")}
    write_csv(conformed.frame.drop(wh.ROW), processed["records"])
    write_csv(counts.drop(wh.ROW), processed["daily_counts"])
    conformed.conflicts.write.mode("overwrite").parquet(processed["conflicts"])
    tables = wh.build_warehouse(conformed.frame, counts, dwell, fatality_ids_from_row=one_to_one, deferred=True)
    locations = write_warehouse(spark, tables, path=f"{out}/warehouse", buckets=buckets,
                                check=quality.check_warehouse if enforce_keys else None)
    buckets = int(locations.pop(BUCKETS_KEY)) if BUCKETS_KEY in locations else None
    return EtlResult(locations, processed, spark.read.parquet(processed["conflicts"]), conformed.decisions, buckets)


def main(argv: list[str] | None = None) -> None:
    ap = argparse.ArgumentParser(description=__doc__.splitlines()[0])
    ap.add_argument("--fatalities", required=True)
    ap.add_argument("--crashes", required=True)
    ap.add_argument("--fatality-counts", required=True)
    ap.add_argument("--crash-counts", required=True)
    ap.add_argument("--dwellings")
    ap.add_argument("--out", required=True)
    ap.add_argument("--no-key-check", action="store_true")
    ap.add_argument("--salt-buckets", type=int, default=SALT_BUCKETS, help="tasks that the conform join fills evenly (0: as the session shuffles)")
    a = ap.parse_args(argv)
    spark = SparkSession.builder.getOrCreate()
    res = run(spark, SheetPaths(a.fatalities, a.crashes, a.fatality_counts, a.crash_counts, a.dwellings), a.out,
              enforce_keys=not a.no_key_check, salt_buckets=a.salt_buckets)
    for name, location in res.tables.items():
        print(f"{name}: {location}")
    for name, path in res.processed.items():
        print(f"processed {name}: {path}")


if __name__ == "__main__":
    main()
