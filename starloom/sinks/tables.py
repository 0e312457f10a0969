"""Sinks (inventory K1-K4).

``write_warehouse`` replaces the reference's ``to_sql(if_exists='replace')``
load. A load is staged: its tables are written into a folder of their own under the
warehouse's root, checked there, and only then made the current load by one row
appended to the manifest (``_loads``), a single small file that Spark commits by a rename. Until
that row is there, readers open the load before; a load that fails, in a
write or in its check, takes its own tables away and leaves the old ones as they were.

The crash-grain tables (one row per crash, so no key can
be hot) are bucketed and sorted on ``crash_id`` with one bucket count, so the
reports join them on ``crash_id`` without a shuffle. The fatality fact is not
bucketed: one crash may hold a large share of all fatalities, and a bucketed
scan reads a whole bucket in one task. Its plain, splittable files are
instead reduced to crash grain by partial aggregation before a small shuffle
into the same partitioning.
"""

from __future__ import annotations

import hashlib
import uuid
from concurrent.futures import ThreadPoolExecutor
from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from starloom.session import delete_path, path_exists, scratch_path

# Tables keyed by crash that share one bucketing.
CRASH_GRAIN = ("fact_crashes", "dim_time", "dim_vehicle", "dim_event", "dim_road")
BUCKET_KEY = "crash_id"
# Tables with a row a day, state or area, whatever the number of crashes.
FEW_KEYS = ("dim_date", "dim_state", "dim_lga", "fact_number")
BUCKETS_KEY = "__buckets__"
#: Manifest of a warehouse: one row for each load that was made current.
LOADS = "_loads"
LOADS_SCHEMA = "version bigint, load string, buckets int, columns map<string, string>"


def write_warehouse(spark: SparkSession, tables: Mapping[str, DataFrame], path: str | None = None,
                    buckets: int | None = None, parallel: int = 8,
                    check: Callable[[Warehouse], None] | None = None) -> dict[str, str]:
    """K2/K3: write every table as a new load of the warehouse in folder ``path``; returns
    table name -> catalog name (bucketed tables) or path (plain Parquet), plus the
    bucket count under ``__buckets__``.

    ``check`` gets the written tables before anyone else can open them and raises if they must not be
    loaded. If it raises, or a write does, the load's tables are removed, the error goes on, and
    the warehouse still is the load before (or none). Otherwise the load becomes current; the
    load it replaces keeps its files until the next one, for readers that opened it, and
    loses its catalog names. Loads of one folder must not run at the same time.

    The bucket count defaults to the session's shuffle partition count; 0 writes
    plain files. The writes are independent jobs; ``parallel``
    of them are submitted at once from a thread pool so small tables do not
    leave the cluster idle. A table may be given as a no-argument builder; it
    is then built in its writer thread, so tables that are ready start
    writing while others are still being built."""
    root = (path or scratch_path(spark, "warehouse")).rstrip("/")
    n = int(spark.conf.get("spark.sql.shuffle.partitions")) if buckets is None else buckets
    load = uuid.uuid4().hex[:12]
    columns: dict[str, str] = {}  # table -> its columns with types: a table without rows may be without files

    def write_one(name: str) -> tuple[str, str]:
        df = tables[name]
        if callable(df):  # a deferred builder: build inside this writer thread
            df = df()
        columns[name] = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)
        target = f"{root}/{load}/{name}"
        if name in CRASH_GRAIN and n:
            table = table_name(root, name, load)
            # Same hash as bucketing, so task i holds exactly bucket i: one
            # file per bucket instead of one per (task, bucket).
            (df.repartition(n, BUCKET_KEY).write.format("parquet").option("path", target)
             .bucketBy(n, BUCKET_KEY).sortBy(BUCKET_KEY).saveAsTable(table))
            return name, "table:" + table
        df.write.parquet(target)
        return name, "path:" + target

    try:
        with ThreadPoolExecutor(max_workers=max(1, parallel)) as pool:
            out = dict(pool.map(write_one, list(tables)))
        out[BUCKETS_KEY] = str(n)
        if check:
            check(read_warehouse(spark, out))
    except BaseException:
        _remove_load(spark, root, load)
        raise
    _make_current(spark, root, load, n, columns)
    return out


def loads(spark: SparkSession, root: str) -> list[Row]:
    """The manifest's rows (version, load, buckets, columns of each table), the current load first: one row
    for each load there was."""
    at = f"{root.rstrip('/')}/{LOADS}"
    if not path_exists(spark, at):
        return []
    return spark.read.schema(LOADS_SCHEMA).parquet(at).orderBy(F.desc("version"), "load").collect()


def _make_current(spark: SparkSession, root: str, load: str, buckets: int, columns: dict[str, str]) -> None:
    before = loads(spark, root)
    version = before[0]["version"] + 1 if before else 0
    row = spark.createDataFrame([(version, load, buckets, columns)], LOADS_SCHEMA)
    row.coalesce(1).write.mode("append").parquet(f"{root}/{LOADS}")  # from here on the load is current
    for old in before[:1]:
        _drop_names(spark, root, old["load"])
    for old in before[1:2]:  # those before are gone already
        _remove_load(spark, root, old["load"])


def _drop_names(spark: SparkSession, root: str, load: str) -> None:
    for name in CRASH_GRAIN:
        spark.sql(f"DROP TABLE IF EXISTS {table_name(root, name, load)}")


def _remove_load(spark: SparkSession, root: str, load: str) -> None:
    _drop_names(spark, root, load)
    delete_path(spark, f"{root}/{load}")


def table_prefix(root: str) -> str:
    """What the catalog names of the warehouse in folder ``root`` begin with."""
    return f"starloom_{hashlib.sha256(root.rstrip('/').encode()).hexdigest()[:10]}_"


def table_name(root: str, name: str, load: str) -> str:
    """Catalog name of a load's bucketed table of the warehouse in folder ``root``."""
    return f"{table_prefix(root)}{load}_{name}"


class Warehouse(dict):
    """Table name -> DataFrame, with the bucket count of the crash-grain
    tables (``None`` when they are not bucketed)."""

    buckets: int | None = None

    def groups_in_place(self, name: str, key: str) -> bool:
        """Whether grouping ``key`` of table ``name`` moves next to nothing: the table lies bucketed on it,
        or has a row a day, state or area, so each task is left with few keys."""
        return name in FEW_KEYS or (bool(self.buckets) and name in CRASH_GRAIN and key == BUCKET_KEY)


def read_warehouse(spark: SparkSession, locations: Mapping[str, str]) -> Warehouse:
    out = Warehouse()
    bucketed = False
    for name, loc in locations.items():
        if name == BUCKETS_KEY:
            continue
        kind, where = loc.split(":", 1)
        out[name] = spark.table(where) if kind == "table" else spark.read.parquet(where)
        bucketed = bucketed or kind == "table"
    if bucketed and BUCKETS_KEY in locations:
        out.buckets = int(locations[BUCKETS_KEY])
    return out


# The warehouse's tables.
TABLE_NAMES = ("dim_date", "dim_state", "dim_lga", "dim_time", "dim_vehicle", "dim_person", "dim_event",
               "dim_road", "fact_fatalities", "fact_crashes", "fact_number")


def open_warehouse(spark: SparkSession, root: str, names=TABLE_NAMES) -> Warehouse:
    """Open the current load of a warehouse written earlier, from any session. The bucketed tables are
    registered again with their layout, so reports join them where they lie."""
    root = root.rstrip("/")
    done = loads(spark, root)
    if not done:
        raise FileNotFoundError(f"no warehouse was loaded into {root}")
    load, buckets, columns = done[0]["load"], done[0]["buckets"], done[0]["columns"]
    out = Warehouse()
    for name in names:
        at = f"{root}/{load}/{name}"
        if buckets and name in CRASH_GRAIN:
            table = table_name(root, name, load)
            spark.sql(f"CREATE TABLE IF NOT EXISTS {table} ({columns[name]}) USING parquet "
                      f"CLUSTERED BY ({BUCKET_KEY}) SORTED BY ({BUCKET_KEY}) INTO {buckets} BUCKETS LOCATION '{at}'")
            out[name] = spark.table(table)
            out.buckets = buckets
        else:
            out[name] = spark.read.schema(columns[name]).parquet(at)
    return out


def write_csv(df: DataFrame, path: str) -> None:
    """K1: delimited export with a header, replacing what was there. Cells with a
    separator, quote or line break are quoted, quotes inside doubled."""
    df.write.mode("overwrite").options(header=True, escape='"').csv(path)


def write_rules(rules: DataFrame, path: str, fmt: str = "parquet") -> bool:
    """K4: replace the rule output; written only if there is at least one rule
    (as the reference does). Parquet keeps the item sets as arrays; CSV joins
    them as text, since CSV cannot hold arrays."""
    spark = rules.sparkSession
    staged = scratch_path(spark, "rules-staged")
    rules.write.parquet(staged)  # computed once: what follows reads the written rules
    # the order within the result is that of the given rows
    order = [F.desc(c) for c in ("lift", "confidence") if c in rules.columns]
    rules = spark.read.schema(rules.schema).parquet(staged)
    if rules.isEmpty():
        return False
    rules = rules.orderBy(*order, *[c for c in ("antecedents", "consequents") if c in rules.columns])
    if fmt == "csv":
        flat = rules.select(*[F.array_join(F.array_sort(c), ", ").alias(c) if c in ("antecedents", "consequents")
                              else F.col(c) for c in rules.columns])
        write_csv(flat, path)
    else:
        rules.write.mode("overwrite").format(fmt).save(path)
    return True
