"""Registered queries: one callable per inventory entry, each taking
``(spark, sf_dir)`` and returning a DataFrame over the driver tables.

The warehouse is built the way a warehouse is used: the ETL runs once per
session and data directory and writes its eleven tables to the shared
checkpoint folder (this also cuts the long lineage); the reports then read
those tables. The ETL entries themselves (``b*``, ``d*``, ``t*``) return the
lazy build plans, so they measure the build.
"""

from __future__ import annotations

import threading
from collections.abc import Callable
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.operators import conform as cf
from starloom.operators import keys, mining, quality, rules
from starloom.plans import analog, etl, reports, rule_job, sql_text
from starloom.plans import warehouse as wh
from starloom.plans.oracle import ONE_HOT_ITEMS
from starloom.session import scratch_path
from starloom.sinks.tables import (Warehouse, open_warehouse, read_warehouse, table_prefix, write_csv, write_rules,
                                   write_warehouse)
from starloom.sources.delimited import read_sheet_csv, read_trimmed_csv
from starloom.sources.tables import table_path

# Analog parameters: the driver data spans 1995-2001, so 1998 stands in for
# the reference's 2023 (Q2) and 2010 (Q5).
Q2_YEAR = 1998
Q5_AFTER = 1998
MIN_SUPPORT = 0.05
MAX_LEN = 3
ITEM_SEP = " | "


class Build:
    """The ETL over the derived sheets, each part made on first use: a table that needs
    only the daily counts writes no joined frame."""

    def __init__(self, spark: SparkSession, base: str):
        self.sheets = analog.sheets(spark, base)
        # the derived sheets' keys come from inner joins: none is null
        self._conformed = wh.once(lambda: wh.conform_records(self.sheets.fatality, self.sheets.crash, null_safe=False,
                                                             hot=self.sheets.hot))
        self._counts = wh.once(lambda: wh.conform_counts(self.sheets.fatality_counts, self.sheets.crash_counts))
        self.builders = wh.build_warehouse(lambda: self.conformed.frame, lambda: self.counts, self.sheets.dwellings,
                                           fatality_ids_from_row=lambda: self.sheets.row_for_row(self.conformed.frame), deferred=True)

    @property
    def conformed(self) -> wh.Conformed:
        return self._conformed()

    @property
    def counts(self) -> DataFrame:
        return self._counts()

    def table(self, name: str) -> DataFrame:
        return self.builders[name]()


_lock = threading.Lock()
_builds: dict[tuple, Build] = {}
_stored: dict[tuple, Warehouse] = {}


def _key(spark: SparkSession, base: str) -> tuple:
    """Session, folder and the state of its files: data rewritten under the same path
    is built anew."""
    base = base.rstrip("/")
    files = []
    for name in ("lineitem", "orders", "part", "customer", "nation", "region"):
        path = spark._jvm.org.apache.hadoop.fs.Path(table_path(base, name))
        status = path.getFileSystem(spark._jsc.hadoopConfiguration()).getFileStatus(path)
        files.append((status.getModificationTime(), status.getLen()))
    return (spark.sparkContext.applicationId, base, tuple(files))


def run_etl(spark: SparkSession, base: str) -> dict[str, str]:
    """The whole ETL end to end: derive sheets, conform, build, write. The
    tables are handed to the writer as builders, so tables without numbering
    are written while the numbering jobs run."""
    return write_warehouse(spark, Build(spark, base).builders)


def build(spark: SparkSession, base: str, key: tuple | None = None) -> Build:
    """A :class:`Build`, once per session and state of the data folder (``key``, where it
    is at hand: it takes a look at every file)."""
    k = key or _key(spark, base)
    with _lock:
        if k not in _builds:
            _builds[k] = Build(spark, base)
        return _builds[k]


def stored_warehouse(spark: SparkSession, base: str) -> Warehouse:
    """The eleven tables written once to the shared checkpoint folder, read back."""
    k = _key(spark, base)
    b = build(spark, base, k)
    with _lock:
        if k not in _stored:
            _stored[k] = read_warehouse(spark, write_warehouse(spark, b.builders))
        return _stored[k]


def _text(col: str):
    return F.array_join(F.array_sort(F.col(col)), ITEM_SEP).alias(col)


def _rules_text(df: DataFrame) -> DataFrame:
    return df.select(_text("antecedents"), _text("consequents"),
                     *[F.col(c) for c in rules.RULE_COLUMNS[2:]])


def _tx(spark, base):
    return rules.transactions(build(spark, base).conformed.frame)


def _itemsets(spark, base):
    return rules.frequent_itemsets(_tx(spark, base), min_support=MIN_SUPPORT, max_len=MAX_LEN)


def _rules(spark, base):
    # the itemsets are looked up three times: counted and written once, as the job does
    return rules.association_rules(rule_job.stored(_itemsets(spark, base), scratch_path(spark, "itemsets")))


def _no_row(df: DataFrame) -> DataFrame:
    return df.drop(cf.ROW)


# --- query callables -------------------------------------------------------

def b1_conform_records(spark, base):
    """B1 (J1, P2-P4, P7, C1, F9): the conformed fatality x crash frame."""
    return _no_row(build(spark, base).conformed.frame)


def p6_conflict_report(spark, base):
    """Rows whose two copies of an overlapping column differ."""
    return build(spark, base).conformed.conflicts


def b2_conform_counts(spark, base):
    """B2 (J2, P5): daily counts, first copy of shared columns wins."""
    return _no_row(build(spark, base).counts)


def _table(name):
    def run(spark, base):
        return build(spark, base).table(name)
    run.__name__ = name
    run.__doc__ = f"The {name} table as built by the ETL plan."
    return run


def a6_keep_first(spark, base):
    """First fatality record (source order) of every crash."""
    fat = build(spark, base).sheets.fatality.select(
        F.col("Crash ID").alias("crash_id"), F.col("Road User").alias("road_user"), F.col("Age").alias("age"),
        cf.ROW)
    return keys.keep_first(fat, "crash_id").drop(cf.ROW)


def w3_dense_ids(spark, base):
    """Dense 0-based ids over the orders in (order date, order key) order.
    The order key is unique, so no tie-breaking is needed (and none is used:
    the numbering stays deterministic when a lost task is recomputed)."""
    orders = spark.read.parquet(f"{base.rstrip('/')}/orders.parquet").select("o_orderkey", "o_orderdate")
    return keys.dense_ids(orders, ["o_orderdate", "o_orderkey"], "order_seq", break_ties=False).select(
        F.col("order_seq").cast("bigint"), "o_orderkey")


def q1_top_lga(spark, base):
    return reports.q1_top_lga_per_year(stored_warehouse(spark, base))


def q2_state_crashes(spark, base):
    return reports.q2_crashes_by_state(stored_warehouse(spark, base), year=Q2_YEAR)


def q3_weekday_time(spark, base):
    return reports.q3_weekday_time_of_day(stored_warehouse(spark, base))


def a4_cube_having(spark, base):
    """Q3 in its literal CUBE + HAVING form (equal to q3)."""
    return reports.q3_weekday_time_of_day(stored_warehouse(spark, base), use_cube=True)


def q4_holidays(spark, base):
    return reports.q4_holiday_fatalities(stored_warehouse(spark, base))


def q5_vehicle_types(spark, base):
    return reports.q5_vehicle_types_by_year(stored_warehouse(spark, base), after_year=Q5_AFTER)


def u1_union_all(spark, base):
    """Q5 in its literal three-branch UNION ALL + CUBE form."""
    return reports.q5_union_all(stored_warehouse(spark, base), after_year=Q5_AFTER)


def q6_dwelling_rate(spark, base):
    return reports.q6_rate_per_dwellings(stored_warehouse(spark, base))


def _sql(name):
    def run(spark, base):
        return sql_text.run(spark, stored_warehouse(spark, base), name, year=Q2_YEAR, after=Q5_AFTER)
    run.__name__ = f"s5_sql_{name}"
    run.__doc__ = f"S5/U2/U3: report {name} as SQL text over the warehouse views."
    return run


def k5_primary_keys(spark, base):
    """K5: primary-key offenders over all eleven loaded tables."""
    return quality.check_primary_keys(stored_warehouse(spark, base))


def k6_foreign_keys(spark, base):
    """Foreign-key offenders over all eleven loaded tables."""
    return quality.check_foreign_keys(stored_warehouse(spark, base))


def m1_transactions(spark, base):
    """M1 (C13, C14, C20, C21, C22, F5, F6): complete transactions."""
    tx = _tx(spark, base)
    return tx.select(*[F.col(a) for a in rules.ATTRIBUTES])


def m3_frequent_itemsets(spark, base):
    its = _itemsets(spark, base)
    return its.select(_text("items"), "count", "support", "size")


def m4_rules(spark, base):
    return _rules_text(_rules(spark, base))


def m5_road_user_rules(spark, base):
    return _rules_text(rules.road_user_rules(_rules(spark, base)))


def m6_top_rules(spark, base):
    return _rules_text(rules.top_rules(rules.road_user_rules(_rules(spark, base)), 5))


def m7_consequent_items(spark, base):
    return rules.consequent_items(_rules(spark, base))


def m7_sample_itemsets(spark, base):
    return rules.sample_itemsets(_itemsets(spark, base), 10).select(_text("items"), "count", "support", "size")


def s2_trimmed_csv(spark, base):
    """Dwelling counts written as a delimited text over several files, with a preamble,
    blank lines, two lead records and five tail records, and read back by place. Names are
    quoted or not and hold quotes and commas, some counts are blank, some lines have no last comma."""
    dw = build(spark, base).sheets.dwellings
    name, n = F.col("lga_name"), F.col("dwelling_count")
    odd = F.pmod(F.length(name), F.lit(4))
    line = (F.when(odd == 0, F.format_string('"%s",%d,', name, n)).when(odd == 1, F.format_string("%s,%d", name, n))
            .when(odd == 2, F.format_string('"%s, ""of"" old",%d,', name, n)).otherwise(F.format_string("%s,,", name)))
    lines = dw.select(F.lit(1).alias("part"), name.alias("at"), line.alias("value"))
    around = [(0, t) for t in ("Dwellings by area", "", "", "", "", "", "", '"Default Summation",', "", '"Area (EN)",')] \
        + [(2, t) for t in ('"Total",1,', "", '"Data source: derived"', "", '"INFO","cells are exact"', '"c1"', '"c2"')]
    frame = spark.createDataFrame([(p, f"{i:02d}", t) for i, (p, t) in enumerate(around)], "part int, at string, value string")
    path = scratch_path(spark, "dwellings-text")
    # ranges keep the file order; rows of one part spread over several files
    (frame.unionByName(lines).repartitionByRange(6, "part", "at").sortWithinPartitions("part", "at")
     .select("value").write.text(path))
    return read_trimmed_csv(spark, path).drop("_row")


@contextmanager
def split_bytes(spark, size):
    """File splits of this size while records are read."""
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(size))
    try:
        yield
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def s1_sheet_header(spark, base):
    """An exported sheet with four banner lines, labels with a line break or differing in
    case alone, keys that are blank or no number, and cells with line breaks, commas and quotes
    that split borders cut (the files are read in splits of 64 KB, or up to 1 MB as the table grows), read back
    with every record kept."""
    orders = spark.read.parquet(f"{base.rstrip('/')}/orders.parquet").select("o_orderkey", "o_orderpriority", "o_orderstatus")
    key = F.when(F.col("o_orderkey") % 50 == 0, "").when(F.col("o_orderkey") % 51 == 0, "n/a").otherwise(
        F.col("o_orderkey").cast("string"))
    more = F.when(F.col("o_orderkey") % 7 == 0, '\nsecond, ""quoted"" line\n').when(
        F.col("o_orderkey") % 11 == 0, ',""\n\n,x,\n').otherwise("")
    lines = orders.select(F.lit(1).alias("part"), F.col("o_orderkey").alias("at"), F.concat(
        key, F.lit(',"'), "o_orderpriority", more, F.lit('",'), "o_orderstatus", F.lit(","), F.lower("o_orderstatus")).alias("value"))
    top = ("Orders, exported", "one line an order", "", "columns below", '"Crash ID","Priority \nclass",Status,STATUS')
    head = spark.createDataFrame([(0, i, t) for i, t in enumerate("\n".join(top).split("\n"))],
                                 "part int, at bigint, value string")
    path = scratch_path(spark, "sheet-text")
    rows = orders.count()
    files, split = max(5, -(-rows // 1_000_000)), (64 << 10) * min(16, max(1, rows // 200_000))
    (head.unionByName(lines).repartitionByRange(files, "part", "at").sortWithinPartitions("part", "at").select("value").write.text(path))
    with split_bytes(spark, split):
        sheet = etl.read_exported_sheet(spark, path, {"Crash ID": "bigint"}, "Crash ID", dense_order=True)
    return sheet.toDF("crash_id", "priority", "status", "status_again", "row_no")


def s4_reload_processed(spark, base):
    """K1 + S1/S4: the conformed frame exported as CSV with a header (as the
    reference exports it for the rule job) and read back with its schema."""
    frame = _no_row(build(spark, base).conformed.frame)
    path = scratch_path(spark, "processed-csv")
    write_csv(frame, path)
    return read_sheet_csv(spark, path, frame.schema).drop("_row")


def k4_rules_output(spark, base):
    """K4: the road-user rules written (only if any) and read back."""
    path = scratch_path(spark, "rules")
    write_rules(rules.road_user_rules(_rules(spark, base)), path)
    return _rules_text(spark.read.parquet(path))


def m2_one_hot(spark, base):
    """M2: one boolean column per item of the derived sheets' domain, one row per
    transaction."""
    return rules.one_hot(_tx(spark, base), ONE_HOT_ITEMS)


def m3_border_support(spark, base):
    """M3 at the border: a support that an itemset has exactly, as the double count / total
    (the fifth most frequent pair's), keeps that itemset."""
    pairs = _itemsets(spark, base).where("size = 2").orderBy(F.desc("support"), F.array_join("items", ITEM_SEP)).limit(5)
    support = pairs.agg(F.min("support")).first()[0]
    found = rules.frequent_itemsets(_tx(spark, base), min_support=support, max_len=MAX_LEN)
    return found.select(_text("items"), "count", "support", "size")


#: Least support of the customers' itemsets.
CUSTOMER_SUPPORT = 0.5


def customer_items(spark, base):
    """One transaction a customer with an order: what its lines and orders have, some 50 items."""
    at = base.rstrip("/")
    lines = (spark.read.parquet(f"{at}/lineitem.parquet").select("l_orderkey", "l_partkey", "l_returnflag")
             .join(spark.read.parquet(f"{at}/part.parquet").select("p_partkey", "p_size", "p_type"), F.col("l_partkey") == F.col("p_partkey"))
             .join(spark.read.parquet(f"{at}/orders.parquet").select("o_orderkey", "o_custkey", "o_orderdate", "o_orderpriority"),
                   F.col("l_orderkey") == F.col("o_orderkey")))
    items = F.array(*[F.concat(F.lit(f"{name}="), c.cast("string")) for name, c in (
        ("Flag", F.col("l_returnflag")), ("Month", F.month("o_orderdate")), ("Priority", F.col("o_orderpriority")),
        ("Size", F.col("p_size")), ("Type", F.col("p_type")))])
    single = lines.select("o_custkey", F.explode(items).alias("item")).where("item is not null").distinct()
    return single.groupBy("o_custkey").agg(F.collect_list("item").alias("items"))  # the domain holds under 100 items


def m3_level_wise(spark, base):
    """M3 on transactions of some 50 items each, level by level over item bitmaps."""
    found = mining.level_wise_itemsets(customer_items(spark, base), min_support=CUSTOMER_SUPPORT, max_len=MAX_LEN)
    return found.select(_text("items"), "count", "total", "support", "size")


def w1_rank_all(spark, base):
    """Every (year, LGA) with its rank in the year."""
    return reports.rank_lga_per_year(stored_warehouse(spark, base))


def p3_duplicate_columns(spark, base):
    """For each label that repeats after header cleaning, whether the
    later copy was dropped (equal values) or renamed ``_dup`` - decided by
    the data in the conform step."""
    b = build(spark, base)
    merged_labels = cf.clean_labels(cf.merge(b.sheets.unordered, b.sheets.crash, "Crash ID")).labels
    rows = [(merged_labels[later], "renamed" if differs else "dropped")
            for (_, later), differs in sorted(b.conformed.decisions.items())]
    return spark.createDataFrame(rows, "label string, action string")


def j4_no_dwellings(spark, base):
    """The LGA dimension built without the optional dwellings input: the
    count column is present and null."""
    return wh.dim_lga(build(spark, base).conformed.frame, None)


def _counted(tables) -> DataFrame:
    parts = [tables[t].agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(t).alias("table_name"), "n_rows")
             for t in wh.TABLES]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def k2_loaded_counts(spark, base):
    """Rows in each of the eleven loaded tables."""
    return _counted(stored_warehouse(spark, base))


def _loaded_in(spark, root: str) -> DataFrame:
    """Rows of each table of a warehouse opened from its folder, and its tables in the catalog."""
    loaded = open_warehouse(spark, root)
    kept = sum(t.name.startswith(table_prefix(root)) for t in spark.catalog.listTables())
    return _counted(loaded).withColumn("catalog_tables", F.lit(kept).cast("bigint"))


def k3_reload(spark, base):
    """K3: the warehouse loaded twice into one folder and opened from there: rows of each
    table, and the tables that the loads left in the catalog."""
    root = scratch_path(spark, "reload")
    for _ in range(2):
        write_warehouse(spark, build(spark, base).builders, path=root)
    return _loaded_in(spark, root)


def k3_failed_reload(spark, base):
    """K3/K5: a load, then one whose crashes are listed twice, which the key check refuses: the
    first still answers. With the offending keys that each check found."""
    root = scratch_path(spark, "failed-reload")
    builders = build(spark, base).builders
    offences = []

    def check(tables):
        report = quality.check_primary_keys(tables)
        offences.append(report.count())
        quality.enforce(report)

    write_warehouse(spark, builders, path=root, check=check)

    def doubled():
        crashes = builders["fact_crashes"]()
        return crashes.unionByName(crashes)

    try:
        write_warehouse(spark, {**builders, "fact_crashes": doubled}, path=root, check=check)
        refused = False
    except quality.IntegrityError:
        refused = True
    first, second = (F.lit(n).cast("bigint") for n in offences)
    return _loaded_in(spark, root).withColumns({"refused": F.lit(refused), "offences_first": first, "offences_second": second})


def d2_mapped_states(spark, base):
    """The state dimension of the nations' first letters mapped to state codes, so
    mapped and unmapped codes both occur."""
    nation = spark.read.parquet(table_path(base, "nation")).select("n_nationkey", "n_name")
    codes = F.array(*[F.lit(c) for c in ("NSW", "VIC", "QLD", "SA", "WA", "TAS", "NT", "ACT", "OT")])
    coded = nation.select(F.element_at(codes, (F.col("n_nationkey") % 9 + 1).cast("int")).alias(wh.STATE))
    return wh.dim_state(coded)


def k5_seeded_keys(spark, base):
    """K5 with offenders: lines checked as if their order were a primary key, and orders
    whose key is null for every hundredth order."""
    lines = spark.read.parquet(table_path(base, "lineitem")).select("l_orderkey")
    orders = spark.read.parquet(table_path(base, "orders")).select(
        F.when(F.col("o_orderkey") % 100 != 0, F.col("o_orderkey")).alias("o_orderkey"))
    return quality.check_primary_keys({"lines": lines, "orders": orders}, {"lines": "l_orderkey", "orders": "o_orderkey"})


def k6_seeded_keys(spark, base):
    """K6/J10 with offenders: lines and, as a second child of the same parent, orders, checked
    against orders without every ninety-seventh and without the null ones that every hundredth has."""
    lines = spark.read.parquet(table_path(base, "lineitem")).select("l_orderkey")
    orders = spark.read.parquet(table_path(base, "orders")).select("o_orderkey")
    known = orders.select(F.when(F.col("o_orderkey") % 100 != 0, F.col("o_orderkey")).alias("o_orderkey")).where(
        "o_orderkey IS NULL OR o_orderkey % 97 <> 0")
    fks = [quality.ForeignKey("lines", "l_orderkey", "known", "o_orderkey"),
           quality.ForeignKey("orders", "o_orderkey", "known", "o_orderkey")]
    return quality.check_foreign_keys({"lines": lines, "orders": orders, "known": known}, fks)


def _exported(spark, base) -> etl.SheetPaths:
    """The derived sheets as exported CSV folders, compressed; each file is read by one task (the sheet of
    :func:`s1_sheet_header` and the processed export are split)."""
    sheets = build(spark, base).sheets
    out = scratch_path(spark, "exported")

    def export(df: DataFrame, name: str, by: str) -> str:
        # The fatality sheet's place is its order; every file has its own header line.
        labels = [c for c in df.columns if c != cf.ROW]
        flat = df.select(*[F.col(f"`{c}`").alias(c.replace("\n", "")) for c in labels])
        flat.write.option("header", True).csv(f"{out}/{name}", compression="gzip")
        return f"{out}/{name}"

    fatality = sheets.unordered.drop("Time of day")
    return etl.SheetPaths(export(fatality, "fatalities", "Crash ID"), export(sheets.crash, "crashes", "Crash ID"),
                          export(sheets.fatality_counts, "fatality_counts", "Date"),
                          export(sheets.crash_counts, "crash_counts", "Date"))


def _etl_job(spark, base) -> etl.EtlResult:
    return etl.run(spark, _exported(spark, base), scratch_path(spark, "etl-out"), enforce_keys=False)


def etl_job(spark, base):
    """The user's ETL job on exported sheets: rows in each loaded table."""
    return _counted(read_warehouse(spark, _etl_job(spark, base).locations))


def r1_rule_job(spark, base):
    """The user's rule job on the processed export of the ETL job."""
    done = _etl_job(spark, base)
    out = scratch_path(spark, "rule-job")
    rule_job.run(rule_job.read_processed(spark, done.processed["records"]), out)
    return _rules_text(spark.read.parquet(out))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    out: dict[str, Callable] = {
        "b1_conform_records": b1_conform_records,
        "p6_conflict_report": p6_conflict_report,
        "b2_conform_counts": b2_conform_counts,
    }
    for i, name in enumerate(wh.TABLES):
        prefix = f"d{i + 1}" if name.startswith("dim_") else f"t{i - 7}"
        out[f"{prefix}_{name}"] = _table(name)
    out.update({
        "a6_keep_first": a6_keep_first,
        "w3_dense_ids": w3_dense_ids,
        "k2_loaded_counts": k2_loaded_counts,
        "k3_reload": k3_reload,
        "k3_failed_reload": k3_failed_reload,
        "k5_seeded_keys": k5_seeded_keys,
        "k6_seeded_keys": k6_seeded_keys,
        "d2_mapped_states": d2_mapped_states,
        "etl_job": etl_job,
        "r1_rule_job": r1_rule_job,
        "k5_primary_keys": k5_primary_keys,
        "k6_foreign_keys": k6_foreign_keys,
        "w1_rank_all": w1_rank_all,
        "p3_duplicate_columns": p3_duplicate_columns,
        "j4_no_dwellings": j4_no_dwellings,
        "q1_top_lga": q1_top_lga,
        "q2_state_crashes": q2_state_crashes,
        "q3_weekday_time": q3_weekday_time,
        "a4_cube_having": a4_cube_having,
        "q4_holidays": q4_holidays,
        "q5_vehicle_types": q5_vehicle_types,
        "u1_union_all": u1_union_all,
        "q6_dwelling_rate": q6_dwelling_rate,
        **{f"s5_sql_{n}": _sql(n) for n in sql_text.STATEMENTS},
        "s1_sheet_header": s1_sheet_header,
        "s2_trimmed_csv": s2_trimmed_csv,
        "s4_reload_processed": s4_reload_processed,
        "k4_rules_output": k4_rules_output,
        "m1_transactions": m1_transactions,
        "m2_one_hot": m2_one_hot,
        "m3_frequent_itemsets": m3_frequent_itemsets,
        "m3_border_support": m3_border_support,
        "m3_level_wise": m3_level_wise,
        "m4_rules": m4_rules,
        "m5_road_user_rules": m5_road_user_rules,
        "m6_top_rules": m6_top_rules,
        "m7_consequent_items": m7_consequent_items,
        "m7_sample_itemsets": m7_sample_itemsets,
    })
    return out
