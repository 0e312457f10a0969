"""Source sheets derived from the driver tables.

The reference's workbooks are not available, so the warehouse is fed with
record sets that Spark derives from the TPC-H-like driver tables. Each sheet
carries the labels the build reads and an order column ``_row``:

* fatality sheet: one row per ``lineitem`` (the fatality grain),
  ``Crash ID = l_orderkey``; person attributes from the line and its part;
* crash sheet: one row per ``orders`` row, with place from customer, nation
  and region, and crash attributes from the order and its lines;
* daily counts: lines per ship day, orders per order day;
* dwellings: customers per nation, keyed by nation name.

Overlaps are deliberate so that every conform step has work to do:
``Year``/``Month``/``National Road Type`` are on both sheets with different
values (the crash copy wins); ``Day\\nweek`` vs ``Dayweek`` collide only after
header cleaning and differ (renamed ``Dayweek_dup``); ``Christmas\\nPeriod``
collides after cleaning and is identical (dropped); ``Time of day`` differs from
``Time of Day`` only in case (dropped).
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.functions.scalar import weekday_name
from starloom.operators import conform as cf
from starloom.operators import quality
from starloom.operators.keys import dense_ids
from starloom.session import once
from starloom.sources.tables import table_path

ROW = "_row"

# Fixed values used to label the derived sheets.
GENDER_BY_LINESTATUS = {"F": "Female", "O": "Male"}
ROAD_USER_BY_RETURNFLAG = {"A": "Pedestrian", "N": "Driver", "R": "Motorcycle rider"}
UNKNOWN_PRIORITY = "4-NOT SPECIFIED"
UNDETERMINED_TYPE = "STANDARD"
PENDING_STATUS = "P"
LINEITEM_ORDER = ("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice",
                  "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate")


def _yes_no(cond: Column) -> Column:
    return F.when(cond, F.lit("Yes")).otherwise(F.lit("No"))


def christmas(d: Column) -> Column:
    """23 December to 3 January."""
    return _yes_no(((F.month(d) == 12) & (F.dayofmonth(d) >= 23)) | ((F.month(d) == 1) & (F.dayofmonth(d) <= 3)))


def easter(d: Column) -> Column:
    return _yes_no(F.month(d) == 4)


def age_group(age: Column) -> Column:
    return (F.when(age <= 16, "0_to_16").when(age <= 25, "17_to_25")
            .when(age <= 39, "26_to_39").when(age <= 64, "40_to_64").otherwise("65_or_older"))


def _lookup(col: Column, mapping: dict[str, str]) -> Column:
    expr = None
    for k, v in mapping.items():
        expr = F.when(col == k, v) if expr is None else expr.when(col == k, v)
    return expr


class Tables:
    """Each driver table read once per build (one listing and footer read);
    every use selects its own columns, so scans stay pruned."""

    def __init__(self, spark: SparkSession, base: str):
        self.spark, self.base, self._dfs = spark, base, {}

    def __call__(self, name: str, columns=None) -> DataFrame:
        if name not in self._dfs:
            self._dfs[name] = self.spark.read.parquet(table_path(self.base, name))
        df = self._dfs[name]
        return df.select(*columns) if columns else df


#: Tables that lines and orders are joined to, with the key.
JOINED_KEYS = {"part": "p_partkey", "orders": "o_orderkey", "customer": "c_custkey", "nation": "n_nationkey",
               "region": "r_regionkey"}


@dataclass
class Sheets:
    numbered: Callable[[], DataFrame]  # the fatality sheet in its order; numbers the lines
    unordered: DataFrame  # the fatality sheet without its order column
    crash: DataFrame
    fatality_counts: DataFrame
    crash_counts: DataFrame
    dwellings: DataFrame
    hot: dict  # crash keys too large for one task of a join, with their parts
    tables: Tables

    def row_for_row(self, conformed: DataFrame) -> bool:
        """Whether the conformed frame has each line once, so that ``_row`` numbers its rows densely. No line
        comes twice if no key that a sheet is joined on repeats, and then none is lost if there are as many rows."""
        found = quality.check_primary_keys({name: self.tables(name, (key,)) for name, key in JOINED_KEYS.items()}, JOINED_KEYS)
        return found.isEmpty() and conformed.count() == self.tables("lineitem").count()

    @property
    def fatality(self) -> DataFrame:
        return self.numbered()


#: The line columns that the fatality sheet is made of; the order takes all.
LINE_COLUMNS = ("l_orderkey", "l_partkey", "l_linenumber", "l_returnflag", "l_linestatus", "l_shipdate")


def numbered_lines(t: Tables) -> DataFrame:
    """The lines with ``_row``, their dense number in the order of all line columns. Joins, sorts and
    aggregates downstream then carry one long instead of the eleven columns. Identical lines are
    told apart by their place in the files."""
    return dense_ids(t("lineitem", LINEITEM_ORDER), LINEITEM_ORDER, ROW, break_ties=True, columns=LINE_COLUMNS)


def placed_lines(t: Tables) -> DataFrame:
    """The lines with a hash of their place in the files, by which a hot order is split."""
    return t("lineitem").select(*LINE_COLUMNS, F.xxhash64("_metadata.file_path", "_metadata.row_index").alias("__place"))


def fatality_sheet(t: Tables, lines: DataFrame, hot: dict) -> DataFrame:
    """The sheet over :func:`numbered_lines`, in their order, or over :func:`placed_lines`."""
    part = t("part", ("p_partkey", "p_type", "p_size"))
    orders = t("orders", ("o_orderkey", "o_orderdate"))
    # A hot order is split before the first join on its key (see conform.salted_join).
    spread = F.col(ROW if ROW in lines.columns else "__place")
    j = cf.salted_join(lines.join(part, lines.l_partkey == part.p_partkey), orders, "l_orderkey", "o_orderkey", "inner",
                       spread, hot)
    ship = F.col("l_shipdate")
    return j.select(
        F.col("l_orderkey").alias("Crash ID"),
        F.year(ship).alias("Year"),
        F.month(ship).alias("Month"),
        weekday_name(ship).alias("Day\nweek"),
        _lookup(F.col("l_linestatus"), GENDER_BY_LINESTATUS).alias("Gender"),
        F.col("p_size").alias("Age"),
        age_group(F.col("p_size")).alias("Age Group"),
        _lookup(F.col("l_returnflag"), ROAD_USER_BY_RETURNFLAG).alias("Road User"),
        F.when(F.col("l_linenumber") % 2 == 1, "Day").otherwise("Night").alias("Time of day"),
        F.col("p_type").alias("National Road Type"),
        christmas(F.col("o_orderdate")).alias("Christmas \nPeriod"),
        *[F.col(c) for c in lines.columns if c == ROW],
    )


def crash_sheet(t: Tables) -> DataFrame:
    orders = t("orders", ("o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate", "o_orderpriority"))
    cust = t("customer", ("c_custkey", "c_nationkey", "c_mktsegment"))
    nation = t("nation", ("n_nationkey", "n_name", "n_regionkey"))
    region = t("region", ("r_regionkey", "r_name"))
    li = t("lineitem", ("l_orderkey", "l_partkey", "l_quantity"))
    part = t("part", ("p_partkey", "p_type"))
    # Per-order line facts; partial aggregation runs before the shuffle.
    lines = (li.join(part, li.l_partkey == part.p_partkey).groupBy("l_orderkey").agg(
        F.max("l_quantity").alias("max_q"), F.max("p_type").alias("max_type"),
        F.max((F.col("p_type") == "PROMO").cast("int")).alias("has_promo"),
        F.max((F.col("p_type") == "LARGE").cast("int")).alias("has_large"),
        F.max((F.col("p_type") == "ECONOMY").cast("int")).alias("has_economy")))
    j = (orders.join(cust, orders.o_custkey == cust.c_custkey)
         .join(nation, F.col("c_nationkey") == nation.n_nationkey)
         .join(region, F.col("n_regionkey") == region.r_regionkey)
         .join(lines, orders.o_orderkey == lines.l_orderkey, "left"))
    od = F.col("o_orderdate")
    pending = F.col("o_orderstatus") == PENDING_STATUS
    speed = (F.when(F.col("max_q").isNull(), F.lit(None).cast("string"))
             .when(pending, F.lit("-9"))
             .when(F.col("max_q") < 5, F.lit("<40"))
             .otherwise((F.col("max_q") * 4).cast("bigint").cast("string")))
    return j.select(
        F.col("o_orderkey").alias("Crash ID"),
        F.lower(F.col("r_name")).alias("State"),
        F.year(od).alias("Year"),
        F.month(od).alias("Month"),
        weekday_name(od).alias("Dayweek"),
        F.concat_ws(":", F.lpad((F.col("o_orderkey") % 24).cast("string"), 2, "0"),
                    F.lpad((F.col("o_custkey") % 60).cast("string"), 2, "0")).alias("Time"),
        F.when(F.col("o_orderpriority") == UNKNOWN_PRIORITY, "Unknown")
        .otherwise(F.col("o_orderpriority")).alias("Time of Day"),
        F.col("n_name").alias("National LGA Name 2021"),
        F.col("c_mktsegment").alias("National Remoteness Areas"),
        F.when(pending, "-9").otherwise(_yes_no(F.col("has_promo") == 1)).alias("Bus Involvement"),
        _yes_no(F.col("has_large") == 1).alias("Heavy Rigid \nTruck Involvement"),
        _yes_no(F.col("has_economy") == 1).alias("Articulated Truck Involvement"),
        speed.alias("Speed Limit"),
        F.when(F.col("max_type") == UNDETERMINED_TYPE, "Undetermined")
        .otherwise(F.col("max_type")).alias("National Road Type"),
        christmas(od).alias("Christmas Period"),
        easter(od).alias("Easter Period"),
    )


def fatality_count_sheet(t: Tables) -> DataFrame:
    li = t("lineitem", ("l_shipdate",))
    d = F.to_date("l_shipdate")
    return (li.groupBy(d.alias("Date")).agg(F.count(F.lit(1)).alias("Number Fatalities"))
            .select("Date", weekday_name("Date").alias("Dayweek"), "Number Fatalities",
                    F.col("Date").alias(ROW)))


def crash_count_sheet(t: Tables) -> DataFrame:
    orders = t("orders", ("o_orderdate",))
    d = F.to_date("o_orderdate")
    return (orders.groupBy(d.alias("Date")).agg(F.count(F.lit(1)).alias("Number of fatal crashes"))
            .select("Date", weekday_name("Date").alias("Dayweek"), "Number of fatal crashes"))


def dwellings_sheet(t: Tables) -> DataFrame:
    cust = t("customer", ("c_custkey", "c_nationkey"))
    nation = t("nation", ("n_nationkey", "n_name"))
    per = cust.groupBy("c_nationkey").agg(F.count("c_custkey").alias("dwelling_count"))
    return (per.join(nation, per.c_nationkey == nation.n_nationkey)
            .select(F.col("n_name").alias("lga_name"), F.col("dwelling_count").cast("bigint"),
                    F.col("n_name").alias(ROW)))


def sheets(spark: SparkSession, base: str) -> Sheets:
    t = Tables(spark, base)
    # every line has its part and order, so the lines' keys are the fatality sheet's
    lines = t("lineitem", ("l_orderkey",))
    hot = cf.heavy_keys(lines, "l_orderkey", cf.session_tasks(lines))
    return Sheets(once(lambda: fatality_sheet(t, numbered_lines(t), hot)),
                  fatality_sheet(t, placed_lines(t), hot), crash_sheet(t), fatality_count_sheet(t), crash_count_sheet(t),
                  dwellings_sheet(t), hot, t)
