"""The six analytical reports (inventory Q1-Q6) over the warehouse tables.

Each report is a DataFrame plan. Two plan choices apply throughout:

* **Fatalities are counted per crash before the crash-grain joins.** The
  fatality fact is the largest table; ``COUNT`` over a join equals the sum of
  per-crash counts over the join (join multiplicities multiply both sides
  alike), so the fatality fact is reduced map-side to crash grain first and
  the crash-grain tables are joined on ``crash_id`` with one shared
  partitioning.
* **Dimension lookups are plain joins.** Spark broadcasts a side only when
  its size estimate is under ``spark.sql.autoBroadcastJoinThreshold``, and
  AQE re-plans from runtime sizes; nothing is force-broadcast on a guess.

``tables`` is a mapping of table name to DataFrame (see
:func:`starloom.plans.warehouse.build_warehouse` or :func:`read_warehouse`).
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

Tables = Mapping[str, DataFrame]


def _fatalities_per_crash(tables: Tables, count_col: str | None = "fatality_id") -> DataFrame:
    """Fatality rows per crash: ``COUNT(fatality_id)`` (non-null) or, with
    ``count_col=None``, ``COUNT(*)``.

    Partial aggregation runs before the shuffle, so a crash holding a third
    of all fatalities is one row per task. When the crash-grain tables are
    bucketed with a count other than the session's shuffle partition count,
    the (narrow) per-crash counts are hash-partitioned into the bucket count,
    so the crash-grain tables are joined where they lie instead of being
    shuffled themselves."""
    ff = tables["fact_fatalities"]
    counter = F.count(F.col(count_col)) if count_col else F.count(F.lit(1))
    per_crash = ff.groupBy("crash_id").agg(counter.alias("n"))
    buckets = getattr(tables, "buckets", None)
    if buckets and buckets != int(per_crash.sparkSession.conf.get("spark.sql.shuffle.partitions")):
        per_crash = per_crash.repartition(buckets, "crash_id")
    return per_crash


def rank_lga_per_year(tables: Tables, exclude: str = "Unknown") -> DataFrame:
    """Fatalities per (year, LGA) with ``RANK()`` within the year, most
    first; ties share a rank."""
    per_crash = _fatalities_per_crash(tables)
    fc = tables["fact_crashes"].select("crash_id", "date_id", "lga_id")
    dd = tables["dim_date"].select("date_id", "year")
    lga = tables["dim_lga"].where(F.col("lga_name") != exclude).select("lga_id", "lga_name")
    grouped = (per_crash.join(fc, "crash_id").join(dd, "date_id").join(lga, "lga_id")
               .groupBy("year", "lga_name").agg(F.sum("n").cast("bigint").alias("total_fatalities")))
    w = Window.partitionBy("year").orderBy(F.desc("total_fatalities"))
    return grouped.select(F.col("year").cast("int").alias("year"), "lga_name", "total_fatalities",
                          F.rank().over(w).alias("rank_num"))


def q1_top_lga_per_year(tables: Tables, exclude: str = "Unknown") -> DataFrame:
    """Q1: LGA(s) with the most fatalities in each year; ties all kept
    (``RANK() ... = 1``, planned as a per-year group limit)."""
    return (rank_lga_per_year(tables, exclude).where(F.col("rank_num") == 1)
            .select("year", "lga_name", "total_fatalities").orderBy("year"))


def q2_crashes_by_state(tables: Tables, year: int = 2023) -> DataFrame:
    """Q2: crashes per state in one year, most first (all states listed)."""
    fc = tables["fact_crashes"].select("crash_id", "date_id", "state_id")
    dd = tables["dim_date"].where(F.col("year") == year).select("date_id")
    st = tables["dim_state"].select("state_id", "state_name")
    return (fc.join(dd, "date_id").join(st, "state_id")
            .groupBy("state_name").agg(F.count("crash_id").alias("total_crashes"))
            .orderBy(F.desc("total_crashes")))


def q3_weekday_time_of_day(tables: Tables, use_cube: bool = False, exclude: str = "Unknown") -> DataFrame:
    """Q3: fatalities by weekday of the crash *date* (the first of the crash
    month, as the build stores it) and time of day.

    The reference writes ``CUBE`` and then discards every subtotal with
    ``HAVING ... IS NOT NULL``; that equals a plain ``GROUP BY`` on non-null
    keys, which avoids expanding every row four times. ``use_cube=True``
    runs the literal form (tested equal).
    """
    per_crash = _fatalities_per_crash(tables)
    fc = tables["fact_crashes"].select("crash_id", "date_id")
    dd = tables["dim_date"].select("date_id", "day_of_week")
    dt = tables["dim_time"].select("crash_id", "time_of_day")
    joined = per_crash.join(fc, "crash_id").join(dt, "crash_id").join(dd, "date_id")
    keep = F.col("day_of_week").isNotNull() & F.col("time_of_day").isNotNull() & (F.col("time_of_day") != exclude)
    if use_cube:
        cubed = (joined.cube("day_of_week", "time_of_day")
                 .agg(F.sum("n").alias("total_fatalities"), F.grouping_id().alias("gid")))
        out = cubed.where(keep).drop("gid")
    else:
        out = joined.where(keep).groupBy("day_of_week", "time_of_day").agg(F.sum("n").alias("total_fatalities"))
    return (out.select("day_of_week", "time_of_day", F.col("total_fatalities").cast("bigint"))
            .orderBy(F.desc("total_fatalities")))


def q4_holiday_fatalities(tables: Tables) -> DataFrame:
    """Q4: fatalities in crashes flagged for Christmas / Easter (one row; null
    sums on empty input, as SQL gives)."""
    per_crash = _fatalities_per_crash(tables, count_col=None)
    ev = tables["dim_event"]
    j = per_crash.join(ev, "crash_id")
    return j.agg(
        F.sum(F.when(F.col("Christmas Period") == "Yes", F.col("n")).otherwise(0)).cast("bigint")
        .alias("christmas_fatalities"),
        F.sum(F.when(F.col("Easter Period") == "Yes", F.col("n")).otherwise(0)).cast("bigint")
        .alias("easter_fatalities"))


# Involvement flag column -> vehicle type label.
VEHICLE_TYPES = {
    "Bus Involvement": "Bus",
    "Heavy Rigid Truck Involvement": "Heavy Rigid Truck",
    "Articulated Truck Involvement": "Articulated Truck",
}


def q5_vehicle_types_by_year(tables: Tables, after_year: int = 2010) -> DataFrame:
    """Q5: fatality rows of crashes involving each vehicle type, per year after
    ``after_year`` (the reference counts fatalities, not crashes: each branch
    joins the fatality fact; a crash with two vehicle types counts in both).

    The three ``UNION ALL`` branches scan the same joins; here one scan is
    unpivoted over the three flags, then filtered to ``Yes``.
    """
    per_crash = _fatalities_per_crash(tables, count_col=None)
    dv = tables["dim_vehicle"]
    fc = tables["fact_crashes"].select("crash_id", "date_id")
    dd = tables["dim_date"].where(F.col("year") > after_year).select("date_id", "year")
    joined = dv.join(per_crash, "crash_id").join(fc, "crash_id").join(dd, "date_id")
    flags = list(VEHICLE_TYPES)
    stacked = joined.select("year", "n", F.explode(F.array(*[
        F.struct(F.lit(VEHICLE_TYPES[c]).alias("vehicle_type"), F.col(c).alias("flag")) for c in flags
    ])).alias("v"))
    out = (stacked.where(F.col("v.flag") == "Yes")
           .groupBy("year", F.col("v.vehicle_type").alias("vehicle_type"))
           .agg(F.sum("n").cast("bigint").alias("total_fatal_crashes")))
    return (out.where(F.col("year").isNotNull() & F.col("vehicle_type").isNotNull())
            .select(F.col("year").cast("int").alias("year"), "vehicle_type", "total_fatal_crashes")
            .orderBy("year", F.desc("total_fatal_crashes")))


def q5_union_all(tables: Tables, after_year: int = 2010) -> DataFrame:
    """Q5 in the reference's literal shape: three branches, ``UNION ALL``,
    ``CUBE`` with subtotals discarded. Kept as the tested equivalent of
    :func:`q5_vehicle_types_by_year`."""
    ff = tables["fact_fatalities"].select("crash_id")
    fc = tables["fact_crashes"].select("crash_id", "date_id")
    dd = tables["dim_date"].select("date_id", "year")
    branches = []
    for flag, label in VEHICLE_TYPES.items():
        dv = tables["dim_vehicle"].select("crash_id", F.col(flag).alias("flag"))
        b = (dv.join(ff, "crash_id").join(fc, "crash_id").join(dd, "date_id")
             .where((F.col("flag") == "Yes") & (F.col("year") > after_year))
             .select("year", F.lit(label).alias("vehicle_type"), "crash_id"))
        branches.append(b)
    combined = branches[0].unionByName(branches[1]).unionByName(branches[2])
    cubed = combined.cube("year", "vehicle_type").agg(F.count(F.lit(1)).alias("total_fatal_crashes"))
    return (cubed.where(F.col("year").isNotNull() & F.col("vehicle_type").isNotNull())
            .select(F.col("year").cast("int").alias("year"), "vehicle_type",
                    F.col("total_fatal_crashes").cast("bigint"))
            .orderBy("year", F.desc("total_fatal_crashes")))


def q6_rate_per_dwellings(tables: Tables, per: int = 1000, zero: str = "raise") -> DataFrame:
    """Q6: fatalities per ``per`` dwellings by LGA, rounded half-up to 2
    decimals, highest first.

    The rate is computed exactly on integers and only then turned into a
    double: ``round(n*per/d, 2) = (n*per*200 + d) div (2*d) / 100`` for
    non-negative ``n`` and positive ``d``. A zero dwelling count raises (ANSI
    divide-by-zero), as the reference's SQL does; ``zero='null'`` gives null.
    """
    if zero not in ("raise", "null"):
        raise ValueError("zero must be 'raise' or 'null'")
    per_crash = _fatalities_per_crash(tables)
    fc = tables["fact_crashes"].select("crash_id", "lga_id")
    lga = (tables["dim_lga"].where(F.col("dwelling_count").isNotNull())
           .select("lga_id", "lga_name", "dwelling_count"))
    g = (per_crash.join(fc, "crash_id").join(lga, "lga_id")
         .groupBy("lga_name", "dwelling_count").agg(F.sum("n").cast("bigint").alias("total_fatalities")))
    n, d = F.col("total_fatalities"), F.col("dwelling_count")
    denom = d * 2 if zero == "raise" else F.when(d != 0, d * 2)
    staged = g.select("lga_name", "dwelling_count", "total_fatalities",
                      (n * F.lit(per * 200) + d).alias("__num"), denom.alias("__den"))
    rate = F.expr("__num div __den").cast("double") / F.lit(100.0)
    out = staged.select("lga_name", "dwelling_count", "total_fatalities",
                        rate.alias("avg_fatalities_per_1000_dwellings"))
    return out.orderBy(F.desc("avg_fatalities_per_1000_dwellings"))
