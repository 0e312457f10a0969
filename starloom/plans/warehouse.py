"""The warehouse build: conform the two record sets, then eight dimensions and
three facts (inventory B1, B2, D1-D8, T1-T3).

Inputs are plain DataFrames with the source labels (``Crash ID``, ``State``,
...) and an order column ``_row`` (see :mod:`starloom.sources`): a source
position, so unique, which keeps dense numbering free of tie-breaking and
deterministic when a lost task is recomputed. Every
function returns a lazy DataFrame; nothing is collected except the bounded
per-column decision of the duplicate-label step (P3).
"""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from starloom.functions.scalar import (
    STATE_NAMES,
    composite_key,
    is_weekend,
    map_with_passthrough,
    month_start,
    null_if_in,
    safe_bigint,
    weekday_name,
)
from starloom.operators import conform as cf
from starloom.operators.keys import dense_ids, keep_first
from starloom.session import SCRATCH_CODEC, once, scratch_path

ROW = cf.ROW

# Source labels the build reads.
CRASH_ID = "Crash ID"
STATE = "State"
LGA_NAME = "National LGA Name 2021"
REMOTENESS = "National Remoteness Areas"
VEHICLE_FLAGS = ("Bus Involvement", "Heavy Rigid Truck Involvement", "Articulated Truck Involvement")
EVENT_FLAGS = ("Christmas Period", "Easter Period")
DROPPED_DUPLICATE = "Time of day"


def bucketed_copy(spark: SparkSession, df: DataFrame, key: str, name: str) -> DataFrame:
    """``df`` written once to the scratch folder, bucketed and sorted on ``key`` in as many buckets as the
    session shuffles into; rows that lie partitioned so are not moved. The catalog name that a
    bucketed table needs is dropped when the copy is opened."""
    path = scratch_path(spark, name)
    table = f"starloom_{path.rsplit('/', 1)[1].replace('-', '_')}"
    buckets = cf.session_tasks(df)
    (df.repartition(buckets, F.col(f"`{key}`")).write.format("parquet").options(path=path, compression=SCRATCH_CODEC)
     .bucketBy(buckets, key).sortBy(key).saveAsTable(table))
    copy = spark.table(table)
    spark.sql(f"DROP TABLE {table}")
    return copy


@dataclass
class Conformed:
    """Result of B1: the wide fatality x crash frame and its side outputs."""

    frame: DataFrame
    conflicts: DataFrame
    decisions: dict = field(default_factory=dict)


def conform_records(fatality: DataFrame, crash: DataFrame, key: str = CRASH_ID,
                    drop: tuple[str, ...] = (DROPPED_DUPLICATE,), upper: tuple[str, ...] = (STATE,),
                    null_safe: bool = True, materialize: bool = True,
                    salt_buckets: int | None = cf.SALT_BUCKETS, hot: dict | None = None) -> Conformed:
    """B1: fatality LEFT JOIN crash on the key (fatalities drive the join; a
    crash without a fatality is lost), clean header newlines, resolve labels
    that collide after cleaning, report and resolve ``_x``/``_y`` overlaps with
    the crash (right) copy winning even when null, drop the case-colliding
    duplicate, upper-case the state code.

    With ``materialize`` the joined frame is written once as Parquet under
    ``spark.checkpoint.dir`` (the reference exports it too); the
    duplicate-label decision is computed during that write, and every table
    built downstream reads the copy, each scanning only its own columns,
    instead of re-running the join. Without hot keys and null matching the joined rows lie
    partitioned on the key, so the copy is bucketed on it as it is and grouping by the key moves no rows.
    Physical column names are positional, so labels with spaces, newlines or
    case collisions need no escaping."""
    if salt_buckets is not None and hot is None:
        hot = cf.heavy_keys(fatality, key, salt_buckets or cf.session_tasks(fatality))
    bucketed = materialize and salt_buckets is not None and not hot and not null_safe
    if bucketed:  # a broadcast join would leave the rows where they are, and move them after it with all columns
        crash = crash.hint("merge")
    merged = cf.merge(fatality, crash, key, how="left", null_safe=null_safe, salt_buckets=salt_buckets, hot=hot)
    if materialize:
        # The duplicate-label checks ride along with the write as observed
        # metrics (DataFrame.observe): no separate pass over the data.
        spark = merged.df.sparkSession
        pairs, checks = cf.duplicate_label_checks(cf.clean_labels(merged))
        obs = Observation("duplicate_labels")
        checked = merged.df.observe(obs, *checks) if pairs else merged.df
        if bucketed:
            copy = bucketed_copy(spark, checked, merged.physical[merged.labels.index(key)], "conformed")
        else:
            path = scratch_path(spark, "conformed")
            checked.write.mode("overwrite").parquet(path, compression=SCRATCH_CODEC)
            copy = spark.read.parquet(path)
        decisions = cf.decisions_from(pairs, obs.get) if pairs else {}
        merged = cf.LabeledFrame(copy, merged.labels)
        cleaned = cf.clean_labels(merged)
    else:
        cleaned = cf.clean_labels(merged)
        decisions = cf.duplicate_label_differences(cleaned)
    deduped = cf.resolve_duplicate_labels(cleaned, differences=decisions)
    conflicts = cf.conflict_report(deduped, key)
    resolved = cf.drop_labels(cf.keep_right(deduped), drop)
    for lab in upper:
        if resolved.has(lab):
            resolved = resolved.with_label(lab, F.upper(resolved.col(lab)))
    return Conformed(resolved.to_df(), conflicts, decisions)


def conform_counts(fatality_counts: DataFrame, crash_counts: DataFrame, key: str = "Date",
                   null_safe: bool = True, materialize: bool = True) -> DataFrame:
    """B2: daily fatality counts LEFT JOIN daily crash counts on the date; the
    first (fatality) copy of every shared column wins (P5). With ``materialize`` the
    day-grain result is written once, since several tables and the export read it."""
    merged = cf.merge(fatality_counts, crash_counts, key, how="left", null_safe=null_safe)
    daily = cf.keep_left(merged).to_df()
    if not materialize:
        return daily
    spark = daily.sparkSession
    path = scratch_path(spark, "daily-counts")
    daily.write.parquet(path)
    return spark.read.schema(daily.schema).parquet(path)


# --- dimensions -------------------------------------------------------------

def dim_date(counts: DataFrame, date_col: str = "Date") -> DataFrame:
    """Calendar attributes of every date in the daily counts, distinct."""
    d = F.to_date(F.col(date_col))
    return counts.select(
        d.alias("date_id"),
        F.year(d).alias("year"),
        F.month(d).alias("month"),
        F.dayofmonth(d).alias("day"),
        weekday_name(d).alias("day_of_week"),
        is_weekend(d).alias("is_weekend"),
    ).distinct()


def dim_state(conformed: DataFrame, mapping: dict[str, str] = STATE_NAMES) -> DataFrame:
    """Distinct state codes; name from the fixed map, unmapped codes pass
    through as their own name."""
    return (conformed.select(F.col(STATE).alias("state_id")).distinct()
            .select("state_id", map_with_passthrough("state_id", mapping).alias("state_name")))


def dim_lga(conformed: DataFrame, dwellings: DataFrame | None) -> DataFrame:
    """D3: one row per LGA *name*, first occurrence wins (same-named LGAs of
    two states collapse to the first seen), dense 0-based ``lga_id`` in order
    of first occurrence, dwelling count by name (null if no dwellings input).

    The state's id is its code, so the column itself serves: the state dimension holds
    every code of the frame, and a lookup would return the key it was given."""
    combos = (conformed.groupBy(LGA_NAME, STATE, REMOTENESS)
              .agg(F.min(ROW).alias(ROW)))  # distinct, remembering first occurrence
    lga = combos.select(
        F.col(LGA_NAME).alias("lga_name"), F.col(REMOTENESS).alias("national_remoteness_area"),
        F.col(STATE).alias("state_id"), F.col(ROW))
    if dwellings is not None:
        dw = dwellings.select(F.col("lga_name").alias("__dw_name"),
                              F.col("dwelling_count").alias("__dw_count"),
                              F.col(ROW).alias("__dw_row") if ROW in dwellings.columns else F.lit(0).alias("__dw_row"))
        # Null names are dropped just below, so null-matching cannot matter.
        lga = (lga.join(dw, lga["lga_name"] == dw["__dw_name"], "left")
               .select("lga_name", "national_remoteness_area", "state_id",
                       F.col("__dw_count").alias("dwelling_count"),
                       F.struct(F.col(ROW).alias("a"), F.col("__dw_row").alias("b")).alias(ROW)))
    else:
        lga = lga.withColumn("dwelling_count", F.lit(None).cast("bigint"))
    lga = lga.where(F.col("lga_name").isNotNull())
    first = keep_first(lga, "lga_name", ROW)
    ided = dense_ids(first, F.col(ROW), "lga_id", break_ties=False)
    return ided.select(
        F.col("lga_id").cast("bigint"), "lga_name", "national_remoteness_area",
        F.col("dwelling_count").cast("bigint").alias("dwelling_count"), "state_id")


def dim_time(conformed: DataFrame) -> DataFrame:
    """Crash time and time of day per crash, distinct."""
    return conformed.select(
        F.col(CRASH_ID).alias("crash_id"), F.col("Time").alias("crash_time"),
        F.col("Time of Day").alias("time_of_day")).distinct()


def dim_vehicle(conformed: DataFrame, sentinel: str = "-9") -> DataFrame:
    """Vehicle-involvement flags per crash; distinct *then* the ``-9``
    sentinel becomes null (so rows equal only after cleaning both survive)."""
    base = conformed.select(F.col(CRASH_ID).alias("crash_id"), *[F.col(c) for c in VEHICLE_FLAGS]).distinct()
    return base.select("crash_id", *[null_if_in(F.col(c).cast("string"), [sentinel]).alias(c) for c in VEHICLE_FLAGS])


def person_key(crash_id, age, gender, road_user):
    """``{crash}_{age}_{gender}_{road user}`` with spaces as ``_``."""
    return composite_key(crash_id, age, gender, road_user)


def dim_person(conformed: DataFrame) -> DataFrame:
    """Distinct person descriptions (5 columns); the text key uses 4, so
    two identical victims of one crash share one ``person_id``."""
    base = conformed.select(
        F.col(CRASH_ID).alias("crash_id"), F.col("Gender").alias("gender"), F.col("Age").alias("age"),
        F.col("Age Group").alias("age_group"), F.col("Road User").alias("road_user")).distinct()
    return base.select(person_key("crash_id", "age", "gender", "road_user").alias("person_id"),
                       "crash_id", "gender", "age", "age_group", "road_user")


def dim_event(conformed: DataFrame) -> DataFrame:
    """Holiday-period flags per crash, distinct (flags stay Yes/No text)."""
    return conformed.select(F.col(CRASH_ID).alias("crash_id"), *[F.col(c) for c in EVENT_FLAGS]).distinct()


def dim_road(conformed: DataFrame, sentinel: int = -9, undetermined: str = "Undetermined") -> DataFrame:
    """Speed limit and road type per crash; distinct first, then the speed
    is parsed (unparseable text becomes null, ``-9`` becomes null) and the
    road type ``Undetermined`` becomes null."""
    base = conformed.select(
        F.col(CRASH_ID).alias("crash_id"), F.col("Speed Limit").alias("speed_limit"),
        F.col("National Road Type").alias("national_road_type")).distinct()
    speed = safe_bigint("speed_limit")
    return base.select(
        "crash_id",
        F.when(speed != F.lit(sentinel), speed).alias("speed_limit"),
        null_if_in("national_road_type", [undetermined]).alias("national_road_type"))


# --- facts ------------------------------------------------------------------

def fact_fatalities(conformed: DataFrame, ids_from_row: bool = False) -> DataFrame:
    """One row per fatality, dense 0-based ``fatality_id`` in source order.

    With ``ids_from_row`` the caller guarantees that ``_row`` already is that
    number (a dense ordinal of the fatality sheet, and a merge that kept one
    row per fatality), so no sort of the largest table is needed."""
    base = conformed.select(
        F.col(CRASH_ID).alias("crash_id"),
        person_key(F.col(CRASH_ID), F.col("Age"), F.col("Gender"), F.col("Road User")).alias("person_id"),
        F.col(ROW))
    if ids_from_row:
        return base.select(F.col(ROW).cast("bigint").alias("fatality_id"), "person_id", "crash_id")
    ided = dense_ids(base, F.col(ROW), "fatality_id", break_ties=False)
    return ided.select(F.col("fatality_id").cast("bigint"), "person_id", F.col("crash_id"))


def fact_crashes(conformed: DataFrame, lgas: DataFrame) -> DataFrame:
    """One row per distinct crash record; the date is the first of the
    crash month; ``lga_id`` looked up by LGA name alone (J5)."""
    base = conformed.select(
        F.col(CRASH_ID).alias("crash_id"), F.col("Year").alias("year"), F.col("Month").alias("month"),
        F.col(LGA_NAME).alias("lga_name"), F.col(STATE).alias("state_id")).distinct()
    dated = base.select("crash_id", month_start("year", "month").alias("date_id"), "lga_name", "state_id")
    lk = lgas.select(F.col("lga_id"), F.col("lga_name").alias("__lga_name"))
    # The LGA dimension holds no null name, so null-matching cannot matter.
    joined = dated.join(lk, dated["lga_name"] == lk["__lga_name"], "left")
    return joined.select("crash_id", "date_id", F.col("lga_id").cast("bigint"), "state_id")


def fact_number(counts: DataFrame) -> DataFrame:
    """The daily totals with a dense 0-based ``number_date_id`` in source
    order."""
    base = counts.select(
        F.to_date(F.col("Date")).alias("date_id"),
        F.col("Number Fatalities").cast("bigint").alias("total_fatalities"),
        F.col("Number of fatal crashes").cast("bigint").alias("total_crashes"),
        F.col(ROW))
    ided = dense_ids(base, F.col(ROW), "number_date_id", break_ties=False)
    return ided.select(F.col("number_date_id").cast("bigint"), "date_id", "total_fatalities", "total_crashes")


TABLES = ("dim_date", "dim_state", "dim_lga", "dim_time", "dim_vehicle", "dim_person",
          "dim_event", "dim_road", "fact_fatalities", "fact_crashes", "fact_number")


#: The columns that the crash-grain tables take from the conformed frame.
CRASH_COLUMNS = (CRASH_ID, "Time", "Time of Day", *VEHICLE_FLAGS, *EVENT_FLAGS, "Speed Limit", "National Road Type",
                 "Year", "Month", LGA_NAME, STATE)


def crash_grain(conformed: DataFrame) -> DataFrame:
    """The distinct crash descriptions, written once: five tables are distinct
    projections of them and need not read the fatality grain.

    The copy lies bucketed on the crash key, so these projections, and a load in as many buckets, move no
    rows. It is reduced before it is dealt to the buckets: a hot crash's rows are few by then."""
    distinct = conformed.select(*[F.col(c) for c in CRASH_COLUMNS]).distinct()
    return bucketed_copy(conformed.sparkSession, distinct, CRASH_ID, "crash-grain")


def build_warehouse(conformed, counts, dwellings: DataFrame | None, parallel: int = 3,
                    fatality_ids_from_row: bool | Callable[[], bool] = False, deferred: bool = False) -> dict:
    """All eleven tables as plans over the conformed frames.

    ``conformed`` and ``counts`` are DataFrames, or functions that make them on first use.
    Three tables carry dense ids and run one job each while being built
    (``fact_crashes`` also needs the LGA ids), and the crash-grain tables share one written
    copy. By default those jobs are submitted together and plain DataFrames are
    returned. With ``deferred`` each table is returned as a builder (a no-argument
    callable) instead: a table's inputs are made when it is built, and a loader can start
    writing the tables that need no numbering while the numbering jobs still run
    (see ``sinks.write_warehouse``). ``fatality_ids_from_row`` (or a function that finds it
    out on first use): see :func:`fact_fatalities`."""
    frame = once(conformed) if callable(conformed) else lambda: conformed
    days = once(counts) if callable(counts) else lambda: counts
    from_row = fatality_ids_from_row if callable(fatality_ids_from_row) else lambda: fatality_ids_from_row
    crashes_of = once(lambda: crash_grain(frame()))
    lga = once(lambda: dim_lga(frame(), dwellings))
    builders = {
        "dim_date": lambda: dim_date(days()),
        "dim_state": lambda: dim_state(frame()),
        "dim_lga": lga,
        "dim_time": lambda: dim_time(crashes_of()),
        "dim_vehicle": lambda: dim_vehicle(crashes_of()),
        "dim_person": lambda: dim_person(frame()),
        "dim_event": lambda: dim_event(crashes_of()),
        "dim_road": lambda: dim_road(crashes_of()),
        "fact_fatalities": once(lambda: fact_fatalities(frame(), from_row())),
        "fact_crashes": once(lambda: fact_crashes(crashes_of(), lga())),
        "fact_number": once(lambda: fact_number(days())),
    }
    if deferred:
        return builders
    with ThreadPoolExecutor(max_workers=max(1, parallel)) as pool:
        for f in [pool.submit(builders[b]) for b in ("dim_lga", "fact_fatalities", "fact_number", "dim_time")]:
            f.result()
    return {name: build() for name, build in builders.items()}
