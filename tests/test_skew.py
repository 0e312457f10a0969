"""Reports under skew and duplicate keys: one crash holds a third of all
fatalities, and crash-grain tables carry repeated crash ids (what a broken
key or the dedup-before-cleaning trap produces). Counting per crash before
the joins must still equal the literal SQL over the same tables."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from starloom.operators import conform as cf
from starloom.plans import reports, sql_text


@pytest.fixture(scope="module")
def tables(spark):
    n_crash = 60
    fat = [(i, f"p{i}", 1) for i in range(150)] + [(150 + i, f"p{150 + i}", 2 + i % (n_crash - 1)) for i in range(300)]
    months = [dt.date(2022 + (c % 3), 1 + c % 12, 1) for c in range(n_crash + 1)]
    crashes = [(c, months[c], c % 7, "NSW" if c % 2 else "VIC") for c in range(1, n_crash + 1)]
    crashes.append((2, months[2], 3, "VIC"))                       # repeated crash id
    dates = sorted({m for m in months})
    dim_date = [(d, d.year, d.month, 1, d.strftime("%A"), d.weekday() >= 5) for d in dates]
    lgas = [(i, f"LGA {i % 5}" if i != 6 else "Unknown", "x", 100 * i, "NSW") for i in range(7)]
    lgas[0] = (0, "LGA 0", "x", 0, "NSW")                           # zero dwellings: kept out below
    times = [(c, "10:00", ["Day", "Night", "Unknown"][c % 3]) for c in range(1, n_crash + 1)] + [(3, "11:00", "Day")]
    veh = [(c, "Yes" if c % 2 else "No", "Yes" if c % 3 == 0 else "No", None if c == 4 else "Yes")
           for c in range(1, n_crash + 1)] + [(4, "Yes", "Yes", "Yes")]
    ev = [(c, "Yes" if c % 4 == 0 else "No", "Yes" if c % 5 == 0 else "No") for c in range(1, n_crash + 1)]
    ev.append((1, "Yes", "Yes"))
    return {
        "fact_fatalities": spark.createDataFrame(fat, "fatality_id bigint, person_id string, crash_id bigint"),
        "fact_crashes": spark.createDataFrame(crashes, "crash_id bigint, date_id date, lga_id bigint, state_id string"),
        "dim_date": spark.createDataFrame(dim_date, "date_id date, year int, month int, day int, day_of_week string, "
                                                    "is_weekend boolean"),
        "dim_lga": spark.createDataFrame([l for l in lgas if l[0] != 0] + [(0, "LGA 0", "x", None, "NSW")],
                                         "lga_id bigint, lga_name string, national_remoteness_area string, "
                                         "dwelling_count bigint, state_id string"),
        "dim_state": spark.createDataFrame([("NSW", "New South Wales"), ("VIC", "Victoria")],
                                           "state_id string, state_name string"),
        "dim_time": spark.createDataFrame(times, "crash_id bigint, crash_time string, time_of_day string"),
        "dim_vehicle": spark.createDataFrame(veh, "crash_id bigint, `Bus Involvement` string, "
                                                  "`Heavy Rigid Truck Involvement` string, "
                                                  "`Articulated Truck Involvement` string"),
        "dim_event": spark.createDataFrame(ev, "crash_id bigint, `Christmas Period` string, `Easter Period` string"),
    }


def _same(a, b):
    assert a.columns == b.columns
    assert sorted(map(tuple, a.collect())) == sorted(map(tuple, b.collect()))


@pytest.mark.parametrize("name,fn,kw", [
    ("q1", reports.q1_top_lga_per_year, {}),
    ("q2", reports.q2_crashes_by_state, {"year": 2023}),
    ("q3", reports.q3_weekday_time_of_day, {}),
    ("q4", reports.q4_holiday_fatalities, {}),
    ("q5", reports.q5_vehicle_types_by_year, {"after_year": 2021}),
    ("q6", reports.q6_rate_per_dwellings, {}),
])
def test_reports_equal_literal_sql_under_skew(spark, tables, name, fn, kw):
    _same(fn(tables, **kw), sql_text.run(spark, tables, name, year=2023, after=2021))


def test_hot_crash_counted_whole(spark, tables):
    q4 = reports.q4_holiday_fatalities(tables).first()
    # crash 1 (150 fatalities) has two event rows, one flagged for both periods
    assert q4.christmas_fatalities >= 150 and q4.easter_fatalities >= 150


@pytest.mark.parametrize("share", [3, 6, 30])
def test_join_of_one_large_key_fills_tasks_evenly(spark, share):
    """One key with so many percent of the rows, and a second, smaller one: no task has over
    twice the mean."""
    n, tasks = 200_000, 64
    fat = spark.range(n).select(
        F.when(F.col("id") % 100 < share, 7).when(F.col("id") % 100 == 99, None).otherwise(F.col("id") + 1000).alias("Crash ID"),
        F.col("id").alias("_row"))
    crash = spark.range(0, n + 1000, 2).select(F.col("id").alias("Crash ID"), (F.col("id") % 5).alias("State"))
    crash = crash.unionByName(spark.createDataFrame([(7, 1), (None, 2)], "`Crash ID` bigint, State bigint"))
    hot = cf.heavy_keys(fat, "Crash ID", tasks)
    assert set(hot) == {7, None} and hot[7] >= share * tasks * 8 // 100
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false",
            "spark.sql.shuffle.partitions": str(tasks)}
    old = {k: spark.conf.get(k) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        joined = cf.merge(fat, crash, "Crash ID", salt_buckets=cf.SALT_BUCKETS).to_df()
        sizes = [r["count"] for r in joined.groupBy(F.spark_partition_id()).count().collect()]
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    assert sum(sizes) == n and max(sizes) <= 2 * n / tasks
    want = cf.merge(fat, crash, "Crash ID").to_df()
    sums = [F.count(F.lit(1)), F.sum(F.xxhash64("Crash ID", "_row", "State").cast("decimal(20,0)"))]
    assert joined.agg(*sums).first() == want.agg(*sums).first()


def test_heavy_keys_of_many_kinds(spark):
    df = spark.range(5000).select(F.when(F.col("id") % 4 == 0, "hot").otherwise(F.col("id").cast("string")).alias("k"))
    assert cf.heavy_keys(df, "k", 16) == {"hot": 32}
    assert cf.heavy_keys(df.limit(0), "k", 16) == {}
    nine = df.select((F.xxhash64("k") % 9).alias("k"))
    assert sum(cf.heavy_keys(nine, "k", 16).values()) >= 9 * 14  # each is larger than a task's mean
