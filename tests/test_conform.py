"""Conform operators on a hand-made fixture (FIXTURES.md section 1):
traps 1, 2, 14, 18 and P2-P7."""

import pytest

from starloom.operators import conform as cf
from starloom.plans import warehouse as wh

FAT_SCHEMA = ("`Crash ID` bigint, `Year` int, `Gender` string, `Time of day` string, `Bus \nInvolvement` string, "
              "`Easter \nPeriod` string, `National Road Type` string, _row bigint")
CRASH_SCHEMA = ("`Crash ID` bigint, `State` string, `Year` int, `Time of Day` string, `Bus Involvement` string, "
                "`Easter Period` string, `National Road Type` string")


@pytest.fixture(scope="module")
def sheets(spark):
    fat = spark.createDataFrame([
        (1, 2020, "Male", "Day", "No", "No", "Local Road", 0),
        (1, 2020, "Male", "Day", "No", "No", "Local Road", 1),      # identical victim
        (2, 2021, "Female", "Night", "Yes", "Yes", None, 2),        # null vs null in road type
        (9, 2022, "Male", "Day", None, "No", "Highway", 3),         # fatality without crash
        (None, 2022, "Male", "Day", "No", "No", "Highway", 4),      # null key
    ], FAT_SCHEMA)
    crash = spark.createDataFrame([
        (1, "nsw", 2019, "Day", "No", "Yes", "Undetermined"),
        (2, "Vic", 2021, "Night", "Yes", "Yes", None),
        (3, "qld", 2021, "Day", "No", "No", "Highway"),              # crash without fatality
        (None, "xx", 2000, "Day", "No", "No", "Arterial"),           # null key (pandas matches it)
    ], CRASH_SCHEMA)
    return fat, crash


def test_merge_labels_follow_pandas(sheets):
    fat, crash = sheets
    m = cf.merge(fat, crash, "Crash ID")
    assert m.labels == ("Crash ID", "Year_x", "Gender", "Time of day", "Bus \nInvolvement", "Easter \nPeriod",
                        "National Road Type_x", "State", "Year_y", "Time of Day", "Bus Involvement",
                        "Easter Period", "National Road Type_y", "_row")


def test_left_join_keeps_fatalities_and_matches_null_keys(sheets):
    fat, crash = sheets
    m = cf.merge(fat, crash, "Crash ID")
    rows = m.df.select(m.col("Crash ID").alias("k"), m.col("State").alias("s")).collect()
    got = sorted((r.k if r.k is not None else -1, r.s) for r in rows)
    assert got == [(-1, "xx"), (1, "nsw"), (1, "nsw"), (2, "Vic"), (9, None)]
    strict = cf.merge(fat, crash, "Crash ID", null_safe=False)
    assert strict.df.where(strict.col("State") == "xx").count() == 0


def test_duplicate_labels_after_cleaning(sheets):
    fat, crash = sheets
    cleaned = cf.clean_labels(cf.merge(fat, crash, "Crash ID"))
    decisions = cf.duplicate_label_differences(cleaned)
    # Bus: fatality 9 has null, its crash is missing (null): equal; others equal -> dropped.
    # Easter: row 1 differs ("No" vs "Yes") -> renamed.
    resolved = cf.resolve_duplicate_labels(cleaned, differences=decisions)
    assert "Bus Involvement" in resolved.labels and resolved.labels.count("Bus Involvement") == 1
    assert "Easter Period_dup" in resolved.labels


def test_conflict_report_counts_null_as_different(sheets):
    fat, crash = sheets
    m = cf.merge(fat, crash, "Crash ID")
    rep = {(r.key, r.column) for r in cf.conflict_report(m, "Crash ID").collect()}
    assert (1, "Year") in rep            # 2020 vs 2019
    assert (2, "National Road Type") in rep  # null vs null counts as different
    assert (2, "Year") not in rep


def test_keep_right_wins_even_when_null(sheets):
    fat, crash = sheets
    m = cf.keep_right(cf.merge(fat, crash, "Crash ID"))
    assert "Year" in m.labels and "Year_x" not in m.labels
    rows = {r[0]: r[1] for r in m.df.select(m.col("Crash ID"), m.col("Year")).collect() if r[0] is not None}
    assert rows[1] == 2019 and rows[9] is None   # crash copy, null where no crash


def test_keep_left_removes_suffix_anywhere(spark):
    a = spark.createDataFrame([(1, "a", 5)], "`Date` int, `Day_xname` string, `N` int")
    b = spark.createDataFrame([(1, "b")], "`Date` int, `Day_xname` string")
    out = cf.keep_left(cf.merge(a, b, "Date"))
    assert out.labels == ("Date", "Dayname", "N")
    assert out.to_df().first()["Dayname"] == "a"


def test_case_colliding_labels_and_conform_records(sheets):
    fat, crash = sheets
    c = wh.conform_records(fat, crash, materialize=False)
    cols = c.frame.columns
    assert "Time of Day" in cols and "Time of day" not in cols
    states = {r[0] for r in c.frame.select("State").collect()}
    assert states == {"NSW", "VIC", "XX", None}
    assert c.frame.count() == 5  # crash 3 (no fatality) is lost


def test_to_df_refuses_case_collisions(sheets):
    fat, crash = sheets
    m = cf.merge(fat, crash, "Crash ID")
    with pytest.raises(ValueError):
        m.to_df()


def test_conform_counts_first_copy_wins(spark):
    f = spark.createDataFrame([(1, "Mon", 3, 0), (2, "Tue", 4, 1)], "`Date` int, `Dayweek` string, `Number Fatalities` int, _row int")
    c = spark.createDataFrame([(1, "MONDAY", 2)], "`Date` int, `Dayweek` string, `Number of fatal crashes` int")
    out = wh.conform_counts(f, c)
    assert out.columns == ["Date", "Dayweek", "Number Fatalities", "Number of fatal crashes", "_row"]
    got = sorted(tuple(r)[:4] for r in out.collect())
    assert got == [(1, "Mon", 3, 2), (2, "Tue", 4, None)]


def test_salted_merge_equals_plain_and_spreads_hot_key(spark):
    from pyspark.sql import functions as F
    # one crash holds a third of the fatalities
    fat = spark.range(0, 3000).select(
        F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id") % 400 + 100).cast("bigint").alias("Crash ID"),
        (F.col("id") % 2).cast("string").alias("Gender"), F.col("id").alias("_row"))
    fat = fat.unionByName(spark.createDataFrame([(None, "1", 99999)], "`Crash ID` bigint, Gender string, _row bigint"))
    crash = spark.range(0, 500).select(F.col("id").alias("Crash ID"), (F.col("id") % 5).cast("string").alias("State"))
    crash = crash.unionByName(spark.createDataFrame([(None, "nullstate")], "`Crash ID` bigint, State string"))
    plain = cf.merge(fat, crash, "Crash ID").to_df()
    salted_frame = cf.merge(fat, crash, "Crash ID", salt_buckets=8)
    salted = salted_frame.to_df()
    assert sorted(map(tuple, plain.collect()), key=repr) == sorted(map(tuple, salted.collect()), key=repr)
    assert salted_frame.labels == cf.merge(fat, crash, "Crash ID").labels
    # with a shuffled join (no broadcast, no partition coalescing) the hot
    # key's rows are joined in several tasks
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false"}
    old = {k: spark.conf.get(k) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        again = cf.merge(fat, crash, "Crash ID", salt_buckets=8).to_df()
        tasks = again.where(F.col("Crash ID") == 7).select(F.spark_partition_id().alias("p")).distinct().count()
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    assert tasks > 1
