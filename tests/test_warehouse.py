"""Dimensions and facts on a hand-made fixture: traps 3-9 of the survey."""

import datetime as dt

import pytest

from starloom.plans import warehouse as wh

FAT = ("`Crash ID` bigint, `Gender` string, `Age` int, `Age Group` string, `Road User` string, _row bigint")
CRASH = ("`Crash ID` bigint, `State` string, `Year` int, `Month` int, `Time` string, `Time of Day` string, "
         "`National LGA Name 2021` string, `National Remoteness Areas` string, `Bus Involvement` string, "
         "`Heavy Rigid Truck Involvement` string, `Articulated Truck Involvement` string, `Speed Limit` string, "
         "`National Road Type` string, `Christmas Period` string, `Easter Period` string")


@pytest.fixture(scope="module")
def built(spark):
    fat = spark.createDataFrame([
        (10, "Male", 30, "26_to_39", "Driver", 0),
        (10, "Male", 30, "26_to_39", "Driver", 1),          # identical victim
        (11, "Female", -9, "Unknown", "Motorcycle rider", 2),  # age -9 survives
        (12, "Male", 70, "65_to_74", "Pedestrian", 3),
        (13, "Male", 50, "40_to_64", "Driver", 4),
    ], FAT)
    crash = spark.createDataFrame([
        (10, "nsw", 2023, 5, "08:00", "Day", "Albury", "Inner Regional", "-9", "No", "Yes", "-9", "Local Road",
         "No", "No"),
        (11, "vic", 2023, 5, "22:00", "Night", "Albury", "Outer Regional", "Yes", "No", "No", "<40",
         "Undetermined", "Yes", "No"),                      # same LGA name, other state
        (12, "zz", 2022, 12, "12:00", "Day", None, "Remote", "No", "No", "No", "100", "Highway", "Yes", "No"),
        (13, "nsw", 2022, 4, "07:00", "Unknown", "Bega", "Outer Regional", "No", "No", "No", "60.0", "Highway",
         "No", "Yes"),
    ], CRASH)
    dwell = spark.createDataFrame([("Albury", 25000, "a"), ("Bega", 0, "b")], "lga_name string, dwelling_count bigint, _row string")
    c = wh.conform_records(fat, crash, materialize=False)
    counts = spark.createDataFrame(
        [(dt.date(2022, 4, 1), 1, 1, 0), (dt.date(2022, 12, 1), 1, 1, 1), (dt.date(2023, 5, 1), 3, 2, 2),
         (dt.date(2023, 5, 6), 0, None, 3)],
        "Date date, `Number Fatalities` int, `Number of fatal crashes` int, _row int")
    return wh.build_warehouse(c.frame, counts, dwell)


def rows(df, *cols):
    return sorted(tuple(r[c] for c in cols) for r in df.collect())


def test_dim_state_passthrough(built):
    assert rows(built["dim_state"], "state_id", "state_name") == [
        ("NSW", "New South Wales"), ("VIC", "Victoria"), ("ZZ", "ZZ")]


def test_dim_lga_first_seen_wins_and_dense_ids(built):
    got = rows(built["dim_lga"], "lga_id", "lga_name", "state_id", "national_remoteness_area", "dwelling_count")
    assert got == [(0, "Albury", "NSW", "Inner Regional", 25000), (1, "Bega", "NSW", "Outer Regional", 0)]


def test_fact_crashes_month_start_and_lookup_by_name(built):
    got = rows(built["fact_crashes"], "crash_id", "date_id", "lga_id", "state_id")
    assert got == [(10, dt.date(2023, 5, 1), 0, "NSW"), (11, dt.date(2023, 5, 1), 0, "VIC"),
                   (12, dt.date(2022, 12, 1), None, "ZZ"), (13, dt.date(2022, 4, 1), 1, "NSW")]


def test_person_ids_shared_by_identical_victims(built):
    ff = rows(built["fact_fatalities"], "fatality_id", "person_id", "crash_id")
    assert ff[0] == (0, "10_30_Male_Driver", 10) and ff[1] == (1, "10_30_Male_Driver", 10)
    assert ff[2] == (2, "11_-9_Female_Motorcycle_rider", 11)
    assert built["dim_person"].count() == 4


def test_sentinels_only_where_the_reference_nulls_them(built):
    veh = {r.crash_id: r["Bus Involvement"] for r in built["dim_vehicle"].collect()}
    assert veh[10] is None and veh[11] == "Yes"
    road = {r.crash_id: (r.speed_limit, r.national_road_type) for r in built["dim_road"].collect()}
    assert road == {10: (None, "Local Road"), 11: (None, None), 12: (100, "Highway"), 13: (60, "Highway")}


def test_dim_date_and_fact_number(built):
    d = rows(built["dim_date"], "date_id", "day_of_week", "is_weekend")
    assert (dt.date(2023, 5, 6), "Saturday", True) in d and (dt.date(2022, 4, 1), "Friday", False) in d
    fn = rows(built["fact_number"], "number_date_id", "date_id", "total_crashes")
    assert fn[-1] == (3, dt.date(2023, 5, 6), None)


def test_dim_lga_without_dwellings_input(spark):
    fat = spark.createDataFrame([(1, "Male", 30, "26_to_39", "Driver", 0)], FAT)
    crash = spark.createDataFrame([(1, "nsw", 2023, 5, "08:00", "Day", "Albury", "Inner Regional", "No", "No",
                                    "No", "80", "Highway", "No", "No")], CRASH)
    c = wh.conform_records(fat, crash, materialize=False)
    lga = wh.dim_lga(c.frame, None)
    r = lga.first()
    assert (r.lga_id, r.lga_name, r.dwelling_count) == (0, "Albury", None)
    assert dict(lga.dtypes)["dwelling_count"] == "bigint"
