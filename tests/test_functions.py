"""Scalar functions (C3, C8-C14, C20, C21): traps 6, 8, 15 of the survey."""

from pyspark.sql import functions as F

from starloom.functions.scalar import (
    SPEED_EDGES,
    SPEED_LABELS,
    bin_right_closed,
    composite_key,
    is_weekend,
    item_text,
    map_with_passthrough,
    month_start,
    null_if_in,
    safe_bigint,
    weekday_name,
)


def test_right_closed_bins(spark):
    df = spark.createDataFrame([(v,) for v in (0.0, 1.0, 60.0, 61.0, 80.0, 100.0, 100.5, 200.0, 201.0, None)],
                               "v double")
    got = [r[0] for r in df.select(bin_right_closed("v", SPEED_EDGES, SPEED_LABELS)).collect()]
    assert got == [None, "Low", "Low", "Medium", "Medium", "High", "Very High", "Very High", None, None]


def test_safe_bigint_coerces_and_never_raises(spark):
    df = spark.createDataFrame([("100",), ("100.0",), ("<40",), ("-9",), (None,), ("abc",)], "s string")
    assert [r[0] for r in df.select(safe_bigint("s")).collect()] == [100, 100, None, -9, None, None]


def test_composite_key_renders_null_as_nan_and_spaces(spark):
    df = spark.createDataFrame([(7, 35, "Male", "Motorcycle rider"), (8, None, None, "Driver")],
                               "c bigint, a int, g string, u string")
    got = [r[0] for r in df.select(composite_key("c", "a", "g", "u")).collect()]
    assert got == ["7_35_Male_Motorcycle_rider", "8_nan_nan_Driver"]


def test_map_with_passthrough(spark):
    df = spark.createDataFrame([("NSW",), ("XYZ",), (None,)], "s string")
    got = [r[0] for r in df.select(map_with_passthrough("s", {"NSW": "New South Wales"})).collect()]
    assert got == ["New South Wales", "XYZ", None]


def test_null_if_in_whole_cell_only(spark):
    df = spark.createDataFrame([("-9",), ("-90",), ("Unknown",), ("x",)], "s string")
    got = [r[0] for r in df.select(null_if_in("s", ["-9", "Unknown"])).collect()]
    assert got == [None, "-90", None, "x"]


def test_dates(spark):
    df = spark.createDataFrame([(2024, 6)], "y int, m int").select(month_start("y", "m").alias("d"))
    r = df.select("d", weekday_name("d"), is_weekend("d")).first()
    assert str(r[0]) == "2024-06-01" and r[1] == "Saturday" and r[2] is True


def test_item_text(spark):
    df = spark.createDataFrame([("Driver",), (None,)], "u string")
    assert [r[0] for r in df.select(item_text("Road User", F.col("u"))).collect()] == ["Road User=Driver", None]
