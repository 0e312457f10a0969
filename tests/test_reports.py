"""Report equivalences: CUBE + HAVING = GROUP BY, unpivot = UNION ALL,
DataFrame = SQL text; and Q6's divide-by-zero behaviour (trap 13)."""

import pytest
from pyspark.errors import ArithmeticException, SparkRuntimeException

from starloom.plans import catalog, reports, sql_text

BASE = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def tables(spark):
    return catalog.stored_warehouse(spark, BASE)


def _same(a, b):
    assert a.columns == b.columns
    assert sorted(map(tuple, a.collect())) == sorted(map(tuple, b.collect()))


def test_cube_equals_groupby(tables):
    _same(reports.q3_weekday_time_of_day(tables), reports.q3_weekday_time_of_day(tables, use_cube=True))


def test_unpivot_equals_union_all(tables):
    _same(reports.q5_vehicle_types_by_year(tables, 1996), reports.q5_union_all(tables, 1996))


@pytest.mark.parametrize("name,fn,kw", [
    ("q1", reports.q1_top_lga_per_year, {}),
    ("q2", reports.q2_crashes_by_state, {"year": 1998}),
    ("q3", reports.q3_weekday_time_of_day, {}),
    ("q4", reports.q4_holiday_fatalities, {}),
    ("q5", reports.q5_vehicle_types_by_year, {"after_year": 1998}),
    ("q6", reports.q6_rate_per_dwellings, {}),
])
def test_dataframe_equals_sql_text(spark, tables, name, fn, kw):
    _same(fn(tables, **kw), sql_text.run(spark, tables, name, year=1998, after=1998))


def test_q6_zero_dwellings(spark, tables):
    from pyspark.sql import functions as F
    t = dict(tables)
    t["dim_lga"] = tables["dim_lga"].withColumn("dwelling_count", F.lit(0).cast("bigint"))
    with pytest.raises((ArithmeticException, SparkRuntimeException)):
        reports.q6_rate_per_dwellings(t).collect()
    out = reports.q6_rate_per_dwellings(t, zero="null").collect()
    assert out and all(r.avg_fatalities_per_1000_dwellings is None for r in out)


def test_q6_half_up_rounding(spark):
    from starloom.plans.reports import q6_rate_per_dwellings
    f = spark.createDataFrame([(i, 1) for i in range(1)] + [(i + 1, 2) for i in range(1)],
                              "fatality_id bigint, crash_id bigint")
    fc = spark.createDataFrame([(1, 0), (2, 1)], "crash_id bigint, lga_id bigint")
    lga = spark.createDataFrame([(0, "a", 8000), (1, "b", 3)], "lga_id bigint, lga_name string, dwelling_count bigint")
    got = {r.lga_name: r.avg_fatalities_per_1000_dwellings for r in
           q6_rate_per_dwellings({"fact_fatalities": f, "fact_crashes": fc, "dim_lga": lga}).collect()}
    assert got == {"a": 0.13, "b": 333.33}   # 0.125 rounds half up


def test_statement_with_quoted_names_and_semicolon(spark, tables):
    """Double-quoted column names and a trailing semicolon are accepted, and the views are
    gone afterwards."""
    got = sql_text.run_statement(spark, tables, """
        SELECT e."Easter Period" AS easter, 'it''s' AS note, count(*) AS n
        FROM dim_event e GROUP BY e."Easter Period";""")
    want = {r["Easter Period"]: r["count"] for r in tables["dim_event"].groupBy("Easter Period").count().collect()}
    assert {r.easter: r.n for r in got.collect()} == want
    assert {r.note for r in got.collect()} == {"it's"}
    assert not spark.catalog.tableExists("dim_event")


def test_views_of_the_caller_survive(spark, tables):
    spark.range(3).createOrReplaceTempView("dim_state")
    sql_text.run(spark, tables, "q2", year=1998)
    assert spark.table("dim_state").count() == 3
    spark.catalog.dropTempView("dim_state")
