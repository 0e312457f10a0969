"""Scale properties of the plans, checked on `explain()` output: no cross
products anywhere, co-located crash-grain joins, no re-shuffle in the
conform join, pruned scans and pushed filters."""

import contextlib
import io
import re

import pytest

from starloom.operators import conform as cf
from starloom.plans import analog, catalog

BASE = "/root/testdata/sf0.001"
NO_BROADCAST = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")


def plan_text(df, mode="formatted") -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode=mode)
    return buf.getvalue()


@contextlib.contextmanager
def no_broadcast(spark):
    old = {k: spark.conf.get(k, None) for k in NO_BROADCAST}
    try:
        for k in NO_BROADCAST:
            spark.conf.set(k, "-1")
        yield
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


@pytest.mark.parametrize("name", sorted(catalog.queries()))
def test_no_cross_products(spark, name):
    text = plan_text(catalog.queries()[name](spark, BASE), mode="simple")
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text


def test_crash_grain_joins_are_colocated(spark):
    with no_broadcast(spark):
        text = plan_text(catalog.queries()["q3_weekday_time"](spark, BASE), mode="simple")
    crash_shuffles = re.findall(r"Exchange hashpartitioning\(crash_id", text)
    # only the per-crash fatality counts move; the bucketed crash tables do not
    assert len(crash_shuffles) == 1, text
    assert text.count("Bucketed: true") >= 2


def test_conform_join_keeps_key_partitioning(spark):
    sh = analog.sheets(spark, BASE)
    with no_broadcast(spark):
        text = plan_text(cf.merge(sh.fatality, sh.crash, "Crash ID", null_safe=False).df, mode="simple")
    # keys from inner joins: one join on the partitioning that the inputs already have
    assert re.search(r"SortMergeJoin \[__l0#\d+L\], \[__r0#\d+L\], LeftOuter", text)
    assert not re.search(r"Exchange hashpartitioning\(__[lr]0#", text), "re-shuffled on the key"
    assert len(re.findall(r"FileScan parquet \[l_orderkey", text)) == 2


def test_conflicts_and_foreign_keys_plan(spark):
    """P6 reads the joined copy once; K6 shuffles the child keys of a parent once."""
    text = plan_text(catalog.queries()["p6_conflict_report"](spark, BASE), mode="simple")
    assert text.count("FileScan") == 1
    from starloom.operators import quality
    t = catalog.stored_warehouse(spark, BASE)
    five = [f for f in quality.FOREIGN_KEYS if f.parent == "fact_crashes"]
    with no_broadcast(spark):
        text = plan_text(quality.check_foreign_keys(t, five), mode="simple")
    # grouped by the key alone; the parent lies bucketed on it
    assert len(re.findall(r"Exchange hashpartitioning\(__k", text)) == 1


def test_daily_tables_write_no_joined_frame(spark, monkeypatch):
    made = []
    monkeypatch.setattr(catalog.wh, "conform_records", lambda *a, **k: made.append(1))
    b = catalog.Build(spark, BASE)
    assert b.table("dim_date").count() > 0 and b.table("fact_number").count() > 0 and not made


def test_hot_key_is_split_before_the_first_join(spark, tmp_path):
    """A third of the lines on one order: no task of the conform join writes above twice
    the mean."""
    from pyspark.sql import functions as F
    for t in ("orders", "part", "customer", "nation", "region"):
        spark.read.parquet(f"{BASE}/{t}.parquet").write.parquet(f"{tmp_path}/{t}.parquet")
    lines = spark.read.parquet(f"{BASE}/lineitem.parquet")
    hot = lines.agg(F.min("l_orderkey")).first()[0]
    (lines.withColumn("l_orderkey", F.when(F.pmod(F.xxhash64(*lines.columns), F.lit(3)) == 0, hot).otherwise(F.col("l_orderkey")))
     .write.parquet(f"{tmp_path}/lineitem.parquet"))
    conf = {"spark.sql.adaptive.enabled": "false", "spark.sql.shuffle.partitions": "8"}
    old = {k: spark.conf.get(k) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        with no_broadcast(spark):
            sh = analog.sheets(spark, str(tmp_path))
            joined = cf.merge(sh.fatality, sh.crash, "Crash ID", null_safe=False, salt_buckets=cf.SALT_BUCKETS, hot=sh.hot).df
            assert list(sh.hot) == [hot] and sh.hot[hot] > 8
            sizes = [r["count"] for r in joined.groupBy(F.spark_partition_id()).count().collect()]
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    assert sum(sizes) == lines.count() and max(sizes) <= 2 * sum(sizes) / 8


def test_scans_pruned_and_filters_pushed(spark):
    text = plan_text(catalog.queries()["q5_vehicle_types"](spark, BASE))
    date_scans = [l for l in text.splitlines() if "ReadSchema: struct<date_id:date,year:int>" in l]
    assert date_scans, "dim_date scan not pruned to the two columns used"
    assert re.search(r"PushedFilters: \[[^\]]*GreaterThan\(year,1998\)", text)
    q2 = plan_text(catalog.queries()["q2_state_crashes"](spark, BASE))
    crash_schema = [l for l in q2.splitlines() if "ReadSchema" in l and "crash_id" in l]
    assert crash_schema and all("lga_id" not in l for l in crash_schema)


def test_colocated_when_session_partitions_differ_from_buckets(spark):
    from starloom.plans import reports
    from starloom.sinks.tables import read_warehouse, write_warehouse
    b = catalog.build(spark, BASE)
    t = read_warehouse(spark, write_warehouse(spark, b.builders, buckets=4))
    assert t.buckets == 4
    old = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "13")
        with no_broadcast(spark):
            text = plan_text(reports.q3_weekday_time_of_day(t), mode="simple")
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
    # the crash-grain tables are read bucketed and not shuffled; only the
    # narrow per-crash counts move (aggregate, then into the bucket count)
    assert text.count("Bucketed: true") == 2
    assert re.findall(r"Exchange hashpartitioning\(crash_id#\d+L, (\d+)\)", text) == ["4", "13"]
