"""What the build and the jobs move as the tables grow: rows numbered once, copies bucketed on the
crash key, each record parsed once."""

import contextlib
import datetime as dt
import io

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from starloom.functions.scalar import weekday_name
from starloom.operators import conform as cf
from starloom.operators import rules
from starloom.operators.keys import dense_ids
from starloom.plans import analog, catalog
from starloom.plans import warehouse as wh
from starloom.sinks.tables import write_csv
from starloom.sources.delimited import read_sheet_csv
from starloom.sources.records import AT, Dialect, _joined, quoted_records


def plan_text(df, mode="simple") -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode=mode)
    return buf.getvalue()


@pytest.fixture
def tables(spark, tmp_path):
    """Writes tables of 40 orders and 160 lines, three of them the same; ``repeated`` orders come twice."""

    def make(repeated=0):
        def put(name, rows, ddl):
            spark.createDataFrame(rows, ddl).coalesce(1).write.parquet(f"{tmp_path}/{name}.parquet")

        day = dt.datetime(1996, 1, 1)
        orders = [(k, k % 7, "OFP"[k % 3], 1.0, day + dt.timedelta(days=k), "1-URGENT") for k in range(40)]
        lines = [(k, k % 5, 1, n, float(k), 10.0 - n, 0.1, 0.2, "ANR"[n % 3], "FO"[k % 2], day + dt.timedelta(days=k + n))
                 for k in range(40) for n in range(4)]
        put("orders", orders + orders[:repeated],
            "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, o_orderdate timestamp, o_orderpriority string")
        put("lineitem", lines[::-1] + lines[:2] * 2,
            "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, l_extendedprice double, "
            "l_discount double, l_tax double, l_returnflag string, l_linestatus string, l_shipdate timestamp")
        put("part", [(k, "PROMO", k * 10) for k in range(5)], "p_partkey bigint, p_type string, p_size int")
        put("customer", [(k, k % 2, "BUILDING") for k in range(7)], "c_custkey bigint, c_nationkey int, c_mktsegment string")
        put("nation", [(0, "A", 0), (1, "B", 0)], "n_nationkey int, n_name string, n_regionkey int")
        put("region", [(0, "ASIA")], "r_regionkey int, r_name string")
        return str(tmp_path)

    return make


def test_lines_are_numbered_once(spark, tables):
    """The order of the fatality sheet is one long, in the order of all line columns."""
    sheet = analog.sheets(spark, tables()).fatality
    assert sheet.schema["_row"].dataType.typeName() == "long"
    rows = sheet.orderBy("_row").collect()
    assert [r["_row"] for r in rows] == list(range(164))
    assert [r["Crash ID"] for r in rows] == sorted(r["Crash ID"] for r in rows)


def test_dense_ids_keep_only_the_columns_asked_for(spark):
    df = spark.range(50).select((49 - F.col("id")).alias("k"), F.lit("x" * 9).alias("wide"), (F.col("id") % 3).alias("v"))
    out = dense_ids(df, "k", "rid", columns=["v"])
    assert sorted(out.columns) == ["rid", "v"]
    assert {r.rid: r.v for r in out.collect()} == {49 - i: i % 3 for i in range(50)}


def test_build_groups_by_crash_without_shuffles(spark, tables):
    build = catalog.Build(spark, tables())
    build.sheets.hot = {}  # so small a table has keys above a task's share
    for name in ("dim_time", "dim_vehicle", "dim_person", "dim_event", "dim_road"):
        assert "Exchange" not in plan_text(build.table(name)), name
    facts = build.table("fact_fatalities")
    assert "Exchange" not in plan_text(facts)
    assert sorted(r.fatality_id for r in facts.collect()) == list(range(164))


def test_repeated_orders_are_numbered_anew(spark, tables):
    """A line with two orders comes twice: the lines' numbers do not number the fatalities."""
    build = catalog.Build(spark, tables(repeated=3))
    assert not build.sheets.row_for_row(build.conformed.frame)
    ids = sorted(r.fatality_id for r in build.table("fact_fatalities").collect())
    assert ids == list(range(len(ids))) and len(ids) > 164


def test_conformed_frame_without_null_matching_is_bucketed(spark):
    fat = spark.createDataFrame([(1, "a", 0), (None, "b", 1), (2, "c", 2), (1, "d", 3)], "`Crash ID` bigint, who string, _row bigint")
    crash = spark.createDataFrame([(1, "nsw", 1), (3, "vic", 2)], "`Crash ID` bigint, State string, n int")
    plain = wh.conform_records(fat, crash, null_safe=True, hot={}).frame
    lying = wh.conform_records(fat, crash, null_safe=False, hot={}).frame
    assert "Exchange" not in plan_text(lying.groupBy("Crash ID").count())
    assert sorted(map(str, plain.collect())) == sorted(map(str, lying.collect()))
    assert not [t.name for t in spark.catalog.listTables() if "conformed" in t.name]


def test_each_record_is_parsed_once(spark, tmp_path):
    path = str(tmp_path / "sheet")
    write_csv(spark.createDataFrame([("a", "1"), ("b", None), ("c, d", "x\ny")], "k string, v string"), path)
    sheet = read_sheet_csv(spark, path, "k string, v string")
    kept = sheet.where("v is not null and k <> 'b'").where(F.length("v") > 0)
    text = plan_text(kept, "extended")
    assert text[text.index("== Optimized"):text.index("== Physical")].count("from_csv") == 1
    assert sorted((r.k, r.v) for r in kept.collect()) == [("a", "1"), ("c, d", "x\ny")]


def optimized(df) -> str:
    text = plan_text(df, "extended")
    return text[text.index("== Optimized"):text.index("== Physical")]


def test_rule_job_parses_once_and_reads_transactions_once(spark):
    """A speed is parsed once, not for each edge of its bins; itemsets and their total are counted from one copy."""
    row = ("Driver", "17_to_25", "Male", "<40", "Day", "Local Road")
    cells = ["Road User", "Age Group", "Gender", "Speed Limit", "Time of Day", "National Road Type"]
    rows = [row, (*row[:3], "60", *row[4:]), (*row[:3], "100.5", *row[4:]), ("-9", *row[1:3], "60", *row[4:])]
    # kept from being folded into a local table
    records = spark.createDataFrame(rows, cells).repartition(2)
    tx = rules.transactions(records)
    assert optimized(tx).count("as double)") == 1
    assert sorted(r["Speed Category"] for r in tx.collect()) == ["Speed Category=Low", "Speed Category=Very High"]
    sets = rules.frequent_itemsets(tx, min_support=0.5, max_len=1)
    assert "Speed Limit" not in optimized(sets)
    assert {r["items"][0]: (r["count"], r["total"]) for r in sets.collect()}["Road User=Driver"] == (2, 2)


def test_conflicts_are_filtered_behind_the_array(spark):
    df = spark.createDataFrame([(1, "a", "b"), (2, "c", "c"), (3, None, None)], "k int, v_x string, v_y string")
    found = cf.conflict_report(cf.LabeledFrame.of(df), "k")
    assert "lambda" not in optimized(found)
    assert sorted(tuple(r) for r in found.collect()) == [(1, "v", "a", "b"), (3, "v", None, None)]


def test_headers_and_offsets_are_found_once(spark, tmp_path):
    path = str(tmp_path / "sheet")
    write_csv(spark.range(20).select("id", F.lit("x\ny").alias("t")).repartition(3, "id"), path)
    sheet = read_sheet_csv(spark, path, "id bigint, t string", header="id,t", dense_order=True)
    # a plan over the sheet neither looks for headers nor counts rows
    assert "count(" not in optimized(sheet) and "rtrim" not in optimized(sheet)
    assert sorted(r["_row"] for r in sheet.collect()) == list(range(20))


def test_lines_are_joined_to_records_as_arrays(spark):
    """Lines, a split at a time, in batches: whole records, records of several lines, and pieces at the borders."""
    lines = ["b\"", "", " ", "c,d\r", "e,\"f", "", "g\",h", "\"i\",j", "k,\"l"]

    def batches():
        for first in (0, 3, 6):
            part = lines[first:first + 3]
            yield pa.RecordBatch.from_pydict({"file": [1] * 3, "block": [8] * 3, "value": part, "begins": [True] * 3})

    out = [tuple(r.values()) for b in _joined(Dialect())(batches()) for r in b.to_pylist()]
    assert sorted(out, key=str) == sorted([
        (1, 8, 0, False, True, "b\""), (1, 8, 0, True, True, "c,d\r"), (1, 8, 1, True, True, "e,\"f\n\ng\",h"),
        (1, 8, 2, True, True, "\"i\",j"), (1, 8, 3, True, False, "k,\"l")], key=str)


def test_files_are_numbered_in_path_order(spark, tmp_path):
    """A record carries its file's number, not its path."""
    for name in ("b", "a", "c"):
        (tmp_path / name).write_text(f"id\n{name}1\n{name}2\n")
    records = quoted_records(spark, str(tmp_path))
    assert records.schema["file"].dataType.typeName() == "long"
    found = [(r.file, r.nth, r.record) for r in records.orderBy(*AT).collect()]
    assert found == [(n, i, r) for n, f in enumerate("abc", 1) for i, r in enumerate(["id", f + "1", f + "2"])]


def test_weekday_of_no_date_is_null(spark):
    """Looked up by number, as formatting takes longer; a null date has no weekday, null or not in the schema."""
    days = spark.createDataFrame([(dt.date(1996, 1, 1) + dt.timedelta(days=k),) for k in range(7)] + [(None,)], "d date")
    for df in (days, days.repartition(2)):
        found = {r[0]: r[1] for r in df.select("d", weekday_name("d").alias("w")).collect()}
        assert found.pop(None) is None and len(found) == 7
        assert all(w == d.strftime("%A") for d, w in found.items())
    assert "date_format" not in optimized(days.repartition(2).select(weekday_name("d")))


def test_etl_knows_whether_crash_keys_are_null(spark):
    from starloom.plans import etl

    def facts(*keys):
        return etl.key_facts(spark.createDataFrame([(k,) for k in keys], "k bigint"), "k")

    assert [facts(), facts(1, 2), facts(1, 1), facts(1, None), facts(None, None)] == [
        (True, False), (True, False), (False, False), (True, True), (False, True)]


def test_sheet_splits_grow_with_the_table(spark, tmp_path, monkeypatch):
    spark.range(450_000).select(F.col("id").alias("o_orderkey"), F.lit("1").alias("o_orderpriority"),
                                F.lit("O").alias("o_orderstatus")).write.parquet(f"{tmp_path}/orders.parquet")
    seen = []

    def reader(spark, path, *args, **kwargs):
        seen.append(int(spark.conf.get("spark.sql.files.maxPartitionBytes").rstrip("b")))
        return spark.createDataFrame([(1, "", "", "", 0)], "a int, b string, c string, d string, e int")

    monkeypatch.setattr(catalog.etl, "read_exported_sheet", reader)
    catalog.s1_sheet_header(spark, str(tmp_path))
    assert seen == [128 << 10]
