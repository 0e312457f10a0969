"""Sources on synthetic files: preamble/footer trim by content (S2/S3),
sheet with banner lines, newline and case-colliding headers (S1), file order."""

import csv
import io
import random

import pytest

from starloom.plans.rule_job import read_processed
from starloom.sinks.tables import write_csv
from starloom.sources import header_record, quoted_records, read_sheet_csv, read_trimmed_csv
from starloom.sources.records import Dialect, ends_inside, split_starts


def test_trimmed_csv(spark, tmp_path):
    lines = ['"Synthetic dwelling counts"', '"Made for tests"', "", "", "", "", "",
             '"Default Summation",', "", "", '"Area (EN)",',
             '"Alpha Vale",120,', '"Beta Ridge (B)",0,', '"Gamma",7,',
             '"Total",127,', "", '"Data source: synthetic"', "", '"INFO","cells are invented"', "",
             '"Copyright"', '"All rights"']
    p = tmp_path / "dw.csv"
    p.write_text("\n".join(lines) + "\n")
    df = read_trimmed_csv(spark, str(p))
    got = [(r.lga_name, r.dwelling_count) for r in df.orderBy("_row").collect()]
    assert got == [("Alpha Vale", 120), ("Beta Ridge (B)", 0), ("Gamma", 7)]


def test_trimmed_csv_keeps_every_record_in_between(spark, tmp_path):
    p = tmp_path / "t.csv"
    p.write_text("p\n" * 3 + "h1\nh2\n" + 'Plain,5\n"In ""quotes"", with comma",6,\nNo count,,\nOdd,x\n\n"Last",7,more\n' + "f1\nf2\n")
    df = read_trimmed_csv(spark, str(p), skip_lines=3, drop_first=2, drop_last=2)
    got = [(r.lga_name, r.dwelling_count) for r in df.orderBy("_row").collect()]
    assert got == [("Plain", 5), ('In "quotes", with comma', 6), ("No count", None), ("Odd", None), ("Last", 7)]
    p.write_text("p\n" * 3 + "a,1\n")
    assert read_trimmed_csv(spark, str(p), skip_lines=3, drop_first=2, drop_last=2).collect() == []


def test_sheet_with_banner_and_odd_headers(spark, tmp_path):
    text = ("Banner one,,\nBanner two,,\n\nBanner four, about Crash ID,\n"
            'Crash ID,"Bus \nInvolvement",Time of day,Time of Day\n'
            '1,Yes,Day,Night\n,No,Night,Day\n"x,1",Yes,Day,Day\n\n2,No,Night,Day\n')
    p = tmp_path / "sheet.csv"
    p.write_text(text)
    schema = "`Crash ID` bigint, `Bus \nInvolvement` string, `Time of day` string, `Time of Day` string"
    header = header_record(spark, str(p), "Crash ID")
    assert header.splitlines() == ['Crash ID,"Bus ', 'Involvement",Time of day,Time of Day']
    for dense in (False, True):
        df = read_sheet_csv(spark, str(p), schema, header=header, integers=("Crash ID",), dense_order=dense)
        assert df.columns[:4] == ["Crash ID", "Bus \nInvolvement", "Time of day", "Time of Day"]
        rows = [(r[0], r[1]) for r in df.orderBy("_row").collect()]
        assert rows == [(1, "Yes"), (None, "No"), (None, "Yes"), (2, "No")]
    assert [r._row for r in df.orderBy("_row").collect()] == [0, 1, 2, 3]


def test_header_far_below(spark, tmp_path):
    p = tmp_path / "late.csv"
    p.write_text("note\n" * 500 + "Key,v\n1,a\n")
    assert header_record(spark, str(p), "Key") == "Key,v"
    with pytest.raises(ValueError):
        header_record(spark, str(p), "Other")


def python_records(text):
    """What Python's own reader of delimited text finds."""
    return [r for r in csv.reader(io.StringIO(text.removeprefix("\ufeff"), newline="")) if r and "".join(r).strip()]


@pytest.fixture
def small_splits(spark):
    old = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    yield lambda size: [spark.conf.set(k, str(size)) for k in old]
    for k, v in old.items():
        spark.conf.set(k, v)


def test_records_over_split_borders(spark, tmp_path, small_splits):
    rnd = random.Random(7)
    cells = ["", "a", "b b", "12", 'in "quotes"', "two\nlines", "one,two", "\n\n", '"', '\n"\n', ",\n,", "\r\n", "é\n漢", "x" * 90, "\n" * 70]
    wanted, folder = [], tmp_path / "many"
    folder.mkdir()
    for f in range(3):
        out = io.StringIO(newline="")
        writer = csv.writer(out, lineterminator="\r\n" if f == 1 else "\n")
        rows = [[str(i), rnd.choice(cells), rnd.choice(cells)] for i in range(60)]
        writer.writerows([["k", "first\nlabel", "second"], *rows])
        text = ("\ufeff" if f == 2 else "") + out.getvalue().replace("50,", "\n  \n50,", 1) + "\n" * f
        (folder / f"part-{f}.csv").write_bytes(text.encode())
        assert python_records(text)[1:] == rows
        wanted += rows
    for size in (150, 1 << 20):
        small_splits(size)
        df = read_sheet_csv(spark, str(folder), "k string, a string, b string", dense_order=True)
        got = df.collect()
        assert sorted(r["_row"] for r in got) == list(range(len(wanted)))
        assert [[c or "" for c in r[:3]] for r in sorted(got, key=lambda r: r["_row"])] == wanted, size
        by_place = read_sheet_csv(spark, str(folder), "k string, a string, b string").orderBy("_row").collect()
        assert [[c or "" for c in r[:3]] for r in by_place] == wanted


def test_header_that_a_split_border_cuts(spark, tmp_path, small_splits):
    p = tmp_path / "cut.csv"
    p.write_text('Banner "one", \n\nabout Key\n"long\nlabel\nof\nmany\nlines",Key\n"1\n2",a\n3,b\n')
    small_splits(9)
    header = header_record(spark, str(p), "Key")
    assert header == '"long\nlabel\nof\nmany\nlines",Key'
    rows = read_sheet_csv(spark, str(p), "l string, k string", header=header, dense_order=True).orderBy("_row").collect()
    assert [tuple(r) for r in rows] == [("1\n2", "a", 0), ("3", "b", 1)]


def test_odd_quotes(spark, tmp_path, small_splits):
    text = '1,5" pipe,x\n2,"a"b"c,y\n"3"\n4,"open\nto the end,z\n5'
    p = tmp_path / "odd.csv"
    p.write_text(text)
    for size in (3, 1000):
        small_splits(size)
        got = [r.record for r in quoted_records(spark, str(p)).orderBy("file", "block", "nth").collect()]
        assert got == ['1,5" pipe,x', '2,"a"b"c,y', '"3"', '4,"open\nto the end,z\n5']
    (tmp_path / "empty.csv").write_text("")
    assert quoted_records(spark, str(tmp_path / "empty.csv")).collect() == []


def test_backslash_escapes():
    own = Dialect(escape="\\")
    assert not ends_inside(r'a,"b\" c",d', False, own) and ends_inside(r'a,"b\"', False, own)
    assert not ends_inside(r'b\" c",d', True, own) and ends_inside('x;"y', False, Dialect(sep=";"))


def test_split_starts_compose(spark):
    rnd = random.Random(3)
    kinds = [(False, True), (True, False), (False, False), (True, True)]  # outside, inside: how a split ends
    rows, want = [], {}
    for f in range(20):
        state = False
        for block in range(rnd.randrange(1, 12)):
            kind = rnd.choice(kinds[:2] * 2 + kinds[2:])
            rows.append((f"f{f}", block * 10, *kind))
            want[f"f{f}", block * 10] = state
            state = kind[state]
    df = spark.createDataFrame(rows, "file string, block long, outside boolean, inside boolean").repartition(3)
    assert {(r.file, r.block): r.begins for r in split_starts(df).collect()} == want


def test_export_and_reload_keep_every_cell(spark, tmp_path):
    rows = [(1, 'say "hi"'), (2, "two\nlines, one cell"), (3, None), (4, "back\\slash"), (5, '\\"'), (6, "")]
    path = str(tmp_path / "out")
    write_csv(spark.createDataFrame(rows, "id int, text string").repartition(2), path)
    got = read_sheet_csv(spark, path, "id int, text string").orderBy("id").collect()
    rows[5] = (6, None)  # an empty cell is a missing one, as in pandas
    assert [tuple(r[:2]) for r in got] == rows
    assert [(r.id, r.text) for r in read_processed(spark, path).orderBy("id").collect()] == [(str(i), t) for i, t in rows]


def test_file_ordinal_dense_in_file_order(spark, tmp_path):
    from pyspark.sql import functions as F

    from starloom.sources.delimited import file_ordinal
    d = tmp_path / "many"
    d.mkdir()
    expected = []
    for f in range(3):
        rows = [f"{f},{i}" for i in range(500 + 37 * f)]
        (d / f"part-{f}.csv").write_text("\n".join(rows) + "\n")
        expected += [(f, i) for i in range(500 + 37 * f)]
    # small splits: every file is cut into several scan partitions
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1024")
    try:
        df = spark.read.schema("f int, i int").csv(str(d)).where(F.col("i") % 7 != 3)
        got = sorted((r._row, r.f, r.i) for r in file_ordinal(df).collect())
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    kept = [(f, i) for f, i in expected if i % 7 != 3]
    assert [g[0] for g in got] == list(range(len(kept)))
    assert [(g[1], g[2]) for g in got] == kept


def test_integer_columns_parse_like_pandas(spark, tmp_path):
    text = ("Banner,,\nCrash ID,Year,Age\n"
            "20231234567890123,2023,35\n2,2023.0,-9\n3,1e3,\n4,x,7\n")
    p = tmp_path / "s.csv"
    p.write_text(text)
    df = read_sheet_csv(spark, str(p), "`Crash ID` bigint, Year int, Age int", header="Crash ID,Year,Age",
                        integers=("Crash ID", "Year", "Age"))
    got = [(r["Crash ID"], r["Year"], r["Age"]) for r in df.orderBy("_row").collect()]
    assert got == [(20231234567890123, 2023, 35), (2, 2023, -9), (3, 1000, None), (4, None, 7)]
