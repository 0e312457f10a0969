"""End-to-end jobs on synthetic exported sheets: banners above the header, a
quoted newline inside a header, labels differing only in case, a dwellings
file with preamble and footer; then the rule job on the processed export."""

import csv
import datetime as dt

import pytest
from pyspark.sql import functions as F

from starloom.plans import etl, rule_job

FAT_HEADER = ["Crash ID", "State", "Year", "Month", "Time of day", "Gender", "Age", "Age Group", "Road User",
              "Bus \nInvolvement", "National Road Type"]
CRASH_HEADER = ["Crash ID", "State", "Year", "Month", "Time", "Time of Day", "National LGA Name 2021",
                "National Remoteness Areas", "Bus Involvement", "Heavy Rigid Truck Involvement",
                "Articulated Truck Involvement", "Speed Limit", "National Road Type", "Christmas Period",
                "Easter Period"]


def _write(path, banner, header, rows):
    with open(path, "w", newline="") as f:
        w = csv.writer(f)
        for i in range(banner):
            w.writerow([f"Banner line {i}"])
        w.writerow(header)
        w.writerows(rows)


@pytest.fixture(scope="module")
def exported(tmp_path_factory):
    d = tmp_path_factory.mktemp("sheets")
    users = ["Driver", "Passenger", "Pedestrian", "Motorcycle rider"]
    fat_rows, crash_rows = [], []
    for c in range(1, 41):
        crash_rows.append([c, "nsw" if c % 3 else "Vic", 2023 if c % 2 else 2022, 1 + c % 12, "10:00",
                           "Day" if c % 4 else "Night", f"Area {c % 5}", "Major Cities", "-9" if c == 7 else "No",
                           "Yes" if c % 6 == 0 else "No", "No", str(40 + (c % 8) * 20), "Local Road",
                           "Yes" if c % 10 == 0 else "No", "No"])
        for k in range(1 + c % 3):
            fat_rows.append([c, "NSW", 2023, 1, "Day", "Male" if (c + k) % 2 else "Female", 20 + c + k,
                             "17_to_25" if c < 5 else "26_to_39", users[(c + k) % 4], "No", "Local Road"])
    _write(d / "fat.csv", 4, FAT_HEADER, fat_rows)
    _write(d / "crash.csv", 4, CRASH_HEADER, crash_rows)
    days = [dt.date(2022, 1, 1) + dt.timedelta(days=i) for i in range(731)]
    _write(d / "fcount.csv", 2, ["Date", "Dayweek", "Number Fatalities"],
           [[x.isoformat(), x.strftime("%A"), i % 3] for i, x in enumerate(days)])
    _write(d / "ccount.csv", 2, ["Date", "Dayweek", "Number of fatal crashes"],
           [[x.isoformat(), x.strftime("%A"), i % 2] for i, x in enumerate(days[:700])])
    (d / "dw.csv").write_text("\n".join(
        ['"t"', "", "", "", "", "", "", '"Default Summation",', "", "", '"LGA (EN)",']
        + [f'"Area {i}",{100 * (i + 1)},' for i in range(5)] + ['"Total",1500,', "", '"src"', "", '"INFO"', "",
                                                                 '"c1"', '"c2"']) + "\n")
    return d


def test_etl_job_end_to_end(spark, exported, tmp_path):
    d = exported
    paths = etl.SheetPaths(str(d / "fat.csv"), str(d / "crash.csv"), str(d / "fcount.csv"), str(d / "ccount.csv"),
                           str(d / "dw.csv"))
    res = etl.run(spark, paths, str(tmp_path / "out"), enforce_keys=True)
    assert set(res.tables) == {"dim_date", "dim_state", "dim_lga", "dim_time", "dim_vehicle", "dim_person",
                               "dim_event", "dim_road", "fact_fatalities", "fact_crashes", "fact_number"}
    from starloom.sinks.tables import read_warehouse
    t = read_warehouse(spark, res.tables)
    assert t["fact_fatalities"].count() == sum(1 + c % 3 for c in range(1, 41))
    assert t["fact_crashes"].count() == 40
    assert {r[0] for r in t["dim_state"].select("state_name").collect()} == {"New South Wales", "Victoria"}
    assert t["dim_lga"].where(F.col("dwelling_count").isNull()).count() == 0
    assert t["fact_number"].count() == 731 and t["dim_date"].count() == 731
    # "Bus \nInvolvement" (fatality copy) collides with the crash copy after cleaning and differs at crash 7
    assert res.decisions and any(res.decisions.values())
    processed = rule_job.read_processed(spark, res.processed["records"])
    assert "Bus Involvement_dup" in processed.columns and "Time of day" not in processed.columns


def test_rule_job_on_processed_export(spark, exported, tmp_path):
    d = exported
    paths = etl.SheetPaths(str(d / "fat.csv"), str(d / "crash.csv"), str(d / "fcount.csv"), str(d / "ccount.csv"))
    res = etl.run(spark, paths, str(tmp_path / "out2"), enforce_keys=False)
    records = rule_job.read_processed(spark, res.processed["records"])
    out = rule_job.run(records, str(tmp_path / "rules"), min_support=0.2)
    if out.written:
        written = spark.read.parquet(str(tmp_path / "rules"))
        assert written.count() == out.rules.count()
        assert out.top.count() <= 5
    else:
        assert out.consequent_items is not None and out.sample_itemsets.count() <= 10


def test_fatality_ids_same_on_both_paths(spark, exported, tmp_path):
    """The shuffle-free ids (dense file ordinal, one-to-one merge) equal the
    general numbering by source position."""
    from starloom.plans import warehouse as wh
    d = exported
    fat_fast = etl.read_exported_sheet(spark, str(d / "fat.csv"), etl.RECORD_TYPES, "Crash ID", dense_order=True)
    fat_slow = etl.read_exported_sheet(spark, str(d / "fat.csv"), etl.RECORD_TYPES, "Crash ID")
    crash = etl.read_exported_sheet(spark, str(d / "crash.csv"), etl.RECORD_TYPES, "Crash ID").drop("_row")
    assert etl.key_is_unique(crash, "Crash ID")
    fast = wh.fact_fatalities(wh.conform_records(fat_fast, crash).frame, ids_from_row=True)
    slow = wh.fact_fatalities(wh.conform_records(fat_slow, crash).frame)
    assert sorted(map(tuple, fast.collect())) == sorted(map(tuple, slow.collect()))


def test_open_warehouse_from_folder_and_sql(spark, exported, tmp_path):
    from starloom.plans import sql_text
    from starloom.sinks.tables import open_warehouse
    d = exported
    paths = etl.SheetPaths(str(d / "fat.csv"), str(d / "crash.csv"), str(d / "fcount.csv"), str(d / "ccount.csv"),
                           str(d / "dw.csv"))
    out = tmp_path / "wh"
    etl.run(spark, paths, str(out), enforce_keys=False)
    t = open_warehouse(spark, str(out / "warehouse"))
    n = sql_text.run_statement(spark, t, 'SELECT COUNT(*) AS n FROM fact_fatalities f '
                                         'JOIN dim_event e ON f.crash_id = e.crash_id WHERE e."Easter Period" = \'No\';')
    assert n.first().n == t["fact_fatalities"].count()


def test_salted_etl_builds_identical_tables(spark, exported, tmp_path):
    from starloom.sinks.tables import read_warehouse
    d = exported
    paths = etl.SheetPaths(str(d / "fat.csv"), str(d / "crash.csv"), str(d / "fcount.csv"), str(d / "ccount.csv"),
                           str(d / "dw.csv"))
    plain = read_warehouse(spark, etl.run(spark, paths, str(tmp_path / "p"), enforce_keys=False).tables)
    salted = read_warehouse(spark, etl.run(spark, paths, str(tmp_path / "s"), enforce_keys=False,
                                           salt_buckets=4).tables)
    for name in plain:
        a = sorted(map(tuple, plain[name].collect()), key=repr)
        b = sorted(map(tuple, salted[name].collect()), key=repr)
        assert a == b, name


def test_etl_rejects_repeated_crash_keys(spark, exported, tmp_path):
    """A crash listed twice with different places breaks the fact key: the
    load raises (as the reference's constraint step fails); without the check
    the general numbering path still gives dense fatality ids."""
    import shutil

    from pyspark.sql import functions as F

    from starloom.operators.quality import IntegrityError
    from starloom.sinks.tables import read_warehouse
    d = tmp_path / "dup"
    d.mkdir()
    for f in ("fat.csv", "fcount.csv", "ccount.csv"):
        shutil.copy(exported / f, d / f)
    lines = (exported / "crash.csv").read_text().splitlines()
    dup = lines[5].replace("Area 1", "Area 4")          # first data row, another LGA
    (d / "crash.csv").write_text("\n".join(lines + [dup]) + "\n")
    paths = etl.SheetPaths(str(d / "fat.csv"), str(d / "crash.csv"), str(d / "fcount.csv"), str(d / "ccount.csv"))
    with pytest.raises(IntegrityError):
        etl.run(spark, paths, str(tmp_path / "out"), enforce_keys=True)
    res = etl.run(spark, paths, str(tmp_path / "out2"), enforce_keys=False)
    ff = read_warehouse(spark, res.tables)["fact_fatalities"]
    n = ff.count()
    r = ff.agg(F.min("fatality_id"), F.max("fatality_id"), F.countDistinct("fatality_id")).first()
    assert tuple(r) == (0, n - 1, n)
