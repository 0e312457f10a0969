"""Staged loads: a load that fails leaves the warehouse that was there."""

import os
import shutil

import pytest

from starloom.operators.quality import IntegrityError, enforce, primary_key_violations
from starloom.plans import etl
from starloom.sinks.tables import LOADS, loads, open_warehouse, table_prefix, write_warehouse

from tests.test_jobs import exported  # noqa: F401  (fixture)

NAMES = ("dim_event", "dim_date")


def _tables(spark, ids, dates=("2020-01-01",)):
    return {"dim_event": spark.createDataFrame([(i, f"e{i}") for i in ids], "crash_id bigint, event string"),
            "dim_date": spark.createDataFrame([(d,) for d in dates], "date_id string")}


def _unique(loaded):
    enforce(primary_key_violations(loaded["dim_event"], "crash_id"))


def _ids(spark, root):
    return sorted(r.crash_id for r in open_warehouse(spark, root, NAMES)["dim_event"].collect())


def _catalog(spark, root):
    return [t.name for t in spark.catalog.listTables() if t.name.startswith(table_prefix(root))]


@pytest.mark.parametrize("buckets", [0, 3])
def test_refused_load_leaves_the_one_before(spark, tmp_path, buckets):
    root = str(tmp_path / "w")
    write_warehouse(spark, _tables(spark, [1, 2]), root, buckets, check=_unique)
    before = sorted(os.listdir(root))
    with pytest.raises(IntegrityError):
        write_warehouse(spark, _tables(spark, [3, 3]), root, buckets, check=_unique)
    assert _ids(spark, root) == [1, 2]
    assert sorted(os.listdir(root)) == before
    assert len(_catalog(spark, root)) == (1 if buckets else 0)


def test_failed_write_leaves_the_one_before(spark, tmp_path):
    root = str(tmp_path / "w")
    write_warehouse(spark, _tables(spark, [1, 2]), root, 2)
    broken = _tables(spark, [5])
    broken["dim_date"] = broken["dim_date"].selectExpr("raise_error('no dates') AS date_id")
    with pytest.raises(Exception, match="no dates"):
        write_warehouse(spark, broken, root, 2)

    def unbuilt():
        raise RuntimeError("not built")

    with pytest.raises(RuntimeError, match="not built"):
        write_warehouse(spark, {**_tables(spark, [6]), "dim_date": unbuilt}, root, 2)
    assert _ids(spark, root) == [1, 2]
    assert len(loads(spark, root)) == 1


def test_nothing_loaded(spark, tmp_path):
    root = str(tmp_path / "w")
    with pytest.raises(IntegrityError):
        write_warehouse(spark, _tables(spark, [3, 3]), root, 2, check=_unique)
    assert loads(spark, root) == [] and _catalog(spark, root) == []
    with pytest.raises(FileNotFoundError):
        open_warehouse(spark, root, NAMES)


def test_open_reader_survives_one_load(spark, tmp_path):
    """The replaced load keeps its files until the next load, not longer; an empty load is a load."""
    root = str(tmp_path / "w")
    write_warehouse(spark, _tables(spark, [1, 2]), root, 2)
    reader = open_warehouse(spark, root, NAMES)["dim_event"]
    write_warehouse(spark, _tables(spark, [7, 8, 9]), root, 4)
    assert reader.count() == 2
    opened = open_warehouse(spark, root, NAMES)
    assert _ids(spark, root) == [7, 8, 9] and opened.buckets == 4
    write_warehouse(spark, _tables(spark, []), root, 2, check=_unique)
    assert _ids(spark, root) == []
    done = loads(spark, root)
    assert [r.version for r in done] == [2, 1, 0]
    assert sorted(os.listdir(root)) == sorted([LOADS, done[0].load, done[1].load])
    assert len(_catalog(spark, root)) == 1


def test_load_ended_midway_is_not_seen(spark, tmp_path):
    """Files of a load whose driver died before the manifest was written are never read."""
    root = str(tmp_path / "w")
    write_warehouse(spark, _tables(spark, [1]), root, 0)
    half = f"{root}/{'0' * 12}"
    shutil.copytree(f"{root}/{loads(spark, root)[0].load}", half)
    shutil.rmtree(f"{half}/dim_date")
    assert _ids(spark, root) == [1]


def test_etl_keeps_the_warehouse_of_the_run_before(spark, exported, tmp_path):  # noqa: F811
    d = exported
    paths = etl.SheetPaths(str(d / "fat.csv"), str(d / "crash.csv"), str(d / "fcount.csv"), str(d / "ccount.csv"))
    out = str(tmp_path / "out")
    etl.run(spark, paths, out, buckets=2, enforce_keys=False)
    counts = {n: t.count() for n, t in open_warehouse(spark, f"{out}/warehouse").items()}
    lines = (d / "crash.csv").read_text().splitlines()
    (tmp_path / "crash.csv").write_text("\n".join(lines + [lines[5].replace("Area 1", "Area 4")]) + "\n")
    paths.crashes = str(tmp_path / "crash.csv")
    with pytest.raises(IntegrityError):
        etl.run(spark, paths, out, buckets=2)
    assert {n: t.count() for n, t in open_warehouse(spark, f"{out}/warehouse").items()} == counts
