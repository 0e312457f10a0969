"""The driver contract: every registered query equals its DuckDB oracle on
the smallest driver data (row count, column names, values)."""

import math

import duckdb
import pytest

import __spark_entry__ as entry
from starloom.plans import catalog, oracle

BASE = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem".split()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{BASE}/{t}.parquet')")
    return c


def _norm(v):
    if isinstance(v, float):
        return "inf" if math.isinf(v) else repr(round(v, 9))
    return repr(v)


def _bag(rows, cols, order):
    idx = [cols.index(c) for c in order]
    return sorted(tuple(_norm(r[i]) for i in idx) for r in rows)


@pytest.mark.parametrize("name", sorted(oracle.oracle_sql()))
def test_query_matches_oracle(spark, con, name):
    df = entry.queries()[name](spark, BASE)
    srows = [tuple(r) for r in df.collect()]
    cur = con.execute(entry.oracle_sql()[name])
    ocols = [d[0] for d in cur.description]
    orows = cur.fetchall()
    assert sorted(df.columns) == sorted(ocols)
    order = sorted(ocols)
    assert _bag(srows, df.columns, order) == _bag(orows, ocols, order)


def test_every_query_has_an_oracle():
    assert set(catalog.queries()) == set(oracle.oracle_sql())
    assert set(catalog.queries()) <= set(entry.queries())
    assert set(entry.oracle_sql()) <= set(entry.queries())


#: Statements whose oracle names a total order of the rows.
ORDERED = {"m6_top_rules": None, "m7_sample_itemsets": None, "s5_sql_rank": ["year", "rank_num", "lga_name"],
           "s5_sql_cube": ["state_name", "is_weekend"], "s5_sql_numeric": ["gender"]}


@pytest.mark.parametrize("name", sorted(ORDERED))
def test_ordered_results_come_in_order(spark, con, name):
    df = entry.queries()[name](spark, BASE)
    got = [tuple(map(_norm, r)) for r in df.collect()]
    cur = con.execute(entry.oracle_sql()[name] + (f" ORDER BY {', '.join(ORDERED[name])}" if ORDERED[name] else ""))
    at = [[d[0] for d in cur.description].index(c) for c in df.columns]
    assert got == [tuple(_norm(r[i]) for i in at) for r in cur.fetchall()]


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.columns == ["year", "lga_name", "total_fatalities"]
    assert df.count() >= 0


@pytest.mark.parametrize("name", ["q1_top_lga", "q3_weekday_time", "q5_vehicle_types", "q6_dwelling_rate",
                                  "t1_fact_fatalities", "d3_dim_lga", "k6_foreign_keys", "m4_rules"])
def test_query_matches_oracle_without_broadcasts(spark, con, name):
    """The plans used at scale (no automatic broadcasts) give the same rows."""
    keys = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    old = {k: spark.conf.get(k, None) for k in keys}
    try:
        for k in keys:
            spark.conf.set(k, "-1")
        df = entry.queries()[name](spark, BASE)
        srows = [tuple(r) for r in df.collect()]
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)
    cur = con.execute(entry.oracle_sql()[name])
    ocols = [d[0] for d in cur.description]
    order = sorted(ocols)
    assert _bag(srows, df.columns, order) == _bag(cur.fetchall(), ocols, order)
