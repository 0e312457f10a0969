"""K5/K6 on seeded bad rows (FIXTURES.md section 5)."""

import pytest

from starloom.operators.quality import IntegrityError, enforce, foreign_key_violations, primary_key_violations


def test_primary_key_duplicates_and_nulls(spark):
    df = spark.createDataFrame([(1,), (2,), (2,), (None,)], "k bigint")
    got = sorted((r.key, r.n_rows) for r in primary_key_violations(df, "k", "t.k").collect())
    assert got == [("2", 2), ("NULL", 1)]


def test_foreign_key_orphans_null_allowed(spark):
    child = spark.createDataFrame([(1,), (5,), (5,), (None,)], "k bigint")
    parent = spark.createDataFrame([(1,), (2,)], "k bigint")
    got = [(r.key, r.n_rows) for r in foreign_key_violations(child, "k", parent, "k").collect()]
    assert got == [("5", 2)]


def test_enforce(spark):
    ok = spark.createDataFrame([(1,), (2,)], "k bigint")
    enforce(primary_key_violations(ok, "k"))
    bad = spark.createDataFrame([(1,), (1,)], "k bigint")
    with pytest.raises(IntegrityError):
        enforce(primary_key_violations(bad, "k"))


LONGS = [0, 1, 63, 64, 127, -1, -64, -65, 2**63 - 1, -2**63, 2**62, -2**62, 10**12]


def _final_plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def test_words_find_what_grouping_finds(spark):
    """Random and extreme numbers, repeats, nulls: the same offenders as counting keys one by one."""
    import random
    from collections import Counter
    rnd = random.Random(5)
    keys = (LONGS + LONGS[::2] + [None] * 3 + [rnd.randrange(-300, 300) for _ in range(200)]
            + [rnd.randrange(-2**63, 2**63) for _ in range(200)])
    parents = rnd.sample([k for k in keys if k is not None], 150) + [None, 5, 5] + list(range(-100, 100))
    child = spark.createDataFrame([(k,) for k in keys], "k bigint").repartition(3)
    parent = spark.createDataFrame([(k,) for k in parents], "k bigint").repartition(2)
    counts = Counter(keys)
    want = sorted(("NULL" if k is None else str(k), n) for k, n in counts.items() if n > 1 or k is None)
    assert sorted((r.key, r.n_rows) for r in primary_key_violations(child, "k").collect()) == want
    want = sorted((str(k), n) for k, n in counts.items() if k is not None and k not in set(parents))
    assert want and sorted((r.key, r.n_rows) for r in foreign_key_violations(child, "k", parent, "k").collect()) == want


@pytest.mark.parametrize("kind", ["tinyint", "smallint", "int", "bigint", "date"])
def test_words_of_every_type(spark, kind):
    from pyspark.sql import functions as F
    cast = F.date_add(F.lit("1969-12-01").cast("date"), F.col("id").cast("int")) if kind == "date" else F.col("id").cast(kind)
    df = spark.range(100).select(cast.alias("k"))
    assert primary_key_violations(df, "k").isEmpty()
    twice = df.unionByName(df.limit(1))
    first = df.first()["k"]
    assert [(r.key, r.n_rows) for r in primary_key_violations(twice, "k").collect()] == [(str(first), 2)]
    some = df.where(F.col("k") != F.lit(first))
    assert [(r.key, r.n_rows) for r in foreign_key_violations(twice, "k", some, "k").collect()] == [(str(first), 2)]
    assert foreign_key_violations(some, "k", twice, "k").isEmpty()


def test_words_of_empty_tables(spark):
    empty = spark.createDataFrame([], "k bigint")
    some = spark.range(3).withColumnRenamed("id", "k")
    assert primary_key_violations(empty, "k").isEmpty() and foreign_key_violations(empty, "k", empty, "k").isEmpty()
    assert foreign_key_violations(empty, "k", some, "k").isEmpty()
    assert sorted(r.key for r in foreign_key_violations(some, "k", empty, "k").collect()) == ["0", "1", "2"]


def test_clean_tables_move_words_alone(spark, tmp_path):
    """Keys in file order: each task's keys fill their words, and no row is read a second time."""
    path = str(tmp_path / "t")
    spark.range(0, 64_000, 1, 4).withColumnRenamed("id", "k").write.parquet(path)
    df = spark.read.parquet(path)
    for report in (primary_key_violations(df, "k"), foreign_key_violations(df, "k", df, "k")):
        final = _final_plan(report).split("== Initial Plan ==")[0]
        assert "isFinalPlan=true" in final
        assert "Exchange hashpartitioning(key" not in final and "Exchange hashpartitioning(__k" not in final


def test_texts_and_several_columns_are_grouped(spark):
    df = spark.createDataFrame([("a", 1), ("a", 2), ("b", 1), ("b", 1), (None, 1)], "s string, n int")
    assert sorted((r.key, r.n_rows) for r in primary_key_violations(df, "s").collect()) == [("NULL", 1), ("a", 2), ("b", 2)]
    assert sorted((r.key, r.n_rows) for r in primary_key_violations(df, ["s", "n"]).collect()) == [("NULL|1", 1), ("b|1", 2)]
    assert [(r.key, r.n_rows) for r in foreign_key_violations(df, "s", df.where("s = 'a'"), "s").collect()] == [("b", 2)]
