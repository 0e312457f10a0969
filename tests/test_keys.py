"""Dense ids (W3) and keep-first (A6): invariance to partitioning and input
order, agreement with a global window, and a third of all rows being copies."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from starloom.operators.keys import dense_ids, keep_first


def _global(df, order):
    return df.withColumn("gid", F.row_number().over(Window.orderBy(*order)) - 1)


def test_dense_ids_match_global_window(spark):
    df = spark.range(0, 5000).select((F.col("id") * 7919 % 5003).alias("k"), (F.col("id") % 13).alias("v"))
    out = dense_ids(df, ["k", "v"], "rid", num_partitions=7)
    joined = out.join(_global(df, ["k", "v"]), ["k", "v"])
    assert joined.where("rid != gid").count() == 0
    r = out.agg(F.min("rid"), F.max("rid"), F.countDistinct("rid"), F.count("*")).first()
    assert tuple(r) == (0, 4999, 5000, 5000)


def test_dense_ids_invariant_to_partitioning_and_shuffled_input(spark):
    df = spark.range(0, 3000).select((F.col("id") * 31 % 3001).alias("k"))
    a = {r.k: r.rid for r in dense_ids(df, "k", "rid", num_partitions=3).collect()}
    shuffled = df.repartition(11, F.rand(7))
    b = {r.k: r.rid for r in dense_ids(shuffled, "k", "rid", num_partitions=16).collect()}
    assert a == b


def test_dense_ids_split_a_hot_group_of_copies(spark):
    # a third of the rows are one identical row
    hot = spark.range(0, 3000).select(F.lit(42).alias("k"))
    rest = spark.range(0, 6000).select((F.col("id") + 100).alias("k"))
    df = hot.unionByName(rest)
    out = dense_ids(df, "k", "rid", num_partitions=8, break_ties=True)
    ids = out.where("k = 42").select("rid")
    r = ids.agg(F.min("rid"), F.max("rid"), F.count("*")).first()
    assert tuple(r) == (0, 2999, 3000)
    # the copies did not land in a single task: several partitions hold them
    sizes = (df.withColumn("__t", F.monotonically_increasing_id())
             .repartitionByRange(8, "k", "__t").where("k = 42")
             .groupBy(F.spark_partition_id()).count().count())
    assert sizes > 1


def test_keep_first_picks_smallest_row(spark):
    df = spark.createDataFrame([("a", "x", 3), ("a", "y", 1), ("b", "z", 2), ("a", "w", 2)],
                               "name string, val string, _row int")
    got = {r.name: r.val for r in keep_first(df.repartition(3), "name").collect()}
    assert got == {"a": "y", "b": "z"}


def test_keep_first_with_struct_order(spark):
    df = spark.createDataFrame([("a", 1, ("f2", 0, 5)), ("a", 2, ("f1", 9, 9)), ("b", 3, ("f1", 0, 1))],
                               "name string, val int, _row struct<file:string, block:int, pos:int>")
    got = {r.name: r.val for r in keep_first(df, "name").collect()}
    assert got == {"a": 2, "b": 3}


def test_dense_ids_default_partitioning_on_shuffled_input(spark):
    df = (spark.range(0, 20000).select((F.col("id") * 7 % 20011).alias("k"), (F.col("id") % 5).alias("g"))
          .repartition(13, "g"))
    out = dense_ids(df, ["k", "g"], "rid")
    joined = out.join(_global(df, ["k", "g"]), ["k", "g"])
    assert joined.where("rid != gid").count() == 0 and out.count() == 20000
