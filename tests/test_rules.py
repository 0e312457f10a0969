"""Association rules against a brute-force pure-Python reference on a small
fixture (Apriori support, all splits, eight metrics, lift >= 1), plus the
transaction cleaning rules (trap 15-17)."""

import itertools
import math
import random

import pytest
from pyspark.sql import functions as F

from starloom.operators import rules

ATTRS = ("A", "B", "C", "D")


def brute(tx, min_support, max_len):
    n = len(tx)
    counts = {}
    for t in tx:
        for k in range(1, max_len + 1):
            for s in itertools.combinations(sorted(t), k):
                counts[s] = counts.get(s, 0) + 1
    freq = {s: c for s, c in counts.items() if c / n >= min_support}
    out = {}
    for s, c in freq.items():
        if len(s) < 2:
            continue
        for k in range(1, len(s)):
            for a in itertools.combinations(s, k):
                cons = tuple(x for x in s if x not in a)
                ca, cc = freq[a], freq[cons]
                if c * n < ca * cc:
                    continue
                sa, sc, sup = ca / n, cc / n, c / n
                conf = sup / sa
                lev = sup - sa * sc
                conv = math.inf if conf == 1 else (1 - sc) / (1 - conf)
                den = max(sup * (1 - sa), sa * (sc - sup))
                out[(a, cons)] = (sa, sc, sup, conf, conf / sc, lev, conv, 0.0 if den == 0 else lev / den)
    return freq, out


@pytest.fixture(scope="module")
def fixture_tx(spark):
    rnd = random.Random(5)
    vals = {"A": "xyz", "B": "pq", "C": "uvw", "D": "ab"}
    data = []
    for _ in range(400):
        a = rnd.choice(vals["A"])
        b = "p" if a == "x" and rnd.random() < 0.8 else rnd.choice(vals["B"])
        data.append(tuple(f"{k}={b if k == 'B' else rnd.choice(vals[k]) if k != 'A' else a}" for k in ATTRS))
    df = spark.createDataFrame(data, ", ".join(f"{k} string" for k in ATTRS))
    return data, df.withColumn("items", F.array_sort(F.array(*ATTRS)))


@pytest.mark.parametrize("min_support,max_len", [(0.05, 3), (0.1, 2), (0.02, 4)])
def test_itemsets_and_rules_match_brute_force(fixture_tx, min_support, max_len):
    data, tx = fixture_tx
    freq, expected = brute(data, min_support, max_len)
    its = rules.frequent_itemsets(tx, ATTRS, min_support, max_len)
    got_sets = {tuple(r["items"]): r["count"] for r in its.collect()}
    assert got_sets == freq
    rl = rules.association_rules(its)
    got = {(tuple(r.antecedents), tuple(r.consequents)): (
        r["antecedent support"], r["consequent support"], r.support, r.confidence, r.lift, r.leverage,
        r.conviction, r.zhangs_metric) for r in rl.collect()}
    assert set(got) == set(expected)
    for k, v in expected.items():
        for a, b in zip(got[k], v):
            assert (a == b) or abs(a - b) <= 1e-12


def test_multi_item_consequents_exist(fixture_tx):
    _, tx = fixture_tx
    rl = rules.association_rules(rules.frequent_itemsets(tx, ATTRS, 0.05, 3))
    assert rl.where(F.size("consequents") == 2).count() > 0


def test_transactions_cleaning(spark):
    rows = [
        ("Driver", "26_to_39", "Male", "60", "Day", "Highway"),
        ("Driver", "26_to_39", "Male", "61", "Day", "Highway"),
        ("Driver", "26_to_39", "Male", "0", "Day", "Highway"),        # speed 0 -> no bin -> dropped
        ("Driver", "26_to_39", "Male", "201", "Day", "Highway"),      # > 200 -> dropped
        ("Driver", "26_to_39", "Male", "<40", "Day", "Highway"),      # unparseable -> dropped
        ("-9", "26_to_39", "Male", "80", "Day", "Highway"),           # no road user
        ("Driver", "Unknown", "Male", "80", "Day", "Highway"),        # one missing attribute
        ("Pedestrian", "17_to_25", "Female", "200", "Night", "Undetermined"),
    ]
    df = spark.createDataFrame(rows, "`Road User` string, `Age Group` string, Gender string, `Speed Limit` string, "
                                     "`Time of Day` string, `National Road Type` string")
    tx = rules.transactions(df).collect()
    assert [r["Speed Category"] for r in tx] == ["Speed Category=Low", "Speed Category=Medium"]
    assert tx[0]["items"] == sorted(tx[0]["items"])


def test_road_user_filter_and_top(fixture_tx, spark):
    _, tx = fixture_tx
    rl = rules.association_rules(rules.frequent_itemsets(tx, ATTRS, 0.05, 3))
    only_b = rules.road_user_rules(rl, "B=")
    assert only_b.where(~F.exists("consequents", lambda i: i.startswith("B="))).count() == 0
    top = rules.top_rules(only_b, 5).collect()
    lifts = [r.lift for r in top]
    assert len(top) == min(5, only_b.count()) and lifts == sorted(lifts, reverse=True)


def test_itemset_exactly_at_the_support_is_kept(spark):
    """7 of 100 at support 0.07: 0.07 * 100 is above 7 as a double, 7 / 100 is not below 0.07."""
    rows = [("a=x" if i < 7 else f"a={i}",) for i in range(100)]
    tx = spark.createDataFrame(rows, "a string").selectExpr("a", "array(a) AS items")
    got = rules.frequent_itemsets(tx, ("a",), 0.07, 1).collect()
    assert [(r["items"], r["count"], r["total"], r["size"]) for r in got] == [(["a=x"], 7, 100, 1)]


def test_many_attributes_are_counted_exactly(spark):
    names = [f"a{i}" for i in range(14)]  # 469 subsets of up to three
    df = spark.range(40).select(*[F.concat(F.lit(f"{n}="), (F.col("id") % (i + 2)).cast("string")).alias(n)
                                  for i, n in enumerate(names)])
    tx = df.withColumn("items", F.array_sort(F.array(*names)))
    got = {tuple(r["items"]): r["count"] for r in rules.frequent_itemsets(tx, names, 0.25, 3).collect()}
    want = {}
    for r in tx.select("items").collect():
        for k in (1, 2, 3):
            for s in itertools.combinations(r[0], k):
                want[s] = want.get(s, 0) + 1
    assert got == {s: c for s, c in want.items() if c / 40 >= 0.25}


def test_one_hot_refuses_items_outside_the_domain(spark):
    tx = spark.createDataFrame([(["a=1", "b=2"],)], "items array<string>")
    assert rules.one_hot(tx, ["b=2", "a=1", "c=3"]).first().asDict() == {"a=1": True, "b=2": True, "c=3": False}
    with pytest.raises(Exception, match="outside the domain: b=2"):
        rules.one_hot(tx, ["a=1"]).collect()
