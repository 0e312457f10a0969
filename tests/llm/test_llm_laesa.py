"""Clustering with a pivot table against a plain loop over all centroids."""

import hashlib
import math
import random

import numpy as np
import pytest

from starloom.llm import laesa, queries


def plain(rows, k, rounds, dim, scale):
    kept = [(i, [math.floor(scale * x) for x in v]) for i, v in rows
            if v is not None and len(v) == dim and all(x is not None and math.isfinite(x) for x in v)]
    by_hash = sorted(kept, key=lambda r: (r[0] is None, hashlib.sha256(f"2:{r[0]}".encode()).hexdigest(), r[1]))
    cents = [list(v) for _, v in by_hash[:k]]
    def assign():
        return [min((sum((a - b) ** 2 for a, b in zip(v, c)), j) for j, c in enumerate(cents)) for _, v in kept]
    for _ in range(rounds):
        found = assign()
        for j in range(len(cents)):
            own = [v for (_, v), (_, c) in zip(kept, found) if c == j]
            if own:
                cents[j] = [sum(col) // len(own) for col in zip(*own)]
    found = assign()
    inertia = [sum(d for d, c in found if c == j) for j in range(len(cents))]
    return sorted(((i, c, d, inertia[c], sum(inertia), tuple(cents[c])) for (i, _), (d, c) in zip(kept, found)), key=repr)


def ours(df, **kw):
    return sorted((tuple(r[:5]) + (tuple(r["centroid"]),) for r in laesa.cluster(df, **kw).collect()), key=repr)


def test_equals_plain_loop(spark):
    rnd = random.Random(5)
    rows = [(i, [rnd.gauss(i % 7, 0.4) * (-1) ** (i % 3) for _ in range(6)]) for i in range(300)]
    rows += [(7, rows[7][1]), (300, rows[7][1]), (None, [0.5] * 6), (301, [0.25] * 6), (302, [0.25] * 6)]  # repeats, ties
    rows += [(303, None), (304, []), (305, [1.0] * 5), (306, [1.0] * 7), (307, [None] + [1.0] * 5),
             (308, [float("nan")] * 6), (309, [float("inf")] * 6), (310, [0.0] * 6)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(5)
    want = plain(rows, 9, 5, 6, 256)
    assert ours(df, k=9, dim=6, pivots=4) == want
    # other columns, clashing names included, are ignored; the split does not matter
    more = df.selectExpr("vec_id", "embedding", "1 as v", "2 as far", "'x' as cluster").coalesce(1)
    assert ours(more, k=9, dim=6, pivots=4) == want
    assert ours(df, k=9, dim=6, pivots=1) == want


def test_hot_vector_empty_clusters_and_few_rows(spark):
    rows = [(i, [1.0, 2.0]) for i in range(60)] + [(60, [5.0, 5.0]), (61, [-3.0, 0.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    assert ours(df, k=8, dim=2) == plain(rows, 8, 5, 2, 256)  # equal centroids: all but the first stay empty
    assert ours(df.limit(1), k=8, dim=2) == plain(rows[:1], 8, 5, 2, 256)
    assert ours(df.limit(0), k=8, dim=2) == []
    assert [c.name for c in laesa.cluster(df.limit(0)).schema] == [c.name for c in laesa.cluster(df, dim=2).schema]


def test_wide_components_fail(spark):
    df = spark.createDataFrame([(1, [1e300, 0.0]), (2, [1.0, 2.0])], "vec_id long, embedding array<double>")
    with pytest.raises(Exception, match="beyond"):
        laesa.cluster(df, dim=2).collect()


def test_wide_integers_stay_exact():
    rnd = np.random.default_rng(1)
    x = rnd.integers(-laesa.WIDEST, laesa.WIDEST, (200, 64))
    c, p = x[:20] + rnd.integers(-3, 4, (20, 64)), x[30:34]
    who, best, _ = laesa.nearest(x, laesa.to_pivots(x, p), c, laesa.to_pivots(c, p))
    all_ = np.array([[sum((int(a) - int(b)) ** 2 for a, b in zip(u, w)) for w in c] for u in x[:40]], dtype=object)
    assert who[:40].tolist() == [min(range(20), key=lambda j: (r[j], j)) for r in all_]
    assert best[:40].tolist() == [min(r) for r in all_]


def test_pivots_spare_distances():
    rnd = np.random.default_rng(2)
    centres = rnd.integers(-5000, 5000, (20, 8))
    x = centres[rnd.integers(0, 20, 2000)] + rnd.integers(-50, 50, (2000, 8))
    p = laesa.farthest_first(x[:256], 16)
    exact = laesa.nearest(x, laesa.to_pivots(x, p), centres, laesa.to_pivots(centres, p))[2]
    assert exact < 2 * len(x)  # of 20 a row


def test_query_columns(spark):
    df = queries.op13_laesa_clusters(spark, "/root/testdata/sf0.001")
    assert df.dtypes == [("vec_id", "bigint"), ("cluster", "int"), ("distance", "bigint"), ("cluster_inertia", "bigint"),
                         ("inertia", "bigint"), ("centroid_sha256", "string")]
