"""NN-descent and MaxScore against brute force and the oracle SQL."""

import duckdb
import numpy as np
import pandas as pd
import pytest

from starloom.llm import maxscore, nn_descent, queries

BASE = "/root/testdata/sf0.001"


def brute_links(vectors, threshold=0.9):
    units = {}
    for i, v in vectors.items():
        if v and all(x is not None and np.isfinite(x) for x in v) and any(v):
            u = np.array(v, float)
            u = u / np.abs(u).max()
            units[i] = u / np.linalg.norm(u)
    links = {i: [j for j in units if j != i and len(units[i]) == len(units[j]) and units[i] @ units[j] >= threshold]
             if i in units else [] for i in vectors}
    out = {}
    for i in vectors:
        seen, todo = {i}, [i]
        while todo:
            for j in links[todo.pop()]:
                if j not in seen:
                    seen.add(j)
                    todo.append(j)
        out[i] = (len(links[i]), min(seen), min(seen) == i)
    return out


def test_near_vectors_edge_cases(spark):
    rng = np.random.default_rng(2)
    vectors = {i: rng.standard_normal(8).tolist() for i in range(60)}
    for i in range(100, 140):  # a saturated group: more links than a list holds
        vectors[i] = (np.ones(8) + 0.05 * rng.standard_normal(8)).tolist()
    vectors |= {200: None, 201: [], 202: [0.0] * 8, 203: [1.0] * 7 + [None], 204: [float("nan")] * 8, 205: [float("inf")] * 8,
                206: vectors[3], 207: [2 * x for x in vectors[3]], 208: [1.0, 1.0], 209: [1.0, 1.01], 210: [1e300] * 8,
                211: [-x for x in vectors[3]]}
    df = spark.createDataFrame([(i, v, 0, 0) for i, v in vectors.items()], "vec_id long, embedding array<double>, rep int, dim int")
    got, recall = nn_descent.near_vectors(df)
    assert {r.vec_id: (r.n_links, r.component_id, r.kept) for r in got.collect()} == brute_links(vectors)
    assert recall == 1.0


def test_links_between_tight_groups(spark):
    rng = np.random.default_rng(3)
    base = np.zeros((2, 16))
    base[0, 0], base[1, 0], base[1, 1] = 1, np.cos(0.35), np.sin(0.35)
    vectors = {i: (base[i % 2] + 0.008 * rng.standard_normal(16)).tolist() for i in range(200)}
    vectors |= {300 + i: rng.standard_normal(16).tolist() for i in range(50)}
    want = brute_links(vectors)
    assert all(want[i][:2] == (199, 0) for i in range(200))  # more links than any list, the own group nearest
    df = spark.createDataFrame(list(vectors.items()), "vec_id long, embedding array<double>")
    got, recall = nn_descent.near_vectors(df)
    assert {r.vec_id: (r.n_links, r.component_id, r.kept) for r in got.collect()} == want and recall == 1.0


def test_low_recall_is_seen_beside_a_hot_group_and_compared_in_full(spark):
    rng = np.random.default_rng(4)
    vectors = {i: (np.ones(8) + 0.05 * rng.standard_normal(8)).tolist() for i in range(60)}
    for i in range(100, 140, 2):
        vectors[i] = (5 * rng.standard_normal(8)).tolist()
        vectors[i + 1] = (np.array(vectors[i]) + 0.01).tolist()
    df = spark.createDataFrame(list(vectors.items()), "vec_id long, embedding array<double>")
    units = pd.concat(nn_descent._units(iter([pd.DataFrame(vectors.items(), columns=["vec_id", "embedding"])])))
    reps = spark.createDataFrame([(r.vec_id, int(r.dim), bytearray(r.v64), 1) for r in units.itertuples()],
                                 "rep long, dim int, v64 binary, copies long")
    hot = spark.createDataFrame([(i, 59, 0) for i in range(60)], "rep long, links long, component long")
    assert nn_descent._recall(hot, reps, 0.9, nn_descent.Settings(), 100) < 0.5
    poor = nn_descent.Settings(neighbours=1, tables=1, bucket=3, rounds=0, extra=1, recall=1.1, block=16)
    got, recall = nn_descent.near_vectors(df, settings=poor)
    assert {r.vec_id: (r.n_links, r.component_id, r.kept) for r in got.collect()} == brute_links(vectors) and recall == 1.0


def test_near_vectors_empty_and_repeated(spark):
    empty = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert nn_descent.near_vectors(empty)[0].collect() == []
    rows = [(1, [1.0, 0.0]), (1, [1.0, 0.0]), (2, [1.0, 0.1]), (None, [1.0, 0.0])]
    got, _ = nn_descent.near_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<float>"))
    assert sorted(map(tuple, got.collect())) == [(1, 1, 1, True), (2, 1, 1, False)]


def brute_top(vectors, k):
    whole = {i: np.floor(64 * np.array(v, float)).astype(np.int64) for i, v in vectors.items()
             if v and all(x is not None and np.isfinite(x) for x in v)}
    out = []
    for q in whole:
        if q % 20 == 0:
            scored = sorted((-int(whole[q] @ whole[c]), c) for c in whole if c != q and len(whole[c]) == len(whole[q]))
            out += [(q, n + 1, c, -s) for n, (s, c) in enumerate(scored[:k])]
    return sorted(out)


@pytest.mark.parametrize("settings", [maxscore.Settings(), maxscore.Settings(shard=16, batch=3, share=1.0, probe=1, blocks=2),
                                      maxscore.Settings(shard=1, batch=1, blocks=1)])
def test_top_k_edge_cases(spark, settings):
    rng = np.random.default_rng(5)
    vectors = {i: rng.standard_normal(6).round(1).tolist() for i in range(150)}
    vectors |= {160: None, 180: [0.5] * 5 + [None], 200: [float("inf")] * 6, 220: [0.0] * 6, 240: [1.0], 241: [-1.0],
                260: [1.0, 2.0], 301: vectors[20], 302: vectors[20], -20: vectors[40], 320: [1e6] * 6}
    df = spark.createDataFrame([(i, v, 7) for i, v in vectors.items()], "vec_id long, embedding array<double>, place int")
    got = maxscore.top_k(df, settings=settings)
    assert sorted(map(tuple, got.select("query_id", "rank", "vec_id", "score").collect())) == brute_top(vectors, 20)


def test_top_k_refuses_scores_beyond_64_bits(spark):
    df = spark.createDataFrame([(0, [1e300, 1.0]), (1, [1.0, 1.0])], "vec_id long, embedding array<double>")
    with pytest.raises(Exception, match="do not fit 64 bits"):
        maxscore.top_k(df).collect()
    large = {i: [float((-1) ** i * 2 ** 22 + i), 3.0] for i in range(50)}  # scores about 2^56
    df = spark.createDataFrame([(i, v, "x") for i, v in large.items()] + [(80, [], "y")],
                               "vec_id long, embedding array<double>, shard string")
    assert sorted(map(tuple, maxscore.top_k(df).collect())) == brute_top(large, 20)


def test_top_k_empty_and_repeated(spark):
    empty = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert maxscore.top_k(empty).collect() == []
    rows = [(0, [1.0, 0.0]), (0, [1.0, 0.0]), (3, [1.0, 0.1]), (None, [1.0, 0.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    assert list(map(tuple, maxscore.top_k(df).collect())) == [(0, 1, 3, 4096)]


@pytest.mark.parametrize("name", ["op3_nn_descent", "op6_maxscore"])
def test_driver_table_matches_sql(spark, name):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{BASE}/embeddings.parquet'")
    cur = con.execute(queries.oracle_sql()[name])
    names = [c[0] for c in cur.description]
    assert sorted(map(tuple, queries.queries()[name](spark, BASE).select(*names).collect())) == sorted(cur.fetchall())
