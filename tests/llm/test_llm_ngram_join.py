"""N-gram Jaccard join against brute force, and its edge cases."""

import itertools
import random
import re
from math import comb

import duckdb
import pytest

from starloom.llm import ngram_join as nj
from starloom.llm import queries
from starloom.llm.wordhash import shingle_sets

BASE = "/root/testdata/sf0.001"


def brute(texts):
    """{id: (class_id, n_links, component_id)} of {id: text}."""
    sets = {}
    for i, text in texts.items():
        w = re.findall("[0-9a-z\x80-\U0010ffff]+", (text or "").lower())
        sets[i] = {tuple(w[k:k + 5]) for k in range(max(1, len(w) - 4))} if w else set()
    links = {i: set() for i in texts}
    for a, b in itertools.combinations(texts, 2):
        both = len(sets[a] & sets[b])
        if both and 5 * both >= 4 * (len(sets[a]) + len(sets[b]) - both):
            links[a].add(b)
            links[b].add(a)
    out = {}
    for i in texts:
        seen, todo = {i}, [i]
        while todo:
            for j in links[todo.pop()] - seen:
                seen.add(j)
                todo.append(j)
        same = [j for j in texts if sets[j] == sets[i] and sets[i]] or [i]
        out[i] = (min(same), len(links[i]), min(seen))
    return out


def got(df):
    return {r.doc_id: (r.class_id, r.n_links, r.component_id) for r in df.collect()}


def test_edge_cases(spark):
    rnd = random.Random(4)
    words = [f"w{k}" for k in range(400)]
    base = [rnd.choice(words) for _ in range(100)]
    near = base[:40] + ["changed"] + base[41:]
    far = base[:50] + [rnd.choice(words) for _ in range(50)]
    texts = {1: " ".join(base), 2: " ".join(base).upper() + "!!", 3: " ".join(near), 4: " ".join(far), 5: None, 6: "",
             7: " ,.; ", 8: "one two", 9: "One, two.", 10: "one", 11: " ".join(base * 300), 12: "é ü ß 漢字 x",
             13: "é ü ß 漢字 x"}
    df = spark.createDataFrame([(i, t, "x", 1) for i, t in texts.items()], "doc_id long, text string, sig string, rep int")
    result = nj.near_duplicates(df)
    assert got(result) == brute(texts)
    assert {r.doc_id for r in result.where("kept").collect()} == {i for i, v in brute(texts).items() if v[2] == i}
    kept = nj.keep_one(df)
    assert kept.columns == df.columns
    assert {r.doc_id for r in kept.collect()} == {i for i, v in brute(texts).items() if v[2] == i}


def test_empty_table_and_repeated_ids(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert nj.near_duplicates(empty).collect() == []
    rows = [(1, "a b c d e f"), (1, "b b c d e f"), (2, "a b c d e f"), (None, "a b c d e f"), (3, "zz")]
    twice = spark.createDataFrame(rows, "doc_id long, text string")
    assert got(nj.near_duplicates(twice)) == {1: (1, 1, 1), 2: (1, 1, 1), 3: (3, 0, 3)}


def test_group_of_near_copies_larger_than_a_block(spark):
    """Every pair of a large group of near copies counts, in blocks."""
    rnd = random.Random(8)
    base = [f"w{rnd.randrange(5000)}" for _ in range(130)]
    texts = {}
    for i in range(nj.BLOCK + 60):
        w = list(base)
        w[rnd.randrange(130)] = f"x{i}"
        texts[i] = " ".join(w)
    texts[9999] = texts[5]
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    assert got(nj.near_duplicates(df)) == brute(texts)


def test_driver_table_matches_sql(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{BASE}/documents.parquet'")
    cur = con.execute(queries.oracle_sql()["op1_ngram_jaccard"])
    names = [c[0] for c in cur.description]
    df = queries.queries()["op1_ngram_jaccard"](spark, BASE).select(*names)
    assert sorted(map(tuple, df.collect())) == sorted(cur.fetchall())


def test_pruning_bounds():
    """The posterior by integration equals the binomial tail, and the bound is the
    least count that reaches the tolerance."""
    need = nj.least_matches(0.8, 1e-5)
    for n, m in need.items():
        def above(k):
            steps = 4000
            xs = [(s + 0.5) / steps for s in range(steps)]
            dens = [comb(n, k) * x**k * (1 - x) ** (n - k) for x in xs]
            return sum(d for x, d in zip(xs, dens) if x >= 0.8) / sum(dens)
        assert above(m) >= 0.9e-5
        assert m == 0 or above(m - 1) < 1.1e-5


def test_signature_estimates_similarity():
    rnd = random.Random(1)
    words = [f"w{k}" for k in range(3000)]
    a = [rnd.choice(words) for _ in range(600)]
    b = a[:500] + [rnd.choice(words) for _ in range(100)]
    x, y = shingle_sets([" ".join(a), " ".join(b)])
    true = len(set(x) & set(y)) / len(set(x) | set(y))
    assert abs((nj.signature(x) == nj.signature(y)).mean() - true) < 0.15


@pytest.mark.parametrize("text", [None, "", "...", "a", "a b c d", "a b c d e", "A  b\nc\td,e f"])
def test_shingle_counts(text):
    n = len(re.findall(r"\w+", text or ""))
    (s,) = shingle_sets([text])
    assert len(s) == (0 if n == 0 else max(1, n - 4))
