"""Source divergences against plain loops over words."""

import random
import re
from collections import Counter, defaultdict

import numpy as np

from starloom.llm import divergence

UPPER = {ord(c): c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"}


def plain(rows, min_docs=10, top=10):
    groups, langs, docs = defaultdict(Counter), defaultdict(Counter), defaultdict(Counter)
    for text, lang, source in rows:
        lang, source = lang or "", source or ""
        terms = [t.translate(UPPER) for t in re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", text or "")]
        groups[lang, source].update(terms)
        langs[lang].update(terms)
        docs[lang].update(set(terms))
    kept = {lang: sorted(t for t, n in docs[lang].items() if n >= min_docs) for lang in langs}

    def chance(counts, lang):
        total, v = sum(counts[t] for t in kept[lang]), len(kept[lang])
        return {t: 1 + 10**9 * (counts[t] + 2) // (total + 2 * v) for t in kept[lang]}

    p = {g: chance(c, g[0]) for g, c in groups.items()}
    q = {lang: chance(c, lang) for lang, c in langs.items()}
    f = lambda x, y: (x - y) ** 2 // (x + y)
    out = []
    for (lang, source), own in p.items():
        pairs = [(b, sum(f(own[t], x[t]) for t in own)) for (a, b), x in p.items() if a == lang and b != source]
        terms = [(t, f(own[t], q[lang][t])) for t in own if groups[lang, source][t] and own[t] > q[lang][t]]
        for part, found, most in (("pair", pairs, len(pairs)), ("term", terms, top)):
            found.sort(key=lambda x: (-x[1], x[0].encode()))
            out += [(lang, source, part, *x, i + 1) for i, x in enumerate(found[:most])]
    return sorted(out)


def ours(df, **kw):
    return sorted(tuple(r) for r in divergence.divergences(df, divergence.Settings(**kw)).collect())


def table(spark, rows):
    return spark.createDataFrame(rows, "text string, lang string, source string")


def made(seed, n=400):
    rnd = random.Random(seed)
    words = [rnd.choice(["Ab", "cD", "é", "Éa", "zz9zz", "k_k", "日本", "q"]) + rnd.choice("abcXYZ-\x7f\x00") for _ in range(60)]
    rows = []
    for _ in range(n):
        source = rnd.choice([None, "", "a", "b", "b", "b", "b", "é", "Z"])
        own = rnd.sample(words, 12) if source == "a" else words
        rows.append((" ".join(rnd.choices(own, k=rnd.randrange(30))), rnd.choice(["en", "en", "de", None, ""]), source))
    return rows


def test_equals_plain_loops(spark):
    rows = made(3) + [(None, "en", "only null"), ("", "fr", "x"), ("alone", "fr", "y"), ("alone", "fr", None), ("1 2 3", "it", "z")]
    rows += [rows[5]] * 20  # repeated rows
    want = plain(rows)
    assert ours(table(spark, rows).repartition(5)) == want
    # many small shards, and other columns with the names that the operator uses itself
    more = table(spark, rows).selectExpr("*", "1 as row", "2 as n", "3 as docs", "4 as term", "5 as shard", "6 as kept")
    assert ours(more, shard_rows=40) == want


def test_small_blocks_and_merges(spark, monkeypatch):
    rows = made(4, 150)
    tables = divergence.term_counts
    monkeypatch.setattr(divergence, "CHUNK", 64)  # most texts are cut
    import pyarrow as pa
    texts = pa.array([r[0] for r in rows])
    got = Counter()
    for found in divergence._chunks(texts):
        for r in found.to_pylist():
            assert (r["row"], r["term"]) not in got
            got[r["row"], r["term"]] = r["n"]
    want = Counter()
    for i, r in enumerate(rows):
        want.update((i, t.translate(UPPER)) for t in re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", r[0]))
    assert got == want and tables is divergence.term_counts
    monkeypatch.setattr(divergence, "HELD", 50)
    batch = pa.record_batch({"lang": ["en"] * len(rows), "source": [r[2] or "" for r in rows], "text": texts})
    total, docs = Counter(), Counter()
    for part in divergence._counted(iter([batch, batch])):
        for r in part.to_pylist():
            total[r["source"], r["term"]] += r["n"]
            docs[r["term"]] += r["docs"]
    assert {s for s, _ in total} == {r[2] or "" for r in rows}
    for source in {r[2] or "" for r in rows}:
        for t in {t for _, t in want}:
            assert total[source, t] == 2 * sum(n for (i, x), n in want.items() if x == t and (rows[i][2] or "") == source)
    assert docs["ab"] == 2 * sum(1 for _, t in want if t == "ab")


def test_long_text_and_empty_table(spark):
    long = "Word other\n" * 200_000 + "tail"  # two million characters
    rows = [(long, "en", "a")] + [("word tail", "en", "b")] * 9 + [("word", "en", "c")]
    assert ours(table(spark, rows)) == plain(rows)
    assert ours(table(spark, rows).limit(0)) == []


def test_wide_counts_stay_exact():
    n = np.array([0, 5, 10**10, 4 * 10**18])
    total = int(sum(n.tolist()))
    assert divergence.chances(n, total, 4).tolist() == [1 + 10**9 * (int(x) + 2) // (total + 8) for x in n]
