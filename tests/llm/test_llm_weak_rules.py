"""Measures against plain loops, the estimate against one over single rows, and the verdict."""

import math
import random
import re
from collections import Counter

import pytest

from starloom.llm import queries, weak_rules

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain(text):
    text = text or ""
    words = WORD.findall(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    windows = Counter(zip(words, words[1:], words[2:]))
    repeated = {i + k for i in range(len(words) - 2) if windows[tuple(words[i:i + 3])] > 1 for k in range(3)}
    return {"n_words": len(words), "word_chars": sum(map(len, words)), "n_symbols": len(re.findall(r"[#*$%&|<>]", text)),
            "n_dup_lines": sum(x in lines[:i] for i, x in enumerate(lines)), "n_repeat_words": len(repeated)}


def texts(seed, n=150):
    rnd = random.Random(seed)
    parts = ["a", "b", "ab", "é", "日本語", "x#y", "$", "|", "A!", " ", " ", "\x85", "end.", "\x1f", "\x1c"]
    gaps = [" ", "  ", "\n", "\n\n", "\t", "\r\n", "\x0b", "\x0c", " \n "]
    made = ["".join(rnd.choice(parts) + rnd.choice(gaps) for _ in range(rnd.randrange(60))) for _ in range(n)]
    return made + [None, "", " ", "\n\n", "a", "a a", "a a a", "a a a a", "\na\nb\na\n", "x" * 3000, "a\nb\na \nb"]


def rows_of(spark, values, **kw):
    df = spark.createDataFrame(list(enumerate(values)), "doc_id long, text string")
    return [r.asDict() for r in weak_rules.judge(df, **kw).orderBy("doc_id").collect()]


def test_measures_equal_plain_loops(spark, monkeypatch):
    values = texts(1)
    for found, text in zip(rows_of(spark, values), values, strict=True):
        want = plain(text)
        assert {k: found[k] for k in want} == want, text
        failed = want["n_words"] < 50 or 100 * want["n_repeat_words"] > 50 * want["n_words"]
        assert found["base_failed"] == failed and (not failed or not found["kept"]) and 0 <= found["score"] <= 1
        assert found["text"] == text
    data = [(t or "").encode() for t in values]
    whole = weak_rules.measured(data)
    for i, one in enumerate(data):  # texts do not touch each other
        assert {m: v[0] for m, v in weak_rules.measured([one]).items()} == {m: v[i] for m, v in whole.items()}


def test_other_measures():
    text = "Ab, CD!\nÉé <x> 12 34\n  \nend."
    found = {m: v[0] for m, v in weak_rules.measured([text.encode()]).items()}
    assert found["n_lines"] == 3 and found["n_ended_lines"] == 2 and found["n_capitals"] == 3
    assert found["n_letters"] == 4 + 2 + 1 + 3 and found["n_letter_words"] == 5 and found["n_symbol_words"] == 1
    assert found["n_exclaims"] == 1


def test_many_distinct_words():
    words = [str(i) for i in range(1_100_000)]  # more than fit three to a 63-bit number
    text = " ".join(words + words[:3] + ["x"] + words[10:14]).encode()
    assert weak_rules._repeats(text) == 3 * 2 + 4 * 2


def by_rows(votes, prior):
    """The same estimate, a loop over single texts."""
    n_rules, good = len(votes[0]), prior.good
    a, b = [prior.on_good] * n_rules, [prior.on_bad] * n_rules
    held = prior.strength * len(votes) + prior.least
    for _ in range(500):
        posts = []
        for v in votes:
            odds = math.log(good / (1 - good))
            for x, p, q in zip(v, a, b):
                odds += math.log(p / (1 - q)) if x == 1 else math.log((1 - p) / q) if x == 0 else 0
            posts.append(1 / (1 + math.exp(-odds)))
        new_a, new_b = [], []
        for r in range(n_rules):
            up = sum(p for p, v in zip(posts, votes) if v[r] >= 0)
            down = sum(1 - p for p, v in zip(posts, votes) if v[r] >= 0)
            new_a.append((sum(p for p, v in zip(posts, votes) if v[r] == 1) + held * prior.on_good) / (up + held))
            new_b.append((sum(1 - p for p, v in zip(posts, votes) if v[r] == 0) + held * prior.on_bad) / (down + held))
        good = (sum(posts) + held * prior.good) / (len(votes) + held)
        done = max(map(abs, [x - y for x, y in zip(new_a + new_b, a + b)])) < 1e-9
        a, b = new_a, new_b
        if done:
            break
    return good, a, b


def test_estimate_equals_loop_over_rows():
    rnd = random.Random(3)
    votes = [[rnd.choice([-1, 1, 1]) if k else rnd.choice([0, 0, 1, -1]) for _ in range(4)]
             for k in (rnd.random() < 0.7 for _ in range(300))]
    counts = Counter(sum(3 ** i * (x + 1) for i, x in enumerate(v)) for v in votes)
    prior = weak_rules.Prior()
    model = weak_rules.estimate(counts, 4, prior)
    good, a, b = by_rows(votes, prior)
    assert model.good == pytest.approx(good, abs=1e-6)
    assert model.on_good == pytest.approx(a, abs=1e-6) and model.on_bad == pytest.approx(b, abs=1e-6)
    assert weak_rules.estimate({}, 4, prior) == weak_rules.Model(0.8, (0.95,) * 4, (0.3,) * 4)


def good_text(rnd, n=80):
    return "\n".join(" ".join(rnd.choice(["river", "stone", "under", "a", "bright", "window"]) + str(rnd.randrange(99))
                              for _ in range(9)) + "." for _ in range(n // 9))


def test_verdict_and_hot_copies(spark):
    rnd = random.Random(4)
    good = [good_text(rnd) for _ in range(80)]
    junk = [" ".join(w + "***" for w in good_text(rnd).split()) for _ in range(20)]
    odd = good_text(rnd).replace(".", "")  # no line has an end: one bad vote
    for copies in (1, 60):
        found = rows_of(spark, good + junk + [odd] * copies)
        kept = [r["kept"] for r in found]
        assert all(kept[:80]) and not any(kept[80:100]) and all(kept[100:])


def test_columns_and_empty_table(spark):
    df = spark.createDataFrame([(1, "a b", 7, "s", 0.5, None), (1, "a b", 7, "s", 0.5, None)],
                               "doc_id long, text string, n_words long, votes string, score double, _x int")
    found = weak_rules.judge(df)
    assert found.count() == 2 and set(df.columns) <= set(found.columns) and len(set(found.columns)) == len(found.columns)
    assert found.select("n_words", "votes").distinct().collect() == [(2, "s")]
    assert weak_rules.judge(df.limit(0), ["doc_id"]).collect() == []


def test_query_on_labels(spark):
    base = "/root/testdata/sf0.01"
    found = queries.op11_weak_rules(spark, base)
    assert found.columns[:8] == ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                                 "base_failed", "kept"]
    rows = found.join(spark.read.parquet(f"{base}/labels.parquet"), "doc_id").where("not base_failed").collect()
    assert all(r.kept for r in rows if r.quality == 1)
    assert sum(not r.kept for r in rows if r.quality == 0) > 0.95 * sum(r.quality == 0 for r in rows)
