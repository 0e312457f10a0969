"""Held-out accuracy and edge cases of the classifiers, and the pipeline."""

import math
import random
import re
import zlib

import numpy as np
import pytest
import zstandard

import corpus_pipeline
from starloom.llm import langid, mixing, quality, queries, toxicity

BASE = "/root/testdata/sf0.01"


def held_out(spark, name, label, folds, held):
    rows = (queries.queries()[name](spark, BASE).join(spark.read.parquet(f"{BASE}/labels.parquet"), "doc_id", "left")).collect()
    docs = spark.read.parquet(f"{BASE}/documents.parquet").count()
    assert len(rows) == docs
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % folds == held)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3)
    return [(r.predicted, r[label]) for r in rows if r.held_out and r[label] is not None]


def test_toxicity_held_out(spark):
    pairs = held_out(spark, "op5_toxicity", "toxic", 4, 2)
    assert np.mean([p == y for p, y in pairs]) > 0.9
    assert np.mean([p for p, y in pairs if y == 0]) < 0.05


def test_quality_held_out(spark):
    pairs = held_out(spark, "op8_quality", "quality", 5, 0)
    assert np.mean([p == y for p, y in pairs]) > 0.93
    assert np.mean([p for p, y in pairs if y == 1]) > 0.97


def test_language_held_out(spark):
    docs = spark.read.parquet(f"{BASE}/documents.parquet").select("doc_id", "lang")
    rows = queries.queries()["op10_language"](spark, BASE).join(docs, "doc_id").collect()
    assert len(rows) == docs.count()
    assert np.mean([r.lang == r.lang_pred for r in rows if r.held_out]) > 0.97
    assert all(0 <= r.score <= 1 for r in rows)


def labelled(spark):
    rnd = random.Random(3)
    words = [f"w{k}" for k in range(300)]
    rows = []
    for i in range(240):
        bad = i % 4 == 0
        text = " ".join(rnd.choice(words) for _ in range(rnd.randrange(5, 60)))
        rows.append((i, text + (" nasty fool" if bad else ""), int(bad)))
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(r[0], r[2]) for r in rows] + [(None, 1), (5, None), (7, 0)], "doc_id long, label int")
    odd = spark.createDataFrame([(1, None, 0), (1, "", 0), (None, "...", 0), (2, "You NASTY fool!", 0), (3, "w1 w2 " * 50_000, 0),
                                 (3, "w1 w2 " * 50_000, 0)], "doc_id long, text string, score int")
    return docs, labels, odd


def test_toxicity_edge_cases(spark):
    docs, labels, odd = labelled(spark)
    at, w, bias = toxicity.fit(docs, labels)
    assert 0 < len(at) < 2000
    got = toxicity.score(odd, (at, w, bias))
    assert got.columns == odd.columns
    p = [r.score for r in got.collect()]
    assert p[0] == p[1] == p[2] < 0.3 < 0.5 < p[3] and p[4] == p[5] < 0.3
    assert toxicity.score(odd.limit(0), (at, w, bias)).collect() == []
    nothing = toxicity.fit(docs.limit(0), labels)
    assert len(nothing[0]) == 0 and {r.score for r in toxicity.score(odd, nothing).collect()} == {0.5}
    again = toxicity.fit(docs, labels)
    assert (again[0] == at).all() and np.allclose(again[1], w)


def test_toxicity_features_stay_inside_texts():
    whole = [set(x.tolist()) for x in toxicity.distinct_features(["a b c", "d e", "", None, "f"], 18)]
    alone = [set(next(toxicity.distinct_features([t], 18)).tolist()) for t in ["a b c", "d e", "", None, "f"]]
    assert whole == alone and [len(x) for x in whole] == [6, 3, 0, 0, 1]


def test_quality_edge_cases(spark):
    docs, labels, odd = labelled(spark)
    model = quality.fit(docs, labels)
    got = quality.score(odd, model)
    assert got.columns == odd.columns
    p = [r.score for r in got.collect()]
    assert all(0 <= x <= 1 for x in p) and p[0] == p[1] and p[4] == p[5]
    assert quality.score(odd.limit(0), model).collect() == []
    untrained = quality.fit(docs.limit(0), labels)
    assert all(0 <= r.score <= 1 for r in quality.score(odd, untrained).collect())


def test_quality_sizes_cover_the_whole_text():
    of = quality.Sizes(b"", b"", quality.Settings(piece=64))
    good, bad, raw = of("ab" * 1000 + "é")
    assert raw == 2002 and good == bad == sum(
        of(("ab" * 1000 + "é").encode()[a:a + 64].decode())[0] for a in range(0, 1984, 64)) + of("ab" * 8 + "é")[0]


@pytest.mark.parametrize("name", ["a", "de"])
def test_bloom_masks_have_no_false_negatives(name):
    rng = np.random.default_rng(1)
    own = {k: rng.integers(0, 1 << 32, 500, np.uint32) for k in ("a", "de", "zz")}
    model = langid.build(own, langid.Settings(bits=14))
    bit = model.names.index(name)
    masks = np.bitwise_and.reduce([model.table[rows, 0] for rows in langid.rows_of(own[name], model.settings)])
    assert ((masks >> np.uint64(bit)) & np.uint64(1)).all()
    other = rng.integers(0, 1 << 32, 20_000, np.uint32)
    masks = np.bitwise_and.reduce([model.table[rows, 0] for rows in langid.rows_of(other, model.settings)])
    assert abs(((masks >> np.uint64(bit)) & np.uint64(1)).mean() - model.false_positives[bit]) < 0.01


def test_language_edge_cases(spark):
    rows = [(i, t, l) for i, (t, l) in enumerate([("the cat sat on the mat with the hat", "en"),
                                                  ("der Hund und die Katze sind müde", "de")] * 20)]
    rows += [(90, "the", None), (91, None, "fr")]
    model = langid.fit(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    assert model.names == ("de", "en")
    odd = [None, "", "123 !?", "the hat", "Die Katze", "漢字 漢字", "the cat " * 100_000, "the hat"]
    df = spark.createDataFrame([(i, t, "x") for i, t in enumerate(odd)], "doc_id long, text string, score string")
    got = langid.identify(df, model)
    assert got.columns == ["doc_id", "text", "score", "lang_pred"]
    found = [(r.lang_pred, r.score) for r in got.orderBy("doc_id").collect()]
    assert [f[0] for f in found] == ["und", "und", "und", "en", "de", "de", "en", "en"]
    assert found[0][1] == found[1][1] == found[5][1] == 0 and found[3] == found[7] and found[6][1] > 0.5
    assert langid.identify(df.limit(0), model).collect() == []
    none = langid.fit(df.limit(0).withColumnRenamed("score", "lang"))
    assert {r.lang_pred for r in langid.identify(df, none).collect()} == {"und"}


def test_grams_of_a_batch_are_those_of_its_texts():
    texts = [b"", b"a", b"ab  cd", "é-ü x".encode(), b"", b"hello, world", b"   "]
    found, at = langid.grams(texts)
    for k, t in enumerate(texts):
        assert found[at[k]:at[k + 1]].tolist() == langid.grams([t])[0].tolist()


def test_pipeline_stages(spark):
    base = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{base}/documents.parquet")
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["quality", "ngram_join", "pii", "mixing", "bpe"]
    path = spark.conf.get("spark.checkpoint.dir")
    ids = {r.doc_id for r in docs.collect()}
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, base)
        if k < 4:
            assert out.columns == docs.columns
        out.write.mode("overwrite").parquet(f"{path}/pipeline-test-{name}")
        held, docs = docs, spark.read.parquet(f"{path}/pipeline-test-{name}")
        now = [r.doc_id for r in docs.collect()]
        assert set(now) <= ids and (k == 3 or len(now) <= held.count())
        ids = set(now)
    assert docs.columns == ["doc_id", "source", "n_tokens", "token_ids"]
    assert all(len(r.token_ids) == r.n_tokens > 0 for r in docs.collect())


def test_mixing_stage_repeats_rows_by_the_targets(spark):
    docs = spark.createDataFrame([(1, "a b c d", "en", "s", 7), (2, "e f " * 40, "en", "t", 160)],
                                 "doc_id long, text string, lang string, source string, n_chars long")
    out = corpus_pipeline.mix_sources(spark, docs, "")
    assert out.columns == list(corpus_pipeline.COLUMNS)
    assert all(r.n_chars == len(r.text) for r in out.collect())
    assert mixing.PASSES == 3 and out.where("doc_id = 1").count() <= 3


def test_quality_equals_a_plain_scorer(spark):
    """Whole texts cut into pieces, each compressed by both dictionaries, one text at a time."""
    docs = spark.read.parquet(f"{BASE}/documents.parquet").select("doc_id", "text")
    model = quality.fit(docs, queries.training_labels(spark, BASE, "quality", 5, 0))
    kinds = [zstandard.ZstdCompressor(level=3, dict_data=zstandard.ZstdCompressionDict(d), write_content_size=False,
                                      write_checksum=False, write_dict_id=False) for d in (model.good, model.bad)]
    for r in quality.score(docs, model).collect():
        data = (r.text or "").encode()
        good, bad = (sum(len(c.compress(data[a:a + 1024])) for a in range(0, len(data), 1024)) for c in kinds)
        x = [1, 20 * (bad - good) / max(bad + good, 1), min(good, bad) / max(len(data), 1), math.log1p(len(data)) / 10]
        odds = sum(a * b for a, b in zip(x, model.weights))
        assert r.score == pytest.approx(1 / (1 + math.exp(-max(-30, min(30, odds)))), abs=1e-9)


def test_quality_learns_from_the_end_of_long_texts(spark):
    rnd = random.Random(6)
    words = ["".join(rnd.choices("abcdefghij", k=rnd.randrange(2, 8))) for _ in range(300)]
    junk = ["".join(rnd.choices("qwxyz#", k=9)) for _ in range(300)]
    rows = []
    for i in range(120):
        good = " ".join(rnd.choices(words, k=600))
        rows.append((i, good + " " + " ".join(rnd.choices(words if i % 2 else junk, k=900)), i % 2))
    df = spark.createDataFrame(rows, "doc_id long, text string, label int")
    model = quality.fit(df.select("doc_id", "text"), df.select("doc_id", "label"))
    for word in junk[:20]:
        assert word.encode() not in model.good
    assert sum(word.encode() in model.bad for word in junk) > 250
    scored = quality.score(df, model).collect()
    assert all((r.score >= 0.5) == bool(r.label) for r in scored)


def test_quality_of_too_few_labels_is_their_share(spark):
    df = spark.createDataFrame([(i, f"text {i}", int(i > 0)) for i in range(4)], "doc_id long, text string, label int")
    model = quality.fit(df.select("doc_id", "text"), df.select("doc_id", "label"))
    assert {round(r.score, 9) for r in quality.score(df, model).collect()} == {round(4 / 6, 9)}
    none = quality.fit(df.select("doc_id", "text"), df.select("doc_id", "label").limit(0))
    assert {r.score for r in quality.score(df, none).collect()} == {0.5}


def test_language_equals_sets_of_grams(spark):
    """Every gram looked up in plain sets, one text at a time. Filters pass some grams that a set
    lacks, so the corrected counts agree but for that share."""
    docs = spark.read.parquet(f"{BASE}/documents.parquet").select("doc_id", "text", "lang")
    model = langid.fit(docs)
    table, names = model.table, model.names
    for r in langid.identify(docs, model).orderBy("doc_id").limit(60).collect():
        letters = re.sub(rb"[^a-z\x80-\xff]+", b" ", b" " + (r.text or "").lower().encode() + b" ")
        grams = [int.from_bytes(letters[i:i + 4], "little") for i in range(len(letters) - 3)]
        counts = []
        for bit in range(len(names)):
            hits = sum(all(int(table[p[0], bit // 64]) >> bit % 64 & 1 for p in langid.rows_of(np.array([g], np.uint32), model.settings))
                       for g in grams)
            fp = float(model.false_positives[bit])
            counts.append(max((hits - len(grams) * fp) / (1 - min(fp, 0.99)), 0))
        if any(counts):
            assert r.lang_pred == names[counts.index(max(counts))]
            assert r.score == pytest.approx(max(counts) / sum(counts), abs=1e-9)


def test_language_keeps_columns_of_any_name(spark):
    df = spark.createDataFrame([(1, "der die das", 5, 6, 7)], ["doc_id", "text", "_language", "_letters", "_made0"])
    model = langid.fit(spark.createDataFrame([(1, "der die das und", "de")], "doc_id long, text string, lang string"))
    assert tuple(langid.identify(df, model).first())[:5] == (1, "der die das", 5, 6, 7)


def test_pipeline_of_an_empty_table(spark, tmp_path):
    for name in ("documents", "labels"):
        rows = spark.read.parquet(f"{BASE}/{name}.parquet")
        (rows.limit(0) if name == "documents" else rows).write.parquet(f"{tmp_path}/{name}.parquet")
    out = corpus_pipeline.run(spark, str(tmp_path))
    assert out.columns == ["doc_id", "source", "n_tokens", "token_ids"] and out.collect() == []


def test_toxicity_features_survive_packing():
    import numpy as np

    from starloom.llm.toxicity import distinct_features, packed, unpacked
    for found in distinct_features([None, "", "one", "one two two one " * 3000, "漢 é " + "x" * 5000], 18):
        assert np.array_equal(unpacked(packed(found)), found)
    ends = np.array([0, (1 << 18) - 1])
    assert np.array_equal(unpacked(packed(ends)), ends)
