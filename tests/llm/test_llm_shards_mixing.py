"""Training-order shards and source mixing."""

import os

import numpy as np
import pytest

from starloom.llm import bpe, mixing, queries, shards
from starloom.llm.feistel import permute

BASE = "/root/testdata/sf0.001"


def in_order(layout):
    every = shards.read_slots(layout, 0, layout.sequences)
    return every[permute(np.arange(layout.sequences), layout.sequences, layout.key)]


def test_shards_hold_every_byte_once(spark, tmp_path):
    docs = spark.read.parquet(f"{BASE}/documents.parquet")
    layout, index = shards.write_shards(docs, f"file://{tmp_path}/s", length=256, per_shard=300, from_files=True)
    rows = index.orderBy("slot").collect()
    assert [r.slot for r in rows] == list(range(layout.sequences))
    assert all((r.shard, r.offset) == (r.slot // 300, r.slot % 300 * 256) for r in rows)
    assert sum(os.path.getsize(f"{tmp_path}/s/{f}") for f in os.listdir(f"{tmp_path}/s") if f.endswith(".bin")) \
        == layout.sequences * 256
    stream = in_order(layout).tobytes().rstrip(bytes([shards.BYTE_PAD]))
    assert stream == b"".join((r.text or "").encode() + b"\xff" for r in docs.select("text").collect())
    assert {d for r in rows for d in r.doc_ids} == {r.doc_id for r in docs.select("doc_id").collect()}
    assert (shards.read_slots(layout, 298, 5) == shards.read_slots(layout, 0, layout.sequences)[298:303]).all()
    again, _ = shards.write_shards(docs, f"file://{tmp_path}/t", length=256, per_shard=300, from_files=True)
    assert (in_order(again) == in_order(layout)).all()


def test_shards_of_ids_nulls_and_repeats(spark, tmp_path):
    rows = [(1, [5, 6, 7], 0), (None, [8], 0), (1, [5, 6, 7], 0), (2, None, 0), (3, [], 0), (4, list(range(50)), 0)]
    df = spark.createDataFrame(rows, "doc_id long, ids array<int>, slot int")
    layout, index = shards.write_shards(df, f"file://{tmp_path}/i", "ids", length=4, per_shard=3, dtype="uint16",
                                        end=60000, pad=60001)
    flat = [x for x in in_order(layout).ravel().tolist() if x != 60001]
    parts, part = [], []
    for x in flat:
        if x == 60000:
            parts.append(part)
            part = []
        else:
            part.append(x)
    assert sorted(parts) == sorted(r[1] or [] for r in rows) and part == []
    assert index.agg({"n_tokens": "sum"}).first()[0] == len(flat)
    layout, index = shards.write_shards(df.limit(0), f"file://{tmp_path}/e", "ids", dtype="uint16")
    assert layout.sequences == 0 and index.collect() == [] and len(shards.read_slots(layout, 0, 5)) == 0


def test_shard_query(spark):
    df = queries.queries()["op2_training_order"](spark, BASE)
    tokens = queries.queries()["op9_byte_bpe"](spark, BASE).selectExpr("sum(n_tokens + 1)").first()[0]
    assert df.agg({"n_tokens": "sum"}).first()[0] == tokens
    docs = {r.doc_id for r in spark.read.parquet(f"{BASE}/documents.parquet").select("doc_id").collect()}
    assert {d for r in df.collect() for d in r.doc_ids} == docs


def test_shards_hold_the_ids_of_the_vocabulary(spark, tmp_path):
    docs = spark.read.parquet(f"{BASE}/documents.parquet").where("doc_id < 40").select("doc_id", "text")
    ids = bpe.packed(docs, queries.VOCABULARY)
    layout, _ = shards.write_shards(ids, f"file://{tmp_path}/v", "tokens", length=100, per_shard=7, dtype="uint16",
                                    end=60000, pad=60001)
    flat = in_order(layout).ravel()
    whole = bpe.encode(docs, queries.VOCABULARY).collect()
    parts = np.split(flat[flat != 60001], np.flatnonzero(flat[flat != 60001] == 60000) + 1)[:-1]
    assert sorted(p[:-1].tolist() for p in parts) == sorted(r.token_ids for r in whole)


def test_the_copy_of_the_ids_is_dense(spark, tmp_path, monkeypatch):
    made = {}
    monkeypatch.setattr(shards, "written", lambda df, name, *a, real=shards.written, **k: made.setdefault(name, real(df, name, *a, **k)))
    rng = np.random.default_rng(1)
    docs = [rng.integers(0, 50_000, 2500).astype(np.uint16).tobytes() for _ in range(300)]
    rows = list(enumerate(docs + docs))  # 3 MB, where a document comes again after 1.5 MB
    df = spark.createDataFrame(rows, "doc_id long, tokens binary").coalesce(1)
    layout, _ = shards.write_shards(df, f"file://{tmp_path}/c", "tokens", dtype="uint16", end=50_000, pad=50_001)
    size = sum(os.path.getsize(f.removeprefix("file://")) for f in made["tokens"].inputFiles())
    assert size < 0.7 * sum(len(d) for _, d in rows)  # the writer's default pages, of 1 MB, hold no repetition
    flat = in_order(layout).ravel()
    flat = flat[flat != 50_001]
    parts = np.split(flat, np.flatnonzero(flat == 50_000) + 1)[:-1]
    assert sorted(p[:-1].tobytes() for p in parts) == sorted(docs + docs)


def test_every_document_is_listed_where_its_tokens_lie(spark, tmp_path):
    n = 320_000  # more than 2 MB a split, and a stride that does not divide it
    docs = spark.range(0, n, 1, 1).selectExpr("id as doc_id", "substring('abcdefg', 1, 6 + int(id % 2)) as text")
    _, index = shards.write_shards(docs, f"file://{tmp_path}/d", length=1000)
    rows = sorted(index.collect(), key=lambda r: r.doc_ids[0])
    ends, at = np.cumsum(7 + np.arange(n) % 2), 0
    for r in rows:  # one split: its sequences in the order of their documents
        first, last = np.searchsorted(ends, at, "right"), np.searchsorted(ends, at + r.n_tokens, "left")
        assert r.doc_ids == list(range(first, last + 1))
        at += r.n_tokens
    assert at == ends[-1]


def reference_targets(sizes):
    """Targets by repeated resharing."""
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: (5, 2, 1)[k % 3] for k, s in enumerate(order)}
    total, target, full = sum(sizes.values()), dict.fromkeys(sizes, 0.0), set()
    while True:
        left = total - sum(3 * sizes[s] for s in full)
        free = [s for s in sizes if s not in full]
        w = sum(weight[s] for s in free)
        target = {s: 3 * sizes[s] if s in full else left * weight[s] / w for s in sizes}
        over = [s for s in free if target[s] > 3 * sizes[s] + 1e-9]
        if not over:
            return target
        full.update(over)


@pytest.mark.parametrize("sizes", [{"a": 10, "b": 1000, "c": 50, "d": 3, None: 400}, {"x": 7}, {"a": 0, "b": 9},
                                   {"a": 1, "b": 1, "c": 1, "d": 500, "e": 2, "f": 2, "g": 90}])
def test_targets(spark, sizes):
    rows = [(s, n) for s, n in sizes.items()] + [(s, 0) for s in sizes]
    got = {r.source: r.target for r in mixing.source_targets(spark.createDataFrame(rows, "source string, size long")).collect()}
    want = reference_targets(sizes)
    assert got.keys() == want.keys()
    assert all(abs(got[s] - want[s]) < 1e-6 for s in want)


def test_mix_of_given_table(spark):
    df = queries.queries()["op4_source_mix"](spark, BASE)
    rows = df.collect()
    docs = {r.doc_id: r for r in spark.read.parquet(f"{BASE}/documents.parquet").collect()}
    assert len(rows) == len(docs)
    taken = {}
    for r in rows:
        text = docs[r.doc_id].text or ""
        assert r["size"] == len([w for w in text.translate(dict.fromkeys(range(9, 14), " ")).split(" ") if w])
        assert r.taken <= 3 * r["size"]
        source = docs[r.doc_id].source
        taken.setdefault(source, [0, r.target, 0])
        taken[source][0] += r.taken
        taken[source][2] += r["size"]
    assert {s: round(t, 6) for s, (_, t, _) in taken.items()} == {
        s: round(t, 6) for s, t in reference_targets({s: n for s, (_, _, n) in taken.items()}).items()}
    assert all(abs(n - t) <= 0.05 * t + 128 for n, t, _ in taken.values())
    again = queries.queries()["op4_source_mix"](spark, BASE).collect()
    assert sorted(map(tuple, rows)) == sorted(map(tuple, again))


def test_mix_edge_cases(spark):
    rows = [(1, "a b  c\nd", "s", 9), (1, "a b  c\nd", "s", 9), (2, None, "s", 9), (3, "", None, 9), (None, "x y", None, 9),
            (4, " lead " + "w " * 500, "t", 9)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, turn int")
    assert mixing.taken_words(df.limit(0)).collect() == []
    assert mixing.mix(df.limit(0)).collect() == []
    assert all(r.taken == 0 for r in mixing.taken_words(df.where("doc_id in (2, 3)")).collect())
    got = mixing.taken_words(df, block_words=2).collect()
    assert len(got) == 6 and all(r.taken <= 3 * r["size"] for r in got)
    mixed = mixing.mix(df, block_words=2)
    assert mixed.columns == ["doc_id", "text", "source", "turn"]
    by_id = {}
    for r in mixed.collect():
        by_id[r.doc_id] = by_id.get(r.doc_id, 0) + len(r.text.split())
    want = {}
    for r in got:
        want[r.doc_id] = want.get(r.doc_id, 0) + r.taken
    assert by_id == {k: v for k, v in want.items() if v}


def test_shard_counts_are_multinomial_and_totals_exact(spark):
    slots = [50_000, 30_000, 15_000, 5_000, 3, 1, 0]
    sources = spark.createDataFrame([(i, n, n) for i, n in enumerate(slots)], "source_no int, blocks long, slots long")
    rows = mixing.dealt(sources, 1000, 3).toPandas()
    assert rows.groupby("source_no").size().to_dict() == {i: n for i, n in enumerate(slots) if n}
    assert not rows.duplicated(["source_no", "turn", "block"]).any()
    counts = rows.groupby(["source_no", "shard"]).size().unstack(fill_value=0)
    assert counts.shape[1] == 101 and rows["shard"].max() == 100
    for i, n in enumerate(slots[:4]):  # mean and variance of a multinomial draw
        mean = n / 101
        assert abs(counts.loc[i].mean() - mean) < 1e-9 and 0.6 * mean < counts.loc[i].var() < 1.5 * mean


SMALL = {"a": 3, "b": 10, "c": 65, "d": 100, "e": 1000, None: 100_000}


def unequal(spark, seed=0):
    rows, at = [], 0
    for source, words in SMALL.items():
        n = 400 if words > 1000 else 1
        for k in range(n):
            rows.append((at, " ".join(f"w{at}x{j}" for j in range(words // n)), source))
            at += 1
    return spark.createDataFrame(rows, "doc_id long, text string, source string")


def test_small_sources_come_near_their_targets(spark):
    rows = mixing.taken_words(unequal(spark)).collect()
    taken = {}
    for r in rows:
        assert r.taken <= 3 * r["size"]
        taken[r.source] = taken.get(r.source, 0) + r.taken
    want = reference_targets(SMALL)
    for source in SMALL:
        assert abs(taken[source] - want[source]) <= max(64, 0.05 * want[source]), source
    assert taken["a"] == 9 and taken["b"] == 30 and taken["c"] == 195  # capped sources are taken whole three times


def test_split_size_does_not_change_the_mix(spark, tmp_path):
    path = str(tmp_path / "docs")
    docs = unequal(spark)
    docs.unionByName(docs.where("doc_id % 5 = 0")).repartition(7).write.parquet(path)  # with repeated rows
    found = []
    for split in ("128m", "2k"):
        spark.conf.set("spark.sql.files.maxPartitionBytes", split)
        try:
            df = spark.read.parquet(path)
            found.append((sorted(map(tuple, mixing.taken_words(df).collect()), key=repr),
                          sorted(map(tuple, mixing.mix(df, block_words=8).collect()), key=repr)))
        finally:
            spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert found[0] == found[1]


def test_mix_keeps_columns_of_any_name(spark):
    names = ["doc_id", "text", "source", "_uid", "uid", "size", "taken", "runs", "pieces", "cut", "h1", "doc", "a.b", "blocks"]
    df = spark.createDataFrame([(1, "a b c d", "s", *range(11)), (2, None, None, *range(11))], names)
    mixed = mixing.mix(df, block_words=2)
    assert mixed.columns == [*names, "turn"]
    assert all(tuple(r)[3:14] == tuple(range(11)) for r in mixed.collect()) and mixed.count() >= 1
    assert mixing.taken_words(df).count() == 2


def test_mix_of_a_very_long_text(spark):
    df = spark.createDataFrame([(1, "word " * 300_000, "s"), (2, "w", "t")], "doc_id long, text string, source string")
    got = {r.doc_id: r for r in mixing.taken_words(df).collect()}
    assert got[1]["size"] == 300_000 and abs(got[1].taken - got[1].target) <= 64 and got[2].taken == 3
