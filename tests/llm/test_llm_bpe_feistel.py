"""BPE against the reference encoder library, and the permutations."""

import hashlib

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from starloom.llm import bpe, queries, wordhash
from starloom.llm.feistel import permute

TOKENS, IDS = bpe.read_vocabulary(queries.VOCABULARY)
CODEC = bpe.Codec(*bpe.prepared(queries.VOCABULARY))
REFERENCE = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=dict(zip(TOKENS, IDS)),
                              special_tokens={})
LETTERS = "ab'sstmdrevll  \n\t 12½é漢字!?_- 　\x1c\x85🙂́AB<|endoftext|>"


def encoded(texts):
    return [x.tolist() for _, ids, at in CODEC.encode(texts) for x in np.split(ids, at[1:-1])]


def test_perfect_hash_is_minimal():
    assert (CODEC.find(CODEC.hashes) == np.arange(len(TOKENS))).all()


@settings(max_examples=300, deadline=None, derandomize=True)
@given(st.lists(st.one_of(st.none(), st.text(), st.text(alphabet=LETTERS, max_size=40)), max_size=5))
def test_encode_matches_the_library(texts):
    assert encoded(texts) == [REFERENCE.encode_ordinary(t or "") for t in texts]


def test_words_that_collide_in_any_polynomial():
    word = "a"
    for _ in range(12):  # Thue-Morse: equal polynomials modulo 2^64 for every odd base
        word += word.translate({97: "b", 98: "a"})
    other = word.translate({97: "b", 98: "a"})
    texts = [word + " " + other, other, word]
    assert encoded(texts) == [REFERENCE.encode_ordinary(t) for t in texts]
    a, b = (wordhash.words([t.encode()])[0].tolist() for t in (word, other))
    assert len(a) == len(b) == 1 and a != b


def test_misses_are_told_apart_by_bytes():
    data = np.frombuffer(b"abcabdabcxyab", np.uint8)
    starts, ends = np.array([0, 3, 6, 9, 11]), np.array([3, 6, 9, 11, 13])
    for h in (np.zeros(5, np.uint64), np.array([1, 1, 1, 2, 2], np.uint64), np.arange(5, dtype=np.uint64)):
        index, kind = bpe._distinct(data, h, starts, ends)
        for i, k in enumerate(kind):
            at = index[k]
            assert bytes(data[starts[i]:ends[i]]) == bytes(data[starts[at]:ends[at]])


def test_misses_are_merged_together(monkeypatch):
    alone, rng = [], np.random.default_rng(3)
    monkeypatch.setattr(bpe, "merged", lambda piece, *rest, real=bpe.merged: alone.append(piece) or real(piece, *rest))
    words = ["".join(rng.choice(list("etaoinshrdlué漢"), n)) for n in rng.integers(1, 30, 20_000)]
    assert encoded([" ".join(words)]) == [REFERENCE.encode_ordinary(" ".join(words))]
    assert len(alone) < 300  # before: each distinct word by itself, in Python


def test_rounds_join_what_the_heap_joins():
    rng = np.random.default_rng(4)
    letters = np.frombuffer("etaoin é漢\n'".encode(), np.uint8)
    small = [b"a", b"ba", b"ab", b"abab", b"b", b"bab", b"c"]
    for tokens, ids in ((TOKENS, IDS), (small, [9, 4, 1 << 24, 3, 0, 7, 1 << 23])):
        codec, used = bpe.Codec(tokens, ids), letters if tokens is TOKENS else np.frombuffer(b"abc", np.uint8)
        n = rng.integers(1, bpe.WIDTHS[-1] + 40, 4000)
        data, ends = rng.choice(used, n.sum()), np.cumsum(n)
        got, counts = codec._misses(data, ends - n, ends)
        want = [bpe.merged(data[e - k:e].tobytes(), codec.ranks, codec.longest) for k, e in zip(n.tolist(), ends.tolist())]
        assert [x.tolist() for x in np.split(got, np.cumsum(counts)[:-1])] == want


def test_bytes_that_are_no_token():
    codec = bpe.Codec([b"ab", b"abab"], [0, 1])
    data = np.frombuffer(b"ababab" * 40, np.uint8)
    starts = np.arange(40) * 6
    got, counts = codec._misses(data, starts, starts + 6)  # single bytes need no id where they are joined
    assert counts.tolist() == [2] * 40 and got.tolist() == [1, 0] * 40
    with pytest.raises(KeyError):
        codec._misses(data, starts, starts + 5)


def test_long_texts_are_cut_at_borders():
    text = "It's  what we'll see, 12 times \n\n déjà vu! " * 60_000 + "x" * 3000
    assert len(text) > bpe.CHUNK
    assert encoded(["a", text, ""]) == [REFERENCE.encode_ordinary(t) for t in ("a", text, "")]


def test_operator_and_round_trip(spark):
    texts = [None, "", " ", "it's\n\nübel 漢字", "x" * 5000, "it's\n\nübel 漢字"]
    df = spark.createDataFrame([(i, t, "keep") for i, t in enumerate(texts)], "doc_id long, text string, decoded string")
    coded = bpe.encode(df.repartition(3), queries.VOCABULARY, decoded_col="back")
    rows = sorted(coded.collect())
    assert coded.columns == ["doc_id", "text", "decoded", "token_ids", "back"]
    assert [r.token_ids for r in rows] == [REFERENCE.encode_ordinary(t or "") for t in texts]
    assert [bytes(r.back).decode() for r in rows] == [t or "" for t in texts]
    again = bpe.decode(coded.select("doc_id", "token_ids"), queries.VOCABULARY).orderBy("doc_id").collect()
    assert [bytes(r.decoded) for r in again] == [(t or "").encode() for t in texts]
    assert bpe.encode(df.limit(0), queries.VOCABULARY).collect() == []


def test_query(spark):
    base = "/root/testdata/sf0.001"
    rows = {r.doc_id: r for r in queries.queries()["op9_byte_bpe"](spark, base).collect()}
    docs = spark.read.parquet(f"{base}/documents.parquet").collect()
    assert len(docs) == len(rows)
    for d in docs:
        ids = REFERENCE.encode_ordinary(d.text or "")
        r = rows[d.doc_id]
        assert (r.n_tokens, r.ids_sha256, r.decoded_sha256) == (
            len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(),
            hashlib.sha256((d.text or "").encode()).hexdigest())


@settings(max_examples=60, deadline=None, derandomize=True)
@given(st.integers(1, 3000), st.integers(0, 2**60))
def test_permutation(n, key):
    assert sorted(permute(np.arange(n), n, key).tolist()) == list(range(n))


def test_permutations_by_element():
    n, key = np.array([5] * 5 + [7] * 7), np.array([1] * 5 + [2] * 7)
    x = np.concatenate((np.arange(5), np.arange(7)))
    got = permute(x, n, key)
    assert got[:5].tolist() == permute(np.arange(5), 5, 1).tolist()
    assert got[5:].tolist() == permute(np.arange(7), 7, 2).tolist()
    big = permute(np.arange(1000), (1 << 40) + 7, 3)
    assert len(set(big.tolist())) == 1000 and big.max() < (1 << 40) + 7
