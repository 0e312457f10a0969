"""Byte-level BPE encoding and decoding with a two-tier lookup.

Text is cut into pre-tokens (letter runs, digit runs, other runs, white space,
contractions) by array operations over the code points. A minimal perfect hash
over the vocabulary resolves every pre-token that is itself a token. The others
are merged once for each distinct pre-token of a chunk, lowest rank first: those of
like length together, one join of each a round, by array operations; long or
single ones by a heap of adjacent pairs over a linked list of bytes.

The vocabulary file has one "base64(token) rank" line a token; it is read on the
driver and broadcast (its size is a property of the vocabulary, under 1 MB here).
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from functools import lru_cache
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starloom.llm.wordhash import mix, span_hashes

#: Characters handled at once.
CHUNK = 800_000
#: Pre-tokens of up to so many bytes are merged together, a table for each width.
WIDTHS = (8, 12, 16, 24, 32, 48, 64, 96, 128)
#: Pre-tokens of a width from which a table is worth its rounds.
FEW = 32
#: Places that a table has, about; this bounds the memory of a merge.
PLACES = 1 << 18
_SEED = np.uint64(0xA0761D6478BD642F)
LETTER, NUMBER, SPACE, OTHER = 0, 1, 2, 3


@lru_cache(maxsize=1)
def _classes() -> np.ndarray:
    """The class of every code point."""
    import regex

    every = "".join(map(chr, range(0xD800))) + "?" * 0x800 + "".join(map(chr, range(0xE000, 0x110000)))
    out = np.full(0x110000, OTHER, np.uint8)
    for kind, pattern in ((LETTER, r"\p{L}+"), (NUMBER, r"\p{N}+"), (SPACE, r"\p{White_Space}+")):
        for match in regex.finditer(pattern, every):
            out[match.start():match.end()] = kind
    return out


def _starts(points: np.ndarray, begins: np.ndarray) -> np.ndarray:
    """Where pre-tokens start. ``begins``: starts of the non-empty texts, which
    lie one behind the other in ``points``; pre-tokens cover everything."""
    n = len(points)
    kind = _classes()[points]
    new = np.empty(n, bool)
    new[0] = True
    np.not_equal(kind[1:], kind[:-1], out=new[1:])
    new[begins] = True
    first = np.flatnonzero(new)
    last = np.append(first[1:], n)
    of = kind[first]
    opens = np.zeros(n + 1, bool)
    opens[begins] = True  # here: a text begins
    final = opens[last]
    final[-1] = True
    inner = np.empty(len(first), bool)  # a run of white space stands before, in the same text
    inner[0] = False
    inner[1:] = (of[:-1] == SPACE) & ~final[:-1]
    space = of == SPACE
    blank = points[last - 1] == 32
    is_start = np.zeros(n, bool)
    # other runs take one blank that stands right before them
    words = ~space
    takes = words & inner
    takes[takes] = blank[np.flatnonzero(takes) - 1]
    is_start[first[words] - takes[words]] = True
    # white space: all but its last character if a word follows, then that character
    length = last - first
    is_start[first[space & (final | (length > 1))]] = True
    is_start[(last - 1)[space & ~final & ~blank]] = True
    # contractions: an apostrophe that begins a pre-token, then s t m d re ve ll
    lone = np.flatnonzero((of == OTHER) & (length == 1) & ~takes & ~final & (points[first] == 39))
    lone = lone[of[lone + 1] == LETTER] if len(lone) else lone
    if len(lone):
        at, room = last[lone], length[lone + 1]
        one = points[at]
        two = np.where(room > 1, points[np.minimum(at + 1, n - 1)], 0)
        cut = np.where(np.isin(one, [ord(c) for c in "stmd"]), 1, 0)
        pair = ((one == ord("r")) & (two == ord("e"))) | ((one == ord("v")) & (two == ord("e"))) \
            | ((one == ord("l")) & (two == ord("l")))
        cut = np.where(pair, 2, cut)
        hit = cut > 0
        is_start[at[hit]] = False
        rest = hit & (room > cut)
        is_start[(at + cut)[rest]] = True
    return np.flatnonzero(is_start)


class PerfectHash:
    """A minimal perfect hash of distinct 64-bit keys: buckets with two or more keys
    store the displacement that sends all their keys to free places, buckets with
    one key store its place."""

    def __init__(self, keys: np.ndarray):
        n = len(keys)
        self.size, self.buckets = np.uint64(max(n, 1)), np.uint64(max(n // 3, 1))
        self.shift = np.zeros(int(self.buckets), np.int64)
        self.index = np.zeros(n, np.int64)  # place -> position among the keys
        free = np.ones(n, bool)
        bucket = (keys % self.buckets).astype(np.int64)
        order = np.argsort(bucket, kind="stable")
        counts = np.bincount(bucket, minlength=int(self.buckets))
        begin = np.concatenate(([0], np.cumsum(counts)))
        for b in np.argsort(-counts, kind="stable")[:int((counts > 1).sum())]:
            members = order[begin[b]:begin[b + 1]]
            low, good = 1, None
            while good is None:
                tries = np.arange(low, 2 * low + 8, dtype=np.uint64)
                places = self._place(keys[members][None, :], tries[:, None])
                good = next((r for r in np.flatnonzero(free[places].all(1))
                             if len(set(places[r].tolist())) == len(members)), None)
                low = 2 * low + 8
            self.shift[b] = int(tries[good])
            free[places[good]] = False
            self.index[places[good]] = members
        left = iter(np.flatnonzero(free).tolist())
        for b in np.flatnonzero(counts == 1):
            place = next(left)
            self.shift[b] = -place - 1
            self.index[place] = order[begin[b]]

    def _place(self, keys: np.ndarray, shift: np.ndarray) -> np.ndarray:
        return (mix(keys ^ (shift * _SEED)) % self.size).astype(np.int64)

    def __call__(self, keys: np.ndarray) -> np.ndarray:
        """The position each key would have among the built keys."""
        shift = self.shift[(keys % self.buckets).astype(np.int64)]
        place = self._place(keys, np.maximum(shift, 0).astype(np.uint64))
        return self.index[np.where(shift < 0, -shift - 1, place)]


class Pairs:
    """The token that two adjacent parts make. Parts are token ids; larger numbers stand
    for bytes that are no token, and ``nothing`` for the place before or after a pre-token."""

    def __init__(self, ranks: dict[bytes, int]):
        self.nothing = max(ranks.values()) + 1
        part = {bytes([b]): self.nothing + 1 + b for b in range(256)} | ranks
        self.bytes = np.array([part[bytes([b])] for b in range(256)], np.int64)
        self.base = self.nothing + 257
        pairs = [(part[t[:i]] * self.base + part[t[i:]], r) for t, r in ranks.items()
                 for i in range(1, len(t)) if t[:i] in part and t[i:] in part]
        self.keys, self.ids = np.array(pairs, np.int64).reshape(-1, 2).T.copy()


class Joins:
    """Looks pairs up in a table with open addressing, a quarter full at most."""

    def __init__(self, pairs: Pairs):
        bits = max(int(4 * len(pairs.keys)).bit_length(), 4)
        self.base, self.nothing = pairs.base, pairs.nothing
        self.shift, self.mask = np.uint64(64 - bits), (1 << bits) - 1
        self.keys, self.ids = np.full(1 << bits, -1, np.int64), np.full(1 << bits, self.nothing, np.int64)
        todo, at = np.arange(len(pairs.keys)), self._at(pairs.keys)
        while len(todo):
            free = self.keys[at] < 0
            self.keys[at[free]] = pairs.keys[todo[free]]  # of several, one stays
            here = self.keys[at] == pairs.keys[todo]
            self.ids[at[here]] = pairs.ids[todo[here]]
            todo, at = todo[~here], at[~here] + 1 & self.mask

    def _at(self, keys: np.ndarray) -> np.ndarray:
        return (keys.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> self.shift).view(np.int64)

    def __call__(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The id each pair joins to, ``nothing`` if it is no token."""
        keys = left * self.base + right
        at = self._at(keys)
        there = self.keys[at]
        out = self.ids[at]
        odd = np.flatnonzero(there != keys)
        out[odd] = self.nothing
        odd = odd[there[odd] >= 0]  # another pair has the place
        at = at[odd]
        while len(odd):
            at = at + 1 & self.mask
            there = self.keys[at]
            hit = there == keys[odd]
            out[odd[hit]] = self.ids[at[hit]]
            on = ~hit & (there >= 0)
            odd, at = odd[on], at[on]
        return out


def merged(piece: bytes, ranks: dict[bytes, int], longest: int) -> list[int]:
    """Ids of one pre-token: the adjacent pair of lowest rank, leftmost first, is
    joined until no pair is a token."""
    n = len(piece)
    base, rank = n + 1, ranks.get
    stop = list(range(1, n + 2))  # end of the part that begins here, 0 once it is joined
    before = list(range(-1, n))  # begin of the part on the left
    # a heap entry is (rank, begin, end) of a joined pair as one number
    heap = [(r * base + i) * base + i + 2 for i in range(n - 1) if (r := rank(piece[i:i + 2])) is not None]
    heapify(heap)
    while heap:
        i, end = divmod(heappop(heap) % (base * base), base)
        middle = stop[i]
        if not middle or middle >= n or stop[middle] != end:
            continue
        stop[i], stop[middle] = end, 0
        if end < n:
            before[end] = i
            to = stop[end]
            if to - i <= longest and (r := rank(piece[i:to])) is not None:
                heappush(heap, (r * base + i) * base + to)
        if i:
            p = before[i]
            if end - p <= longest and (r := rank(piece[p:end])) is not None:
                heappush(heap, (r * base + p) * base + end)
    out, i = [], 0
    while i < n:
        out.append(ranks[piece[i:stop[i]]])
        i = stop[i]
    return out


def _spread(first: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The numbers first[k], first[k] + 1, ... (counts[k] of them) for all k in a row."""
    ends = np.cumsum(counts)
    return np.repeat(first - (ends - counts), counts) + np.arange(int(ends[-1]) if len(ends) else 0)


def _cut(text: str) -> list[str]:
    """Pieces of a long text. A cut before a single blank between other characters
    is a border of pre-tokens in any case; without one a piece gets longer."""
    out, at = [], 0
    while len(text) - at > CHUNK:
        to = at + CHUNK
        while (to := text.find(" ", to)) >= 0 and (text[to - 1].isspace() or text[to + 1:to + 2].isspace()
                                                   or to + 1 == len(text)):
            to += 1
        if to < 0:
            break
        out.append(text[at:to])
        at = to
    return [*out, text[at:]]


def _distinct(data: np.ndarray, h: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(one span of each kind, the kind of each span): spans of one kind have the same
    bytes. Spans are grouped by hash and then compared with the first of their group;
    those that differ from it are kinds of their own."""
    _, index, inverse = np.unique(h, return_index=True, return_inverse=True)
    first, n = index[inverse], ends - starts
    equal = n == n[first]
    which = np.flatnonzero(equal & (first != np.arange(len(h))))
    if len(which):
        same = data[_spread(starts[which], n[which])] == data[_spread(starts[first[which]], n[which])]
        equal[which] = np.logical_and.reduceat(same, np.cumsum(n[which]) - n[which])
    odd = np.flatnonzero(~equal)
    inverse[odd] = len(index) + np.arange(len(odd))
    return np.concatenate((index, odd)), inverse


class Codec:
    """Encoder and decoder of one vocabulary."""

    def __init__(self, tokens: list[bytes], ids: list[int], find: PerfectHash | None = None, pairs: Pairs | None = None):
        self.ranks = dict(zip(tokens, ids))
        self.longest = max(map(len, tokens))
        self.data = np.frombuffer(b"".join(tokens), np.uint8)
        self.lengths = np.array([len(t) for t in tokens], np.int64)
        self.begins = np.cumsum(self.lengths) - self.lengths
        self.hashes = span_hashes(self.data, self.begins, self.begins + self.lengths)
        if len(np.unique(self.hashes)) < len(tokens):
            raise ValueError("two tokens share a 64-bit hash")
        self.find = find or PerfectHash(self.hashes)
        self.ids = np.array(ids, np.int32)
        self.of_id = np.empty(max(ids) + 1, object)
        self.of_id[ids] = tokens
        self.pairs = pairs or Pairs(self.ranks)
        self.joins = Joins(self.pairs)
        every = self.pairs.bytes
        self.byte_pairs = self.joins(np.repeat(every, 256), np.tile(every, 256))

    def _together(self, data: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids in a row, counts) of pre-tokens as ``merged`` has them: in each round the
        leftmost pair of lowest rank of every pre-token is joined."""
        n, width, nothing = len(starts), int(sizes.max()), self.joins.nothing
        shift = (width + 2).bit_length()
        rows = np.arange(width)[:, None] < sizes
        spelled = data[np.minimum(starts + np.arange(width)[:, None], len(data) - 1)].astype(np.int64)
        # by place and pre-token; a part lies where it begins, place 0 and those behind the end hold nothing
        part = np.full((width + 2, n), nothing, np.int64)
        part[1:-1][rows] = self.pairs.bytes[spelled[rows]]
        # the pair that begins here: its rank, then its place, so that the least is the next to be joined
        none = nothing << shift
        rank = np.full((width + 2, n), none, np.int32 if none < 1 << 31 else np.int64)
        both = rows[1:]
        joined = self.byte_pairs[(spelled[:-1] << 8) + spelled[1:]]
        place = np.arange(1, width)[:, None]
        rank[1:-2] = np.where(both & (joined < nothing), (joined << shift) + place, none)
        after = np.repeat(np.arange(1, width + 3), n).astype(np.int16)
        before = np.repeat(np.arange(-1, width + 1), n).astype(np.int16)
        flat, ranks = part.ravel(), rank.ravel()
        while True:
            least = rank.min(0)
            of = np.flatnonzero(least < none)
            if not len(of):
                break
            least = least[of].astype(np.int64)
            here = least & (1 << shift) - 1
            token = least >> shift
            at = here * n + of
            middle = after[at].astype(np.int64) * n + of
            end = after[middle]
            right = end.astype(np.int64) * n + of
            left = before[at]
            to_left = left.astype(np.int64) * n + of
            flat[at], flat[middle] = token, -1
            ranks[middle] = none
            after[at], before[right] = end, here
            for to, first, a, b in ((at, here, token, flat[right]), (to_left, left, flat[to_left], token)):
                joined = self.joins(a, b)
                ranks[to] = np.where(joined < nothing, (joined << shift) + first, none)
        kept = part[1:-1].T
        live = (kept >= 0) & rows.T
        out = kept[live]
        if len(out) and out.max() > nothing:
            raise KeyError("a byte is no token")
        return out, live.sum(1)

    def _misses(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids in a row, counts) of pre-tokens outside the vocabulary."""
        sizes = ends - starts
        counts, parts, low = np.zeros(len(sizes), np.int64), [], 0
        alone = [np.flatnonzero(sizes > WIDTHS[-1])]
        for high in WIDTHS:
            rows = np.flatnonzero((sizes > low) & (sizes <= high))
            low = high
            if len(rows) < FEW:
                alone.append(rows)
                continue
            for some in np.array_split(rows, -(-len(rows) * high // PLACES)):
                ids, counts[some] = self._together(data, starts[some], sizes[some])
                parts.append((some, ids))
        alone = np.concatenate(alone)
        for i in alone.tolist():
            ids = merged(data[starts[i]:ends[i]].tobytes(), self.ranks, self.longest)
            counts[i] = len(ids)
            parts.append((np.array([i]), ids))
        first = np.cumsum(counts) - counts
        out = np.empty(int(counts.sum()), np.int32)
        for rows, ids in parts:
            out[_spread(first[rows], counts[rows])] = ids
        return out, counts

    def _chunk(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        whole = "".join(texts)
        sizes = np.fromiter(map(len, texts), np.int64, len(texts))
        begins = np.concatenate(([0], np.cumsum(sizes)))
        if not whole:
            return np.zeros(0, np.int32), np.zeros(len(texts) + 1, np.int64)
        points = np.frombuffer(whole.encode("utf-32-le"), np.uint32)
        data = np.frombuffer(whole.encode(), np.uint8)
        at = _starts(points, begins[:-1][sizes > 0])
        starts = at
        if len(data) != len(points):
            width = 1 + (points >= 0x80).astype(np.int8) + (points >= 0x800) + (points >= 0x10000)
            starts = np.concatenate(([0], np.cumsum(width, dtype=np.int64)))[at]
        ends = np.append(starts[1:], len(data))
        h = span_hashes(data, starts, ends)
        key = self.find(h)
        hit = (self.hashes[key] == h) & (self.lengths[key] == ends - starts)
        which = np.flatnonzero(hit)
        n = (ends - starts)[which]
        same = data[_spread(starts[which], n)] == self.data[_spread(self.begins[key[which]], n)]
        if not same.all():  # equal hash, other bytes
            bad = np.add.reduceat(~same, np.cumsum(n) - n) > 0
            hit[which[bad]] = False
        miss = np.flatnonzero(~hit)
        index, inverse = _distinct(data, h[miss], starts[miss], ends[miss])
        found, lengths = self._misses(data, starts[miss[index]], ends[miss[index]])
        counts = np.ones(len(h), np.int64)
        counts[miss] = lengths[inverse]
        place = np.concatenate(([0], np.cumsum(counts)))
        out = np.empty(int(place[-1]), np.int32)
        out[place[:-1][hit]] = self.ids[key[hit]]
        if len(miss):
            from_ = (np.cumsum(lengths) - lengths)[inverse]
            out[_spread(place[:-1][miss], counts[miss])] = found[_spread(from_, counts[miss])]
        return out, place[np.searchsorted(at, begins)]

    def encode(self, texts: list[str | None]) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """For consecutive texts: (how many, their ids in a row, offsets)."""
        held, size = [], 0
        for text in texts:
            text = text or ""
            if held and size + len(text) > CHUNK:
                yield len(held), *self._chunk(held)
                held, size = [], 0
            if len(text) > CHUNK:
                ids = np.concatenate([self._chunk([x])[0] for x in _cut(text)])
                yield 1, ids, np.array([0, len(ids)], np.int64)
                continue
            held.append(text)
            size += len(text)
        if held:
            yield len(held), *self._chunk(held)

    def decode(self, ids: np.ndarray) -> bytes:
        """The bytes of some ids in a row."""
        return b"".join(self.of_id[ids].tolist())


def read_vocabulary(path: str) -> tuple[list[bytes], list[int]]:
    """Tokens and ranks of a rank file."""
    with open(path, "rb") as lines:
        pairs = [line.split() for line in lines if line.strip()]
    return [base64.b64decode(a) for a, _ in pairs], [int(b) for _, b in pairs]


@lru_cache(maxsize=4)
def prepared(path: str) -> tuple[list[bytes], list[int], PerfectHash, Pairs]:
    """What a codec is built from, made once on the driver."""
    codec = Codec(*read_vocabulary(path))
    return list(codec.ranks), list(codec.ranks.values()), codec.find, codec.pairs


_codecs: dict[int, Codec] = {}


def codec_of(vocabulary) -> Codec:
    """The codec of a broadcast vocabulary; a Python worker keeps the last one, told
    apart by its tokens and ids."""
    tokens, ids, find, pairs = vocabulary.value
    key = hash((b"\0".join(tokens), tuple(ids)))
    if key not in _codecs:
        _codecs.clear()
        _codecs[key] = Codec(tokens, ids, find, pairs)
    return _codecs[key]


def broadcast_vocabulary(docs: DataFrame, path: str):
    """The vocabulary file's tokens and ranks, their perfect hash and their pairs, sent
    to the executors once."""
    return docs.sparkSession.sparkContext.broadcast(prepared(path))


def _encoded(codec: Codec, batches: Iterator[pa.RecordBatch], text_col: str) -> Iterator[tuple]:
    """Consecutive parts of the batches with their ids; few rows are Python strings at a
    time."""
    for batch in batches:
        for first in range(0, batch.num_rows, 1024):
            rows, at = batch.slice(first, 1024), 0
            for n, ids, offsets in codec.encode(rows.column(text_col).to_pylist()):
                yield rows.slice(at, n), ids, offsets
                at += n


def encode(docs: DataFrame, path: str, text_col: str = "text", ids_col: str = "token_ids",
           decoded_col: str | None = None) -> DataFrame:
    """``docs`` with the ids of each whole text (array of int). With
    ``decoded_col`` also the bytes that these ids decode to.

    A null or empty text has no ids. Rows are kept as they are, repeated rows
    and nulls in other columns included; an empty table stays empty. A column
    named like a new one is replaced. No special tokens are made.
    """
    vocabulary = broadcast_vocabulary(docs, path)
    docs = docs.drop(ids_col, *([decoded_col] if decoded_col else []))
    schema = T.StructType([*docs.schema.fields, T.StructField(ids_col, T.ArrayType(T.IntegerType(), False), False),
                           *([T.StructField(decoded_col, T.BinaryType(), False)] if decoded_col else [])])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = codec_of(vocabulary)
        for part, ids, offsets in _encoded(codec, batches, text_col):
            columns = [*part.columns, pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(ids))]
            if decoded_col:
                columns.append(pa.array([codec.decode(ids[a:b]) for a, b in zip(offsets[:-1], offsets[1:])], pa.binary()))
            yield pa.RecordBatch.from_arrays(columns, [f.name for f in schema])

    return docs.mapInArrow(run, schema)


def packed(docs: DataFrame, path: str, dtype: str = "uint16", id_col: str = "doc_id", text_col: str = "text",
           tokens_col: str = "tokens") -> DataFrame:
    """Rows (id, tokens): the ids of each whole text as the bytes of numbers of ``dtype``,
    which must hold them. Cases as in ``encode``."""
    vocabulary = broadcast_vocabulary(docs, path)
    if max(vocabulary.value[1]) > np.iinfo(dtype).max:
        raise ValueError(f"the vocabulary has ids beyond {dtype}")
    rows = docs.select(F.col(id_col), F.col(text_col).alias("text"))
    schema = T.StructType([rows.schema.fields[0], T.StructField(tokens_col, T.BinaryType(), False)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = codec_of(vocabulary)
        for part, ids, offsets in _encoded(codec, batches, "text"):
            data, at = ids.astype(dtype).tobytes(), (offsets * np.dtype(dtype).itemsize).astype(np.int32)
            tokens = pa.Array.from_buffers(pa.binary(), len(part), [None, pa.py_buffer(at.tobytes()), pa.py_buffer(data)])
            yield pa.RecordBatch.from_arrays([part.column(0), tokens], schema.names)

    return rows.mapInArrow(run, schema)


def decode(docs: DataFrame, path: str, ids_col: str = "token_ids", decoded_col: str = "decoded") -> DataFrame:
    """``docs`` with the bytes that the ids in ``ids_col`` stand for; null ids give null."""
    vocabulary = broadcast_vocabulary(docs, path)
    docs = docs.drop(decoded_col)
    schema = T.StructType([*docs.schema.fields, T.StructField(decoded_col, T.BinaryType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = codec_of(vocabulary)
        for batch in batches:
            texts = [None if ids is None else codec.decode(np.array(ids, np.int64))
                     for ids in batch.column(ids_col).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.binary())], [f.name for f in schema])

    return docs.mapInArrow(run, schema)
