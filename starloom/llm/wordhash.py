"""Word hashes of whole texts, vectorised over the bytes of a batch.

A word is a maximal run of ASCII letters and digits and of bytes above 0x7F
(so of any non-ASCII characters) in the lower-cased text. The 64-bit hash of
a word is a polynomial over its bytes, taken from prefix sums, then mixed. Long words,
among which a polynomial modulo 2^64 has pairs that collide for any base, are
hashed one by one instead.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import xxhash

_BASE = 0x9E3779B97F4A7C15 | 1
_MASK = (1 << 64) - 1
_STEP = np.uint64(0xD6E8FEB86659FD93)
_IS_WORD = np.zeros(256, np.int8)
_IS_WORD[0x80:] = 1
for _lo, _hi in ((0x30, 0x3A), (0x41, 0x5B), (0x61, 0x7B)):
    _IS_WORD[_lo:_hi] = 1
_powers = np.ones(1, np.uint64)
_inverse = np.ones(1, np.uint64)
#: Bytes of text handled at once; with a separator a text they stay below 2^20 in most
#: chunks, so that the tables of powers need no more entries.
CHUNK = 1_000_000
#: Bytes from which a span is hashed on its own.
LONG = 129


def _grown(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2^64, ``n`` at least."""
    global _powers, _inverse
    if len(_powers) < n:
        size = 1 << (n - 1).bit_length()
        _powers = np.ones(size, np.uint64)
        _inverse = np.ones(size, np.uint64)
        np.cumprod(np.full(size - 1, _BASE, np.uint64), out=_powers[1:])
        np.cumprod(np.full(size - 1, pow(_BASE, -1, 1 << 64), np.uint64), out=_inverse[1:])
    return _powers, _inverse


def mix(h: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    h = h ^ (h >> np.uint64(32))
    h = h * np.uint64(0xD6E8FEB86659FD93)
    h = h ^ (h >> np.uint64(32))
    h = h * np.uint64(0xC2B2AE3D27D4EB4F)
    return h ^ (h >> np.uint64(32))


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of the byte spans [start, end) of ``data``."""
    powers, inverse = _grown(len(data) + 1)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * powers[: len(data)], out=sums[1:])
    out = mix((sums[ends] - sums[starts]) * inverse[starts])
    for i in np.flatnonzero(ends - starts >= LONG).tolist():
        out[i] = xxhash.xxh3_64_intdigest(data[starts[i]:ends[i]], seed=_BASE)
    return out


def chunks(texts: list[str | None]) -> Iterator[tuple[int, list[bytes]]]:
    """Consecutive lower-cased UTF-8 texts of about CHUNK bytes together (one
    longer text comes alone), with the index of the first."""
    at, size, held = 0, 0, []
    for i, text in enumerate(texts):
        data = text.lower().encode("utf-8", "replace") if isinstance(text, str) else b""
        if held and size + len(data) > CHUNK:
            yield at, held
            at, size, held = i, 0, []
        held.append(data)
        size += len(data)
    if held:
        yield at, held


def words(batch: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(hash of every word, offsets): text i has the words
    ``offsets[i]:offsets[i + 1]``."""
    data = np.frombuffer(b"\n".join(batch), np.uint8)
    lengths = np.fromiter((len(x) + 1 for x in batch), np.int64, len(batch))
    edges = np.diff(_IS_WORD[data], prepend=np.int8(0), append=np.int8(0))
    starts, ends = np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)
    offsets = np.concatenate(([0], np.searchsorted(starts, np.cumsum(lengths))))
    return span_hashes(data, starts, ends), offsets


def shingles(h: np.ndarray, offsets: np.ndarray, width: int = 5) -> list[np.ndarray]:
    """Per text the sorted distinct hashes of its runs of ``width`` words. A text
    of fewer words, but at least one, has one shingle of all its words."""
    out = []
    if len(h) >= width:
        n = len(h) - width + 1
        runs = h[:n].copy()
        for j in range(1, width):
            runs = runs * _STEP + h[j : n + j]
        runs = mix(runs)
    for a, b in zip(offsets[:-1], offsets[1:]):
        if b - a >= width:
            out.append(np.unique(runs[a : b - width + 1]))
        elif b > a:
            whole = np.uint64(b - a)
            for x in h[a:b]:
                whole = np.uint64((int(whole) * int(_STEP) + int(x)) & _MASK)
            out.append(mix(np.array([whole], np.uint64)))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def shingle_sets(texts: list[str | None], width: int = 5) -> Iterator[np.ndarray]:
    """The shingle set of each text, in order; whole texts, in bounded chunks."""
    for _, batch in chunks(texts):
        yield from shingles(*words(batch), width)
