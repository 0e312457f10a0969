"""Keyed permutations of 0..n-1 by a Feistel network with cycle walking."""

from __future__ import annotations

import numpy as np

from starloom.llm.wordhash import mix

ROUNDS = 8


def permute(x: np.ndarray, n: int | np.ndarray, key: int | np.ndarray = 0) -> np.ndarray:
    """The image of each ``x`` (0 <= x < n) under a permutation of 0..n-1.

    ``n`` and ``key`` may be arrays: one permutation for each element. The network
    permutes the least power of two that holds n; images outside 0..n-1 are
    permuted again until they fall inside (under two rounds on average)."""
    x = np.asarray(x, np.uint64)
    if not x.size:
        return x.astype(np.int64)
    n = np.broadcast_to(np.asarray(n, np.uint64), x.shape)
    key = np.broadcast_to(np.asarray(key).astype(np.uint64), x.shape)
    if (x >= n).any():
        raise ValueError("an index lies outside its domain")
    bits = np.maximum(np.ceil(np.log2(np.maximum(n, 2).astype(np.float64))), 1).astype(np.uint64)
    bits += (np.uint64(1) << bits) < n  # where the logarithm was rounded down
    low = bits // np.uint64(2)
    low_mask = (np.uint64(1) << low) - np.uint64(1)
    high_mask = (np.uint64(1) << (bits - low)) - np.uint64(1)
    seeds = mix(np.arange(1, ROUNDS + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    keys = mix(key + np.uint64(0xA0761D6478BD642F))
    out = x.copy()
    todo = np.arange(x.size)
    while len(todo):
        value, lows = out[todo], low[todo]
        right, left = value & low_mask[todo], value >> lows
        for r in range(ROUNDS):
            if r % 2:
                right = right ^ (mix(left ^ keys[todo] ^ seeds[r]) & low_mask[todo])
            else:
                left = left ^ (mix(right ^ keys[todo] ^ seeds[r]) & high_mask[todo])
        out[todo] = (left << lows) | right
        todo = todo[out[todo] >= n[todo]]
    return out.astype(np.int64)
