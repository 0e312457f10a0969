"""Toxicity by FTRL-proximal logistic regression over hashed word features.

Features of a text are the hashes of its words, word pairs and pairs with one word
between (skip-grams), each counted once. Training runs on a bounded sample of
labelled rows: shards of it take FTRL-proximal steps from the same state
(per-coordinate learning rates, L1 keeps most weights at exactly zero), and the
shards' states are averaged by coordinate after each round. The weights that are
not zero are broadcast; every text is scored whole.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.llm.common import labelled_sample, written
from starloom.llm.wordhash import chunks, mix, words

_PAIR, _SKIP = np.uint64(0x9FB21C651E98DF25), np.uint64(0xD1B54A32D192ED03)


@dataclass(frozen=True)
class Settings:
    """Training parameters. ``sample``: labelled rows used at most (in
    expectation); ``bits``: weights are 2^bits at most; ``passes``: of each shard
    over its rows before the states are averaged."""

    sample: int = 24_000
    shards: int = 4
    rounds: int = 4
    passes: int = 2
    bits: int = 18
    alpha: float = 3.0
    beta: float = 1.0
    l1: float = 3.0
    l2: float = 0.1


def features(batch: list[bytes], bits: int) -> tuple[np.ndarray, np.ndarray]:
    """(text index, feature) of every word, pair and skip-gram of lower-cased texts;
    repeats included; features never span two texts."""
    h, offsets = words(batch)
    owner = np.repeat(np.arange(len(batch)), np.diff(offsets))
    shift = np.uint64(64 - bits)
    rows, found = [owner], [(h * _PAIR) >> shift]
    for gap, factor in ((1, _PAIR), (2, _SKIP)):
        if len(h) > gap:
            same = owner[gap:] == owner[:-gap]
            rows.append(owner[gap:][same])
            found.append(mix(h[:-gap] * factor + h[gap:])[same] >> shift)
    return np.concatenate(rows), np.concatenate(found).astype(np.int64)


class Ftrl:
    """FTRL-proximal state: gradient sums z and squared sums n; the last
    coordinate is the bias, which L1 does not touch."""

    def __init__(self, settings: Settings, z: np.ndarray | None = None, n: np.ndarray | None = None):
        self.s = settings
        size = (1 << settings.bits) + 1
        self.z = np.zeros(size) if z is None else z.copy()
        self.n = np.zeros(size) if n is None else n.copy()
        self.touched = np.zeros(size, bool)

    def weights(self, at: np.ndarray) -> np.ndarray:
        s, z = self.s, self.z[at]
        l1 = np.where(at == len(self.z) - 1, 0.0, s.l1)
        w = -(z - np.sign(z) * l1) / ((s.beta + np.sqrt(self.n[at])) / s.alpha + s.l2)
        return np.where(np.abs(z) > l1, w, 0.0)

    def learn(self, at: np.ndarray, label: float) -> None:
        """One step on a text with the distinct features ``at``."""
        at = np.append(at, len(self.z) - 1)
        w = self.weights(at)
        g = 1.0 / (1.0 + np.exp(-np.clip(w.sum(), -35, 35))) - label
        sigma = (np.sqrt(self.n[at] + g * g) - np.sqrt(self.n[at])) / self.s.alpha
        self.z[at] += g - sigma * w
        self.n[at] += g * g
        self.touched[at] = True


def distinct_features(texts: list[str | None], bits: int) -> Iterator[np.ndarray]:
    """The distinct features of each text."""
    for _, batch in chunks(texts):
        owner, found = features(batch, bits)
        keys = np.unique((owner << bits) | found)
        cuts = np.searchsorted(keys, np.arange(1, len(batch)) << bits)
        for part in np.split(keys, cuts):
            yield part & ((1 << bits) - 1)


def packed(found: np.ndarray) -> bytes:
    """Ascending features as compressed differences: the training rows are shuffled in every round."""
    return zstandard.ZstdCompressor().compress(np.diff(found, prepend=0).astype("<u4").tobytes())


def unpacked(data: bytes) -> np.ndarray:
    return np.cumsum(np.frombuffer(zstandard.ZstdDecompressor().decompress(data), "<u4").astype(np.int64))


def _featured(bits: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = [packed(x) for x in distinct_features(batch["text"].tolist(), bits)]
            yield batch.drop(columns="text").assign(features=found)

    return run


def _train(settings: Settings, z: np.ndarray, n: np.ndarray, turn: int):
    def run(rows: pd.DataFrame) -> pd.DataFrame:
        model = Ftrl(settings, z, n)
        rows = rows.sort_values(["order", "doc_id"])
        texts = [unpacked(x) for x in rows["features"]]
        labels = rows["label"].to_numpy()
        for k in range(settings.passes):
            for i in np.random.default_rng([turn, k]).permutation(len(rows)):
                model.learn(texts[i], labels[i])
        at = np.flatnonzero(model.touched)
        return pd.DataFrame({"feature": at, "z": model.z[at] - z[at], "n": model.n[at] - n[at]})

    return run


def fit(docs: DataFrame, labels: DataFrame, settings: Settings = Settings()) -> tuple[np.ndarray, np.ndarray, float]:
    """(features, weights, bias) from ``docs`` (doc_id, text) and ``labels`` (doc_id,
    label 0 or 1; nulls are ignored). Without rows there are no weights and the bias
    is 0."""
    order = F.xxhash64(F.lit("order"), "doc_id", "text")
    texts = (labelled_sample(docs.select("doc_id", "text"), labels, settings.sample)
             .select("doc_id", "text", F.col("label").cast("double").alias("label"), order.alias("order")))
    rows = written(texts.mapInPandas(_featured(settings.bits), "doc_id long, label double, `order` long, features binary")
                   .withColumn("shard", F.pmod("order", F.lit(settings.shards))), "labelled")
    model = Ftrl(settings)
    for turn in range(settings.rounds):
        moved = (rows.groupBy("shard").applyInPandas(_train(settings, model.z, model.n, turn),
                                                     "feature long, z double, n double")
                 .groupBy("feature").agg((F.sum("z") / settings.shards).alias("z"),
                                         (F.sum("n") / settings.shards).alias("n"))
                 .toPandas())  # 2^bits + 1 rows at most
        model.z[moved["feature"]] += moved["z"]
        model.n[moved["feature"]] += moved["n"]
    every = np.arange(len(model.z))
    w = model.weights(every)
    at = np.flatnonzero(w[:-1])
    return at, w[at], float(w[-1])


def scores(texts: list[str | None], at: np.ndarray, w: np.ndarray, bias: float, bits: int) -> np.ndarray:
    """Probability of the label for each whole text."""
    dense = np.zeros(1 << bits)
    dense[at] = w
    used = dense != 0
    out = np.empty(len(texts))
    for first, batch in chunks(texts):
        owner, found = features(batch, bits)
        hit = used[found]
        keys = np.unique((owner[hit] << bits) | found[hit])
        total = np.bincount(keys >> bits, dense[keys & ((1 << bits) - 1)], len(batch)) + bias
        out[first:first + len(batch)] = 1.0 / (1.0 + np.exp(-np.clip(total, -35, 35)))
    return out


def score(docs: DataFrame, model: tuple[np.ndarray, np.ndarray, float], settings: Settings = Settings(),
          text_col: str = "text", score_col: str = "score") -> DataFrame:
    """``docs`` with ``score_col`` (0 to 1). Null, empty and word-free texts get the
    bias's score. Rows, repeats and other columns are kept; a column of the same
    name is replaced. An empty table stays empty."""
    at, w, bias = model
    shared = docs.sparkSession.sparkContext.broadcast((at, w.astype(np.float64), bias))

    @F.pandas_udf("double")
    def probability(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in parts:
            yield pd.Series(scores(texts.tolist(), *shared.value, settings.bits))

    return docs.withColumn(score_col, probability(F.col(text_col)))
