"""Quality by compression against two dictionaries.

zstandard dictionaries are built from good and from bad labelled texts of a bounded
sample. A text that compresses better with the good one resembles good text: the
normalised difference of its two compressed sizes is turned into a probability by
a logistic curve fitted on other rows of the sample. Texts are compressed
in consecutive pieces, so that the dictionaries count over a whole long text.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starloom.llm.common import labelled_sample, written


#: Pieces that a dictionary can be trained on, at least.
LEAST = 7


@dataclass(frozen=True)
class Settings:
    """``sample``: labelled rows of either label used at most (in expectation);
    ``excerpts``: pieces of ``excerpt`` characters of a labelled row that train, chosen by a
    hash over its whole text; ``dictionary``: bytes of each dictionary; ``piece``: bytes
    compressed at once."""

    sample: int = 3_000
    excerpts: int = 8
    excerpt: int = 250
    dictionary: int = 1 << 17
    piece: int = 1_024
    level: int = 3


@dataclass(frozen=True)
class Model:
    """Two dictionaries and the weights of the curve."""

    good: bytes
    bad: bytes
    weights: tuple[float, ...]
    settings: Settings


def _excerpts(settings: Settings) -> Column:
    """The chosen pieces of ``text``, in their order."""
    last = F.floor((F.length("text") - 1) / settings.excerpt)
    places = F.array_sort(F.transform(F.sequence(F.lit(0), F.greatest(last, F.lit(0)).cast("int")), lambda k: F.struct(
        F.xxhash64(F.lit("piece"), "doc_id", k).alias("h"), k.alias("k"))))
    kept = F.array_sort(F.transform(F.slice(places, 1, settings.excerpts), lambda x: x["k"]))
    return F.transform(kept, lambda k: F.substring("text", k * settings.excerpt + 1, F.lit(settings.excerpt)))


class Sizes:
    """Compressed sizes of texts with either dictionary."""

    def __init__(self, good: bytes, bad: bytes, settings: Settings):
        self.piece = settings.piece
        self.compress = []
        for content in (good, bad):
            options = {"level": settings.level, "write_content_size": False, "write_checksum": False,
                       "write_dict_id": False}
            if content:
                options["dict_data"] = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_FULLDICT)
                options["dict_data"].precompute_compress(level=settings.level)
            self.compress.append(zstandard.ZstdCompressor(**options).compress)

    def __call__(self, text: str | None) -> tuple[int, int, int]:
        """(size by the good, by the bad dictionary, bytes) of a whole text."""
        data = memoryview((text or "").encode("utf-8", "replace"))
        good, bad = self.compress
        pieces = [data[a:a + self.piece] for a in range(0, len(data), self.piece)]
        return sum(len(good(x)) for x in pieces), sum(len(bad(x)) for x in pieces), len(data)


def measures(sizes: np.ndarray) -> np.ndarray:
    """Columns: 1, the normalised difference (positive: nearer to good text), the
    compression ratio, the log of the length. Empty texts: 1, 0, 0, 0."""
    good, bad, raw = sizes.astype(np.float64).T
    return np.stack([np.ones(len(raw)), 20 * (bad - good) / np.maximum(bad + good, 1),
                     np.minimum(good, bad) / np.maximum(raw, 1), np.log1p(raw) / 10], 1)


def _logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Weighted logistic regression by Newton steps, with a small ridge."""
    w = np.zeros(x.shape[1])
    for _ in range(60):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        hessian = x.T @ (x * (weight * p * (1 - p))[:, None]) + 1e-2 * np.eye(len(w))
        w = w + np.linalg.solve(hessian, x.T @ (weight * (y - p)) - 1e-2 * w)
    return w


def fit(docs: DataFrame, labels: DataFrame, settings: Settings = Settings()) -> Model:
    """A model from ``docs`` (doc_id, text) and ``labels`` (doc_id, label 1 good or 0
    bad; nulls are ignored). Half of the sample (by a hash of the id) builds the
    dictionaries, the other half fits the curve, each label weighted to its share of all
    labels. Both are bounded by ``settings.sample`` whatever the input. Of fewer than
    LEAST pieces of either label nothing can be learned: every text then gets the share of good labels
    (0.5 without labels) as its score."""
    counts = {int(r["label"]): r["count"] for r in labels.groupBy("label").count().where("label in (0, 1)").collect()}
    learn, curve = [], []
    half = F.pmod(F.xxhash64(F.lit("half"), "doc_id"), F.lit(2))
    for label in (0, 1):
        rows = written(labelled_sample(docs.select("doc_id", "text"), labels.where(F.col("label") == label),
                                       2 * settings.sample).withColumn("half", half), "labelled")
        pieces = rows.where("half = 0 and text <> ''").orderBy("doc_id", "text").select(F.explode(_excerpts(settings)).alias("x"))
        learn.append([r["x"].encode() for r in pieces.collect()])
        curve.append(rows.where("half = 1").select("label", "text"))
    if min(map(len, learn)) < LEAST:
        share = (counts.get(1, 0) + 1) / (sum(counts.values()) + 2)
        return Model(b"", b"", (float(np.log(share / (1 - share))), 0.0, 0.0, 0.0), settings)
    bad, good = (zstandard.train_dictionary(settings.dictionary, x, level=settings.level).as_bytes() for x in learn)
    model = Model(good, bad, (), settings)
    rows = _sized(curve[0].unionByName(curve[1]), model, "text").select("label", "_sizes.*").toPandas()
    y = rows["label"].to_numpy(np.float64)
    share = {k: counts.get(k, 0) / max((y == k).sum(), 1) for k in (0, 1)}
    weight = np.where(y == 1, share[1], share[0]) * len(y) / max(sum(counts.values()), 1)
    w = _logistic(measures(rows[["good", "bad", "raw"]].to_numpy()), y, weight)
    return Model(good, bad, tuple(w.tolist()), settings)


def _sized(docs: DataFrame, model: Model, text_col: str) -> DataFrame:
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("good long, bad long, raw long")
    def sizes(parts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        of = Sizes(shared.value.good, shared.value.bad, shared.value.settings)
        for texts in parts:
            yield pd.DataFrame([of(t) for t in texts.tolist()], columns=["good", "bad", "raw"])

    return docs.withColumn("_sizes", sizes(F.col(text_col)))


def score(docs: DataFrame, model: Model, text_col: str = "text", score_col: str = "score") -> DataFrame:
    """``docs`` with ``score_col`` (0 to 1, higher: better). Null and empty texts get the
    curve's value at size 0. Rows, repeats and other columns are kept, a column of
    the same name is replaced; an empty table stays empty."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def probability(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        of, w = Sizes(shared.value.good, shared.value.bad, shared.value.settings), np.array(shared.value.weights)
        for texts in parts:
            sizes = np.array([of(t) for t in texts.tolist()], np.int64).reshape(-1, 3)
            yield pd.Series(1 / (1 + np.exp(-np.clip(measures(sizes) @ w, -30, 30))))

    return docs.withColumn(score_col, probability(F.col(text_col)))
