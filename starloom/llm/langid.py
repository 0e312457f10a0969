"""Language identification by bit-sliced Bloom filters of n-grams.

Each language has a Bloom filter of its most frequent 4-byte grams (of letters and
single blanks, lower case). The filters are stored sliced: row p of the table holds
bit p of every language's filter, so the AND of a gram's rows is the mask of all
languages that contain it. A text's count for a language is the popcount of that
language's bit over all its grams, corrected for the false positives that the
filter's fill makes likely; the largest corrected count decides.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from starloom.llm.common import bounded_sample, free_names, written
from starloom.llm.wordhash import chunks, mix

_LETTER = np.full(256, 0x20, np.uint8)
_LETTER[0x80:] = np.arange(0x80, 0x100)
_LETTER[0x61:0x7B] = np.arange(0x61, 0x7B)


@dataclass(frozen=True)
class Settings:
    """``sample``: labelled rows used at most (in expectation); ``grams``: of each
    language kept; ``bits``: the filters have 2^bits rows; ``probes``: rows a gram
    sets and reads."""

    sample: int = 20_000
    grams: int = 2_000
    bits: int = 17
    probes: int = 3


@dataclass(frozen=True)
class Model:
    """``names[l]`` is the language of bit l; ``table`` has one mask of 64 languages
    in each column; ``false_positives[l]`` is the chance that a gram that l lacks passes."""

    names: tuple[str, ...]
    table: np.ndarray
    false_positives: np.ndarray
    settings: Settings


def grams(batch: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(4-byte grams as numbers, offsets): the grams of lower-cased text i are
    ``offsets[i]:offsets[i + 1]``. Anything but ASCII letters and bytes above 0x7F
    counts as a blank, runs of blanks as one."""
    lengths = np.fromiter((len(x) + 2 for x in batch), np.int64, len(batch))
    data = _LETTER[np.frombuffer(b" " + b"  ".join(batch) + b" ", np.uint8)]
    keep = np.ones(len(data), bool)
    keep[1:] = (data[1:] != 0x20) | (data[:-1] != 0x20)
    starts = np.cumsum(lengths) - lengths
    keep[starts] = True
    data = data[keep]
    begins = np.concatenate(([0], np.cumsum(np.add.reduceat(keep.astype(np.int64), starts))))
    if len(data) < 4:
        return np.zeros(0, np.uint32), np.zeros(len(batch) + 1, np.int64)
    wide = data.astype(np.uint32)
    found = wide[:-3] | wide[1:-2] << 8 | wide[2:-1] << 16 | wide[3:] << 24
    inside = np.ones(len(found), bool)
    for back in (1, 2, 3):
        ends = begins[1:-1] - back
        inside[ends[(ends >= 0) & (ends < len(found))]] = False
    kept = np.concatenate(([0], np.cumsum(inside)))
    return found[inside], kept[np.minimum(begins, len(found))]


def rows_of(found: np.ndarray, settings: Settings) -> list[np.ndarray]:
    """The table rows of each gram."""
    h = mix(found.astype(np.uint64) + np.uint64(0x9E3779B97F4A7C15))
    mask = np.uint64((1 << settings.bits) - 1)
    return [((h >> np.uint64(20 * i)) & mask).astype(np.int64) for i in range(settings.probes)]


def build(by_language: dict[str, np.ndarray], settings: Settings) -> Model:
    """The sliced filters of the given grams of each language."""
    names = tuple(sorted(by_language))
    table = np.zeros((1 << settings.bits, max(1, -(-len(names) // 64))), np.uint64)
    fill = np.zeros(len(names))
    for bit, name in enumerate(names):
        for rows in rows_of(by_language[name], settings):
            table[rows, bit // 64] |= np.uint64(1 << bit % 64)
        fill[bit] = ((table[:, bit // 64] >> np.uint64(bit % 64)) & np.uint64(1)).mean()
    return Model(names, table, fill ** settings.probes, settings)


def predict(texts: list[str | None], model: Model) -> tuple[list[str | None], np.ndarray]:
    """The language of each text and its share of all corrected counts. Without
    any count the first name and 0; without a learned language None and 0."""
    names, scores = [], np.zeros(len(texts))
    if not model.names:
        return [None] * len(texts), scores
    for first, batch in chunks(texts):
        found, offsets = grams(batch)
        masks = None
        for rows in rows_of(found, model.settings):
            masks = model.table[rows] if masks is None else masks & model.table[rows]
        counts = np.empty((len(batch), len(model.names)))
        for bit in range(len(model.names)):
            hits = np.concatenate(([0], np.cumsum((masks[:, bit // 64] >> np.uint64(bit % 64)) & np.uint64(1), dtype=np.int64)))
            counts[:, bit] = hits[offsets[1:]] - hits[offsets[:-1]]
        total = np.diff(offsets)[:, None]
        counts = np.maximum((counts - total * model.false_positives) / (1 - np.minimum(model.false_positives, 0.99)), 0)
        best = counts.argmax(1)
        names.extend(model.names[b] for b in best)
        whole = counts.sum(1)
        scores[first:first + len(batch)] = np.where(whole > 0, counts.max(1) / np.maximum(whole, 1e-9), 0)
    return names, scores


def _counted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        for lang, rows in batch.groupby("lang"):
            for _, texts in chunks(rows["text"].tolist()):
                found, times = np.unique(grams(texts)[0], return_counts=True)
                yield pd.DataFrame({"lang": lang, "gram": found.astype(np.int64), "times": times})


def fit(docs: DataFrame, settings: Settings = Settings()) -> Model:
    """A model from rows (doc_id, text, lang); null languages and texts are ignored.
    Counts of a bounded sample are summed by Spark and each language's most frequent
    grams (ties: the smaller number) come to the driver."""
    known = docs.where("lang is not null and text is not null").select("doc_id", "text", "lang")
    sample = bounded_sample(known, "doc_id", settings.sample)
    counts = (sample.select("lang", "text").mapInPandas(_counted, "lang string, gram long, times long")
              .groupBy("lang", "gram").agg(F.sum("times").alias("times")))
    place = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("times"), "gram"))
    top = written(counts.withColumn("place", place).where(F.col("place") <= settings.grams), "grams").toPandas()
    return build({lang: rows["gram"].to_numpy().astype(np.uint32) for lang, rows in top.groupby("lang")}, settings)


def identify(docs: DataFrame, model: Model, text_col: str = "text", lang_col: str = "lang_pred",
             score_col: str = "score") -> DataFrame:
    """``docs`` with ``lang_col`` and ``score_col`` (0 to 1, the language's share of
    all languages' corrected counts). A null text, a text without a letter, and any text
    if no language was learned, is ``und`` with score 0. Rows, repeats and other columns are kept;
    columns of the same names are replaced; an empty table stays empty."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("lang string, score double")
    def language(parts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in parts:
            names, scores = predict(texts.tolist(), shared.value)
            yield pd.DataFrame({"lang": names, "score": scores})

    letters = F.coalesce(F.col(text_col).rlike(r"\p{L}"), F.lit(False))
    of, has = free_names(docs, 2)
    found = docs.withColumn(of, language(F.col(text_col))).withColumn(has, letters)
    return (found.withColumn(lang_col, F.when(F.col(has), F.coalesce(F.col(of)["lang"], F.lit("und"))).otherwise("und"))
            .withColumn(score_col, F.when(F.col(has), F.col(of)["score"]).otherwise(F.lit(0.0))).drop(of, has))
