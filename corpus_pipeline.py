"""Corpus pipeline: filter by quality, remove near-duplicates, pseudonymise,
mix sources to weights, encode.

``STAGES`` lists (name, function). Each function takes (spark, docs, sf_dir);
its result is written as Parquet and read again as the next one's ``docs``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.llm import bpe, mixing, ngram_join, pii, quality
from starloom.llm.common import table, written
from starloom.llm.queries import THRESHOLD, VOCABULARY, training_labels

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier, fitted on the labels, predicts as good."""
    model = quality.fit(docs, training_labels(spark, sf_dir, "quality", 5, 0))
    return quality.score(docs, model).where(F.col("score") >= THRESHOLD).select(*COLUMNS)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group stays, the smallest id."""
    return ngram_join.keep_one(docs).select(*COLUMNS)


def _counted(docs: DataFrame) -> DataFrame:
    """The columns of documents, the characters counted anew."""
    return docs.withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def pseudonymise(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data replaced by pseudonyms of the same format."""
    return _counted(pii.pseudonymise(docs))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents mixed to the sources' weights: a row for every pass that takes
    words of a document, with these words."""
    return _counted(mixing.mix(docs))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every mixed document."""
    coded = bpe.encode(docs.select("doc_id", "source", "text"), VOCABULARY)
    return coded.select("doc_id", "source", F.size("token_ids").cast("long").alias("n_tokens"), "token_ids")


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality", keep_quality),
    ("ngram_join", drop_near_duplicates),
    ("pii", pseudonymise),
    ("mixing", mix_sources),
    ("bpe", encode),
]

#: The stages hold trained models, keyed permutations and token ids.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each stage's rows written and read again."""
    docs = table(spark, sf_dir, "documents", *COLUMNS)
    for at, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if at + 1 < len(STAGES):
            docs = written(docs, name)
    return docs
