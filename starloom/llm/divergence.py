"""Divergences between the term distributions of the sources of a language.

Each task lower-cases and splits its texts with Arrow compute kernels, encodes
the terms as a dictionary and groups the codes by hash, so a shuffle sees one
partial count for a task's (language, source, term). The merged counts are dealt
by language and term into columnar shards; a shard fills a block of terms by
sources and adds up the divergences of every pair of sources over its terms.
All numbers are integers from end to end.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from starloom.llm.common import written

#: What stands between terms: bytes of ASCII but letters.
BETWEEN = r"[\x00-\x40\x5B-\x60\x7B-\x7F]+"
ONE = 1_000_000_000
#: Bytes of text that are split at once.
CHUNK = 1 << 20
#: Partial counts that a task holds before it merges them, and after that sends them on.
HELD = 400_000
#: Cells of a block of terms by sources.
CELLS = 1 << 20
PARTIAL = "lang string, source string, term string, n long, docs long"


@dataclass(frozen=True)
class Settings:
    """``min_docs``: documents of a language that keep a term; ``top``: ranks of terms;
    ``shard_rows``: counts that a columnar shard has on average."""

    min_docs: int = 10
    top: int = 10
    shard_rows: int = 1 << 15


def _pieces(text: str) -> Iterator[str]:
    """Parts of a long text, cut where no term stands; together they are the text."""
    at = 0
    while at < len(text):
        end = min(at + CHUNK // 4, len(text))
        while end < len(text) and ("A" <= text[end] <= "Z" or "a" <= text[end] <= "z" or text[end] >= "\x80"):
            end += 1
        yield text[at:end]
        at = end


def term_counts(texts: pa.Array, rows: pa.Array) -> pa.Table:
    """(row, term, n): how often each term stands in the texts of each row number."""
    lists = pc.split_pattern_regex(pc.ascii_lower(texts), pattern=BETWEEN)
    terms = lists.flatten()
    encoded = terms.dictionary_encode()
    codes = pa.table({"row": rows.take(pc.list_parent_indices(lists)), "code": encoded.indices})
    counted = codes.filter(pc.not_equal(terms, "")).group_by(["row", "code"]).aggregate([([], "count_all")])
    return pa.table({"row": counted["row"], "term": pc.take(encoded.dictionary, counted["code"]),
                     "n": counted["count_all"]})


def _chunks(texts: pa.Array) -> Iterator[pa.Table]:
    """The counts of consecutive texts, split a bounded number of bytes at a time; the
    counts of a row are whole in one table."""
    sizes = pc.binary_length(texts).to_pylist()
    first, held = 0, 0
    numbers = pa.array(np.arange(len(texts), dtype=np.int32))
    for i, size in enumerate([*sizes, CHUNK]):
        if held and held + size > CHUNK:
            yield term_counts(texts.slice(first, i - first), numbers.slice(first, i - first))
            first, held = i, 0
        if size > CHUNK and i < len(texts):
            parts = [term_counts(pa.array([x]), numbers.slice(i, 1)) for x in _pieces(texts[i].as_py())]
            yield pa.concat_tables(parts).group_by(["row", "term"]).aggregate([("n", "sum")]).rename_columns(["row", "term", "n"])
            first = i + 1
        else:
            held += size


def _merge(tables: list[pa.Table]) -> pa.Table:
    keys = ["lang", "source", "term"]
    return (pa.concat_tables(tables).group_by(keys).aggregate([("n", "sum"), ("docs", "sum")])
            .rename_columns([*keys, "n", "docs"]))


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Partial counts of a task; a group's empty term says that the group occurs."""
    held, size = [], 0
    for batch in batches:
        lang, source = batch.column("lang"), batch.column("source")
        for found in _chunks(batch.column("text")):
            one = pa.array(np.ones(len(found), np.int64))
            held.append(pa.table({"lang": lang.take(found["row"].combine_chunks()), "source": source.take(found["row"].combine_chunks()),
                                  "term": found["term"], "n": found["n"].cast(pa.int64()), "docs": one}))
            size += len(found)
            if size > HELD:
                held = [_merge(held)]
                size = len(held[0])
                if size > HELD // 2:
                    yield from held[0].to_batches()
                    held, size = [], 0
        zero = pa.array(np.zeros(batch.num_rows, np.int64))
        held.append(_merge([pa.table({"lang": lang, "source": source, "term": pa.array([""] * batch.num_rows), "n": zero, "docs": zero})]))
    if held:
        yield from _merge(held).to_batches()


def counts(docs: DataFrame, lang_col: str = "lang", source_col: str = "source", text_col: str = "text") -> DataFrame:
    """(lang, source, term, n, docs): occurrences of each term in the texts of each group
    and the documents that hold it; the empty term, with zeros, for every group."""
    whole = docs.select(*[F.coalesce(F.col(c), F.lit("")).alias(n)
                          for c, n in ((lang_col, "lang"), (source_col, "source"), (text_col, "text"))])
    return (whole.mapInArrow(_counted, PARTIAL).groupBy("lang", "source", "term")
            .agg(F.sum("n").alias("n"), F.sum("docs").alias("docs")))


def chances(n: np.ndarray, total: int, kept: int) -> np.ndarray:
    """1 + floor(ONE * (n + 2) / (total + 2 * kept)), exact for any 64-bit counts."""
    if int(n.max(initial=0)) < (1 << 63) // ONE - 2:
        return 1 + ONE * (n + 2) // max(total + 2 * kept, 1)
    return np.array([1 + ONE * (int(x) + 2) // max(total + 2 * kept, 1) for x in n], np.int64)


def _parted(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) ** 2 // (p + q)


def _shard(settings: Settings):
    """Pair sums and the best terms of one shard of a language."""

    def run(key: tuple, rows: pa.Table, groups: pa.Table) -> pa.Table:
        groups = groups.sort_by("source")
        names, kept = groups["source"].combine_chunks(), groups["kept"][0].as_py()
        totals, whole = groups["total"].to_pylist(), groups["whole"][0].as_py()
        column = pc.index_in(rows["source"], names).to_numpy()
        encoded = rows["term"].combine_chunks().dictionary_encode()
        code, n = encoded.indices.to_numpy(), rows["n"].to_numpy()
        p = np.empty(len(n), np.int64)
        for s in range(len(names)):
            own = column == s
            p[own] = chances(n[own], totals[s], kept)
        q = chances(rows["lang_n"].to_numpy(), whole, kept)
        missing = np.array([chances(np.zeros(1, np.int64), t, kept)[0] for t in totals])
        sums = np.zeros((len(names), len(names)), np.int64)
        order = np.argsort(code, kind="stable")
        terms, step = len(encoded.dictionary), max(1, CELLS // len(names))
        for first in range(0, terms, step):
            own = order[np.searchsorted(code[order], first):np.searchsorted(code[order], first + step)]
            block = np.repeat(missing[:, None], min(step, terms - first), 1)
            block[column[own], code[own] - first] = p[own]
            for s in range(len(names) - 1):
                sums[s, s + 1:] += _parted(block[s], block[s + 1:]).sum(1)
        a, b = np.triu_indices(len(names), 1)
        value = _parted(p, q)
        better = np.flatnonzero((n > 0) & (p > q))
        found = pa.table({"column": pa.array(column[better]), "term": rows["term"].take(pa.array(better)), "value": pa.array(value[better])})
        found = found.sort_by([("column", "ascending"), ("value", "descending"), ("term", "ascending")])
        of = found["column"].to_numpy()
        place = np.arange(len(of)) - np.searchsorted(of, of)
        found = found.filter(pa.array(place < settings.top))
        lang, n_pairs = key[0].as_py(), len(a)
        return pa.table({
            "lang": pa.array([lang] * (n_pairs + len(found)), pa.string()),
            "source": pa.concat_arrays([names.take(pa.array(a)), names.take(found["column"].combine_chunks())]),
            "other": pa.concat_arrays([names.take(pa.array(b)), pa.nulls(len(found), pa.string())]),
            "term": pa.concat_arrays([pa.nulls(n_pairs, pa.string()), found["term"].combine_chunks()]),
            "value": pa.concat_arrays([pa.array(sums[a, b]), found["value"].combine_chunks()])})

    return run


def divergences(docs: DataFrame, settings: Settings = Settings(), lang_col: str = "lang", source_col: str = "source",
                text_col: str = "text") -> DataFrame:
    """Rows (lang, source, part, item, value, rank) for every group (lang, source) of ``docs``.

    Part ``pair``: the divergence from every other source of the language, summed over the
    language's kept terms (0 if it keeps none). Part ``term``: the ``settings.top`` terms most
    over-represented against the whole language. Ranks by value, descending, then by item.
    Null texts, languages and sources are empty ones; a group of empty texts occurs
    too. Repeated rows are documents of their own, other columns are ignored, an empty table gives
    no rows. Memory: a task holds HELD partial counts, CHUNK bytes of split text and one shard;
    the pair sums of a shard have a cell for each pair of sources, as the result itself has.
    """
    merged = written(counts(docs, lang_col, source_col, text_col), "term-counts")
    term = Window.partitionBy("lang", "term")  # a row a source
    kept = written(merged.where("term <> ''").withColumn("in_docs", F.sum("docs").over(term))
                   .withColumn("lang_n", F.sum("n").over(term))
                   .withColumn("first", (F.row_number().over(term.orderBy("source")) == 1).cast("long"))
                   .where(F.col("in_docs") >= settings.min_docs)
                   .select("lang", "source", "term", "n", "lang_n", "first"), "kept-terms")
    per_group = (kept.groupBy("lang", "source").agg(F.sum("n").alias("total"), F.sum("first").alias("first"))
                 .unionByName(merged.where("term = ''").select("lang", "source", F.lit(0).cast("long").alias("total"),
                                                               F.lit(0).cast("long").alias("first")))
                 .groupBy("lang", "source").agg(F.sum("total").alias("total"), F.sum("first").alias("first")))
    of_lang = Window.partitionBy("lang")  # the sources of a language: the result has a row for each pair of them
    groups = written(per_group.select("lang", "source", "total", F.sum("total").over(of_lang).alias("whole"),
                                      F.sum("first").over(of_lang).alias("kept")), "groups")
    shards = max(1, -(-kept.count() // settings.shard_rows))
    dealt = kept.withColumn("shard", F.pmod(F.xxhash64(F.lit("shard"), "term"), F.lit(shards)))
    copies = groups.where("kept > 0").withColumn("shard", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(shards - 1).cast("long"))))
    found = written(dealt.groupBy("lang", "shard").cogroup(copies.groupBy("lang", "shard"))
                    .applyInArrow(_with_rows(_shard(settings)), "lang string, source string, other string, term string, value long"), "divergences")
    sums = found.where("other is not null").groupBy("lang", "source", "other").agg(F.sum("value").alias("value"))
    both = sums.select("lang", F.explode(F.array(F.struct("source", F.col("other").alias("item")),
                                                 F.struct(F.col("other").alias("source"), F.col("source").alias("item")))).alias("x"),
                       "value").select("lang", "x.source", "x.item", "value")
    others = groups.where("kept = 0").select("lang", "source")
    none = (others.join(others.select("lang", F.col("source").alias("item")), "lang").where("source <> item")
            .select("lang", "source", "item", F.lit(0).cast("long").alias("value")))
    place = F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item"))

    def ranked(rows: DataFrame, part: str) -> DataFrame:
        return rows.select("lang", "source", F.lit(part).alias("part"), "item", "value", place.alias("rank"))

    terms = found.where("term is not null").select("lang", "source", F.col("term").alias("item"), "value")
    return ranked(both.unionByName(none), "pair").unionByName(ranked(terms, "term").where(F.col("rank") <= settings.top))


def _with_rows(shard):
    """A shard without a term has nothing to add."""

    def run(key: tuple, rows: pa.Table, groups: pa.Table) -> pa.Table:
        if rows.num_rows and groups.num_rows:
            return shard(key, rows, groups)
        text = pa.array([], pa.string())
        return pa.table({"lang": text, "source": text, "other": text, "term": text, "value": pa.array([], pa.int64())})

    return run
