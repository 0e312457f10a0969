"""N-gram Jaccard self-join with Bayesian candidate pruning.

Every document's set of five-word shingles gets a MinHash signature. Documents
that share a band of it are candidates. Their signatures are compared a few
values at a time; after each step a pair is dropped when the posterior
probability (uniform prior on the similarity) that it reaches the threshold
is below a tolerance. What is left is verified exactly on the shingle sets.

Documents with the same shingle set form one class and take part once, so
thousands of copies cost one row. Groups of different but similar texts are
split into blocks of bounded size, and block pairs are compared by array
operations that return counts and spanning edges, never a row for each pair.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import comb

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.llm.common import written
from starloom.llm.graph import block_pairs, connected_components, grouped, spanning
from starloom.llm.wordhash import shingle_sets

HASHES, ROWS, STEP = 128, 4, 16
BANDS = HASHES // ROWS
#: Members of a block; a task holds two blocks' members at once.
BLOCK = 384
#: Shingles of a block in the exact step.
BLOCK_SHINGLES = 1 << 20
#: Representatives up to which their ids may be broadcast (16 bytes each).
BROADCAST_ROWS = 2_000_000
_PAIRS = 1 << 17

_rng = np.random.default_rng(20240229)
_FACTOR = _rng.integers(0, 1 << 32, HASHES, np.uint32) | np.uint32(1)
_SHIFT = _rng.integers(0, 1 << 32, HASHES, np.uint32)


def signature(shingle_set: np.ndarray) -> np.ndarray:
    """128 MinHash values of a non-empty set, as their high 16 bits after mixing."""
    base = (shingle_set >> np.uint64(32)).astype(np.uint32)
    least = np.full(HASHES, 0xFFFFFFFF, np.uint32)
    for at in range(0, len(base), 512):
        np.minimum(least, (base[at:at + 512, None] * _FACTOR + _SHIFT).min(0), out=least)
    least = (least ^ (least >> np.uint32(15))) * np.uint32(0x2C1B3C6D)
    return (least >> np.uint32(16)).astype(np.uint16)


def least_matches(threshold: float, tolerance: float) -> dict[int, int]:
    """For n compared values the fewest matches with which the posterior
    probability of reaching ``threshold`` is at least ``tolerance``.

    With a uniform prior, P(J >= t | m of n) = P(Binomial(n + 1, t) <= m)."""
    out = {}
    for n in range(STEP, HASHES + 1, STEP):
        p = 0.0
        for m in range(n + 1):
            p += comb(n + 1, m) * threshold**m * (1 - threshold) ** (n + 1 - m)
            if p >= tolerance:
                out[n] = m
                break
    return out


def _sketches(width: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for s in shingle_sets(batch["text"].tolist(), width):
                if len(s):
                    mixed = s * np.uint64(0x9E3779B97F4A7C15) ^ (s >> np.uint64(29))
                    rows.append((int(np.bitwise_xor.reduce(mixed).view(np.int64)),
                                 int(s.sum(dtype=np.uint64).view(np.int64)), len(s), signature(s).tobytes()))
                else:
                    rows.append((None, None, 0, None))
            # object columns: with a null beside them 64-bit numbers would turn into floats
            out = pd.DataFrame(rows, columns=["set_a", "set_b", "n", "sig"], dtype=object)
            out.insert(0, "doc_id", batch["doc_id"].to_numpy())
            yield out.astype({"set_a": "Int64", "set_b": "Int64", "n": "int32"})

    return run


def _pairs(first: np.ndarray, last: np.ndarray, side: np.ndarray, both: np.ndarray) -> Iterator[tuple]:
    """Index pairs i < j within each group [first, last), in slices. If ``both``
    (two different blocks meet in the group) only pairs across its two sides."""
    position = np.arange(len(side))
    start = np.repeat(first, last - first)
    count = position - start  # row j pairs with the rows start..j-1 of its group
    total = np.concatenate(([0], np.cumsum(count)))
    at = 0
    while at < len(side):
        to = max(at + 1, int(np.searchsorted(total, total[at] + _PAIRS, "right")) - 1)
        n = count[at:to]
        j = np.repeat(position[at:to], n)
        i = np.arange(len(j)) - np.repeat(total[at:to] - total[at], n) + start[j]
        keep = ~both[j] | (side[i] != side[j])
        yield i[keep], j[keep]
        at = to


def _prune(need: dict[int, int]):
    """Spanning edges (u, v) of the pairs of each bucket that survive."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in grouped(batches, ["band", "bucket", "a", "b"]):
            sig = np.frombuffer(b"".join(rows["sig"]), np.uint16).reshape(-1, HASHES)
            bands = sig.view(np.uint64)
            band = rows["band"].to_numpy()
            keys = [rows[k].to_numpy() for k in ("band", "bucket", "a", "b")]
            new = np.concatenate(([True], np.any([k[1:] != k[:-1] for k in keys], axis=0)))
            first = np.flatnonzero(new)
            last = np.append(first[1:], len(rows))
            left, right = [], []
            for i, j in _pairs(first, last, rows["block"].to_numpy(), keys[2] != keys[3]):
                agree = bands[i] == bands[j]
                # same bucket by the band itself, and no earlier band has met the pair
                ok = agree[np.arange(len(i)), band[j]] & (agree.argmax(1) == band[j])
                i, j = i[ok], j[ok]
                matches = np.zeros(len(i), np.int64)
                for at in range(0, HASHES, STEP):
                    matches += (sig[i, at:at + STEP] == sig[j, at:at + STEP]).sum(1)
                    ok = matches >= need[at + STEP]
                    i, j, matches = i[ok], j[ok], matches[ok]
                left.append(i)
                right.append(j)
            label = spanning(len(rows), np.concatenate(left), np.concatenate(right))
            moved = np.flatnonzero(label != np.arange(len(rows)))
            ids = rows["rep"].to_numpy()
            yield pd.DataFrame({"u": ids[label[moved]], "v": ids[moved]})

    return run


def _shared_counts(sets: list[np.ndarray]) -> np.ndarray:
    """Sizes of all pairwise intersections, by products of 0/1 matrices over the
    shingles that at least two sets hold."""
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    values, index, times = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    common = np.flatnonzero(times > 1)
    place = np.full(len(values), -1)
    place[common] = np.arange(len(common))
    column = place[index]
    owner, column = owner[column >= 0], column[column >= 0]
    order = np.argsort(column, kind="stable")
    owner, column = owner[order], column[order]
    out = np.zeros((len(sets), len(sets)), np.float64)
    for at in range(0, len(common), 4096):
        lo, hi = np.searchsorted(column, (at, at + 4096))
        part = np.zeros((len(sets), min(4096, len(common) - at)), np.float32)
        part[owner[lo:hi], column[lo:hi] - at] = 1
        out += part @ part.T
    return out


def _verify(width: int, threshold: tuple[int, int]):
    """Exact links within each block pair: per member the documents linked
    (copies counted) and one spanning edge."""
    num, den = threshold

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in grouped(batches, ["component", "a", "b"]):
            for (_, a, b), group in rows.groupby(["component", "a", "b"], sort=False):
                sets = list(shingle_sets(group["text"].tolist(), width))
                size = np.array([len(s) for s in sets], np.float64)
                both = _shared_counts(sets)
                linked = both * (den + num) >= num * (size[:, None] + size[None, :])
                np.fill_diagonal(linked, False)
                block = group["block"].to_numpy()
                if a != b:
                    linked &= block[:, None] != block[None, :]
                copies = group["copies"].to_numpy()
                ids = group["rep"].to_numpy()
                label = spanning(len(ids), *np.nonzero(linked))
                yield pd.DataFrame({"rep": ids, "links": linked @ copies, "low": ids[label]})

    return run


def near_duplicates(docs: DataFrame, width: int = 5, threshold: tuple[int, int] = (4, 5),
                    tolerance: float = 1e-5, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: ``doc_id``, ``class_id`` (smallest id among the
    documents with the same shingle set), ``n_links`` (other documents at
    ``threshold`` or more, copies counted), ``component_id`` (smallest id reachable
    over links) and ``kept`` (it is that document).

    ``threshold`` is a fraction (numerator, denominator). Null, empty and word-free
    texts have no shingles and link with nothing; a text of 1 to ``width`` - 1
    words has one shingle of them all. Rows that repeat an id are one document (its smallest text). Rows
    with a null id are left out. Other columns are ignored. An empty table
    gives no rows.
    """
    need = least_matches(threshold[0] / threshold[1], tolerance)
    texts = (docs.where(F.col(id_col).isNotNull())
             .select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")))
    sketches = written(texts.mapInPandas(_sketches(width), "doc_id long, set_a long, set_b long, n int, sig binary"),
                       "sketches")
    repeated = sketches.groupBy("doc_id").count().where("count > 1").select("doc_id")
    if not repeated.isEmpty():
        extra = texts.join(repeated, "doc_id").groupBy("doc_id").agg(F.min("text").alias("text"))
        texts = texts.join(repeated, "doc_id", "left_anti").unionByName(extra)
        sketches = written(texts.mapInPandas(_sketches(width), sketches.schema), "sketches")
    has = sketches.where("n > 0")
    classes = written(has.groupBy("set_a", "set_b", "n")
                      .agg(F.min("doc_id").alias("rep"), F.count(F.lit(1)).alias("copies")), "classes")
    reps = has.join(classes.select(F.col("rep").alias("doc_id")), "doc_id").select(F.col("doc_id").alias("rep"), "sig")
    bands = F.posexplode(F.transform(F.sequence(F.lit(0), F.lit(BANDS - 1)),
                                     lambda b: F.xxhash64(b, F.substring("sig", b * (2 * ROWS) + 1, F.lit(2 * ROWS)))))
    keyed = reps.select("rep", bands.alias("band", "bucket"))
    full = (keyed.groupBy("band", "bucket").agg(F.count(F.lit(1)).alias("held")).where("held > 1"))
    shared = written(keyed.join(full, ["band", "bucket"]), "buckets")
    members = (shared.join(reps, "rep")
               .withColumn("blocks", F.ceil(F.col("held") / BLOCK).cast("int")).drop("held"))
    survivors = (block_pairs(members, ["band", "bucket"], "blocks")
                 .mapInPandas(_prune(need), "u long, v long"))
    groups = connected_components(survivors)
    sized = (groups.withColumnRenamed("node", "rep")
             .join(classes.select("rep", "copies", "n"), "rep"))
    weight = sized.groupBy("component").agg(
        F.greatest(F.ceil(F.count(F.lit(1)) / BLOCK),
                   F.ceil(F.sum("n") / BLOCK_SHINGLES)).cast("int").alias("blocks"))
    wanted = written(sized.join(weight, "component").drop("n"), "groups")
    few = wanted.count() <= BROADCAST_ROWS
    found = texts.join(F.broadcast(wanted) if few else wanted, texts["doc_id"] == wanted["rep"]).drop("doc_id")
    checked = written(block_pairs(found, ["component"], "blocks")
                      .mapInPandas(_verify(width, threshold), "rep long, links long, low long"), "verified")
    linked = checked.groupBy("rep").agg(F.sum("links").alias("links"))
    final = connected_components(checked.where("low <> rep").select(F.col("low").alias("u"), F.col("rep").alias("v")))
    by_class = (classes.join(linked, "rep", "left")
                .join(final.withColumnRenamed("node", "rep"), "rep", "left")
                .select("set_a", "set_b", "n", F.col("rep").alias("class_id"),
                        (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"),
                        F.coalesce("component", "rep").alias("component_id")))
    return (sketches.select("doc_id", "set_a", "set_b", "n")
            .join(by_class, ["set_a", "set_b", "n"], "left")
            .select("doc_id", F.coalesce("class_id", "doc_id").alias("class_id"),
                    F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
                    F.coalesce("component_id", "doc_id").alias("component_id"))
            .withColumn("kept", F.col("component_id") == F.col("doc_id")))


def keep_one(docs: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` whose document is the smallest id of its component
    (all rows with a null id stay)."""
    decided = near_duplicates(docs, **options).where("not kept").select("doc_id")
    return docs.join(decided, "doc_id", "left_anti")
