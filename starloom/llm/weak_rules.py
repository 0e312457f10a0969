"""Quality by weak supervision: rules vote, their accuracies are estimated, and the
posterior probability decides.

Every rule looks at one ratio of a text and votes good, votes bad or abstains. An
expectation-maximisation over the counts of all vote patterns (there are no more than
3 to the power of the rules, whatever the input) estimates how often each rule is
right on good and on bad texts, and the share of good texts. A text's probability then
weighs its votes by these accuracies, so no single rule can reject it as a filter
of conditions that must all hold would.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starloom.llm.common import written

#: Bytes of text measured at once (a longer text comes alone).
CHUNK = 1_000_000
MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_ended_lines",
            "n_capitals", "n_letters", "n_letter_words", "n_symbol_words", "n_exclaims")


@dataclass(frozen=True)
class Rule:
    """Votes on ``part / whole``: good inside ``good``, bad outside ``bad`` (both with their
    ends), else nothing; nothing either where ``whole`` is below ``least``."""

    part: str
    whole: str
    good: tuple[float, float]
    bad: tuple[float, float]
    least: int = 1

    def vote(self) -> Column:
        """1 good, 0 bad, -1 nothing."""
        x = F.col(self.part) / F.greatest(F.col(self.whole), F.lit(1))
        return (F.when(F.col(self.whole) < self.least, -1).when(x.between(*self.good), 1)
                .when(~x.between(*self.bad), 0).otherwise(-1))


RULES = (
    Rule("word_chars", "n_words", (4.0, 6.2), (3.0, 7.5)),
    Rule("n_symbols", "n_words", (0.0, 0.02), (0.0, 0.1)),
    Rule("n_symbol_words", "n_words", (0.0, 0.02), (0.0, 0.1)),
    Rule("n_dup_lines", "n_lines", (0.0, 0.05), (0.0, 0.3), 2),
    Rule("n_repeat_words", "n_words", (0.0, 0.1), (0.0, 0.2), 3),
    Rule("n_capitals", "n_letters", (0.0, 0.1), (0.0, 0.3)),
    Rule("n_ended_lines", "n_lines", (0.8, 1.0), (0.5, 1.0), 2),
    Rule("n_letter_words", "n_words", (0.95, 1.0), (0.8, 1.0)),
    Rule("n_exclaims", "n_words", (0.0, 0.05), (0.0, 0.2)),
)


@dataclass(frozen=True)
class Prior:
    """What is held before any text is seen: the share of ``good`` texts, the chance that a
    vote on a good text is good (``on_good``) and that one on a bad text is bad (``on_bad``; few
    rules see what is wrong with it). It counts as ``strength`` of all texts, ``least`` at least."""

    good: float = 0.8
    on_good: float = 0.95
    on_bad: float = 0.3
    strength: float = 0.01
    least: float = 5.0


@dataclass(frozen=True)
class Model:
    """The estimates: the share of good texts, and each rule's accuracies."""

    good: float
    on_good: tuple[float, ...]
    on_bad: tuple[float, ...]

    def weights(self) -> tuple[float, list[float], list[float]]:
        """The log odds of no vote, and what each rule's good or bad vote adds."""
        a, b = np.array(self.on_good), np.array(self.on_bad)
        return (float(np.log(self.good / (1 - self.good))), np.log(a / (1 - b)).tolist(), np.log((1 - a) / b).tolist())


def _flags(values: bytes) -> np.ndarray:
    out = np.zeros(256, bool)
    out[np.frombuffer(values, np.uint8)] = True
    return out


# White space and symbols as the contract names them.
_BLANK, _SYMBOL = _flags(b" \t\n\v\f\r"), _flags(b"#*$%&|<>")
_CAPITAL = _flags(bytes(range(0x41, 0x5B)))
_LETTER = _flags(bytes([*range(0x41, 0x5B), *range(0x61, 0x7B), *range(0xC0, 0x100)]))  # a character above ASCII counts as one
_POINT = ~_flags(bytes(range(0x80, 0xC0)))  # the first byte of a character
ENDS = tuple(x.encode() for x in ".!?:;\"')]}…。！？”’»")


def _lines(data: bytes) -> tuple[int, int, int]:
    """Lines with a word, those equal to an earlier one, those that end in punctuation."""
    lines = [x for x in data.split(b"\n") if x and not x.isspace()]
    return len(lines), len(lines) - len(set(lines)), sum(x.rstrip().endswith(ENDS) for x in lines)


def _repeats(data: bytes) -> int:
    """Words in windows of three words that occur twice or more."""
    words = data.split()
    if len(words) < 4:
        return 0
    number = {w: i for i, w in enumerate(set(words))}
    ids = np.fromiter(map(number.__getitem__, words), np.int64, len(words))
    pairs = ids[:-1] * len(number) + ids[1:]
    if len(number) >= 1 << 20:  # so that three numbers fit 63 bits
        pairs = np.unique(pairs, return_inverse=True)[1]
    _, which, times = np.unique(pairs[:-1] * len(number) + ids[2:], return_inverse=True, return_counts=True)
    twice = times[which] > 1
    covered = np.zeros(len(words), bool)
    for k in range(3):
        covered[k:len(words) - 2 + k] |= twice
    return int(covered.sum())


def measured(texts: list[bytes]) -> dict[str, np.ndarray]:
    """The MEASURES of some whole UTF-8 texts."""
    data = np.frombuffer(b"\n".join(texts) + b"\n", np.uint8)
    ends = np.cumsum(np.fromiter((len(x) + 1 for x in texts), np.int64, len(texts)))
    begins = np.concatenate(([0], ends[:-1]))

    def before(flags: np.ndarray) -> np.ndarray:
        return np.concatenate(([0], np.cumsum(flags, dtype=np.int64)))

    def per_text(flags: np.ndarray) -> np.ndarray:
        sums = before(flags)
        return sums[ends] - sums[begins]

    word = ~_BLANK[data]
    edges = np.diff(word.astype(np.int8), prepend=np.int8(0))  # the last byte is a blank
    starts, stops = np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)
    first = np.searchsorted(starts, begins)
    last = np.searchsorted(starts, ends)

    def words_with(flags: np.ndarray) -> np.ndarray:
        sums = before(flags)
        hits = before(sums[stops] > sums[starts])
        return hits[last] - hits[first]

    symbol, letter = _SYMBOL[data], _LETTER[data]
    lines = np.array([_lines(x) for x in texts], np.int64).reshape(-1, 3)
    return {"n_words": last - first, "word_chars": per_text(word & _POINT[data]), "n_symbols": per_text(symbol),
            "n_dup_lines": lines[:, 1], "n_repeat_words": np.array([_repeats(x) for x in texts], np.int64),
            "n_lines": lines[:, 0], "n_ended_lines": lines[:, 2], "n_capitals": per_text(_CAPITAL[data]),
            "n_letters": per_text(letter), "n_letter_words": words_with(letter), "n_symbol_words": words_with(symbol),
            "n_exclaims": per_text(data == ord("!"))}


def measure(docs: DataFrame, columns: Sequence[str] | None = None, text_col: str = "text") -> DataFrame:
    """The ``columns`` of ``docs`` (default: all) with the MEASURES of every whole text; columns
    of these names are replaced. Null texts are measured as empty ones."""
    names = [c for c in (docs.columns if columns is None else columns) if c not in MEASURES]
    schema = T.StructType([*docs.select(*names).schema.fields, *[T.StructField(m, T.LongType()) for m in MEASURES]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(0).fill_null(b"")
            first, held = 0, 0
            lengths = pc.binary_length(texts).to_pylist()
            for i, size in enumerate([*lengths, CHUNK]):
                if (held and held + size > CHUNK) or (i == len(lengths) and first < i):
                    found = measured(texts.slice(first, i - first).to_pylist())
                    yield pa.RecordBatch.from_arrays([*batch.slice(first, i - first).columns[1:], *[
                        pa.array(found[m], pa.int64()) for m in MEASURES]], schema.names)
                    first, held = i, 0
                held += size

    return docs.select(F.col(text_col).cast("binary").alias("_measured"), *names).mapInArrow(run, schema)


def pattern(rules: Sequence[Rule] = RULES) -> Column:
    """A row's votes as one number, a base-3 digit a rule."""
    return sum((3 ** i * (r.vote() + 1) for i, r in enumerate(rules)), F.lit(0))


def estimate(counts: dict[int, int], n_rules: int, prior: Prior = Prior()) -> Model:
    """Expectation-maximisation over counted vote patterns, from the prior on."""
    keys = sorted(counts)
    votes = np.array([[k // 3 ** i % 3 - 1 for i in range(n_rules)] for k in keys]).reshape(-1, n_rules)
    yes, no, n = (votes == 1) * 1.0, (votes == 0) * 1.0, np.array([counts[k] for k in keys], float)
    held = prior.strength * n.sum() + prior.least
    model = Model(prior.good, (prior.on_good,) * n_rules, (prior.on_bad,) * n_rules)
    for _ in range(500):
        base, good, bad = model.weights()
        p = 1 / (1 + np.exp(-np.clip(base + yes @ good + no @ bad, -50, 50)))
        up, down = n * p, n * (1 - p)
        on_good = (up @ yes + held * prior.on_good) / (up @ (yes + no) + held)
        on_bad = (down @ no + held * prior.on_bad) / (down @ (yes + no) + held)
        after = Model(float((up.sum() + held * prior.good) / (n.sum() + held)), tuple(on_good.tolist()), tuple(on_bad.tolist()))
        done = max(abs(x - y) for a, b in ((after.on_good, model.on_good), (after.on_bad, model.on_bad)) for x, y in zip(a, b)) < 1e-9
        model = after
        if done:
            break
    return model


def base_failed() -> Column:
    """The base rules: fewer than 50 words, or more than half of them in repeated windows."""
    return (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def judge(docs: DataFrame, columns: Sequence[str] | None = None, rules: Sequence[Rule] = RULES, prior: Prior = Prior(),
          threshold: float = 0.5, text_col: str = "text") -> DataFrame:
    """``measure`` with ``base_failed``, ``score`` (the posterior probability that the text is
    good, 0 to 1) and ``kept`` (not ``base_failed``, and a score of ``threshold`` or more).

    The accuracies are estimated over all rows that do not fail the base rules; without
    such rows the prior stands. Null and empty texts have no words and so fail. Repeated rows
    each count and get the same score; a column of a new name is replaced; an empty table stays
    empty. The score depends on the texts alone, so reruns agree.
    """
    new = ("base_failed", "score", "kept")
    names = [c for c in (docs.columns if columns is None else columns) if c not in new]
    rows = written(measure(docs, names, text_col), "measures")
    counted = rows.where(~base_failed()).groupBy(pattern(rules).alias("votes")).count().collect()  # 3 ** rules at most
    model = estimate({r["votes"]: r["count"] for r in counted}, len(rules), prior)
    base, good, bad = model.weights()
    odds = F.lit(base)
    for rule, up, down in zip(rules, good, bad):
        odds = odds + F.when(rule.vote() == 1, up).when(rule.vote() == 0, down).otherwise(0.0)
    scored = rows.withColumn("base_failed", base_failed()).withColumn("score", 1 / (1 + F.exp(-odds)))
    return scored.withColumn("kept", ~F.col("base_failed") & (F.col("score") >= threshold))
