"""Conforming two overlapping record sets (inventory J1, J2, P2-P7, F9).

The reference works on pandas column *labels*: suffixes ``_x``/``_y`` on
overlapping names, header cleaning, dropping a duplicated column when its
values are identical, and so on. Spark resolves names case-insensitively, so
``Time of day`` and ``Time of Day`` cannot both be addressed by name. Every
step here therefore works on a :class:`LabeledFrame`: a DataFrame whose
physical columns have positional internal names, plus the list of logical
labels in order. Label bookkeeping is plain Python over the schema (metadata
only); all data work stays in Spark.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

ROW = "_row"


@dataclass(frozen=True)
class LabeledFrame:
    """A DataFrame with positional physical names and logical labels."""

    df: DataFrame
    labels: tuple[str, ...]

    @property
    def physical(self) -> list[str]:
        return list(self.df.columns)

    @staticmethod
    def of(df: DataFrame, prefix: str = "c") -> LabeledFrame:
        labels = tuple(df.columns)
        renamed = df.toDF(*[f"__{prefix}{i}" for i in range(len(labels))])
        return LabeledFrame(renamed, labels)

    def col(self, label: str) -> Column:
        """Column for a label that occurs exactly once (case-sensitive)."""
        idx = [i for i, lab in enumerate(self.labels) if lab == label]
        if len(idx) != 1:
            raise KeyError(f"label {label!r} occurs {len(idx)} times")
        return F.col(self.physical[idx[0]])

    def has(self, label: str) -> bool:
        return label in self.labels

    def relabel(self, fn: Callable[[str], str]) -> LabeledFrame:
        return LabeledFrame(self.df, tuple(fn(lab) for lab in self.labels))

    def keep(self, mask: Sequence[bool]) -> LabeledFrame:
        cols = [p for p, m in zip(self.physical, mask) if m]
        labs = tuple(lab for lab, m in zip(self.labels, mask) if m)
        return LabeledFrame(self.df.select(*cols), labs)

    def with_label(self, label: str, value: Column) -> LabeledFrame:
        """Replace the column of an existing label (or append a new one)."""
        if label in self.labels:
            i = self.labels.index(label)
            return LabeledFrame(self.df.withColumn(self.physical[i], value), self.labels)
        name = f"__n{len(self.labels)}"
        return LabeledFrame(self.df.withColumn(name, value), self.labels + (label,))

    def to_df(self) -> DataFrame:
        """Plain DataFrame with logical names. Labels must be unique ignoring
        case, as Spark could not address them otherwise."""
        lowered = [lab.lower() for lab in self.labels]
        dupes = sorted({lab for lab in self.labels if lowered.count(lab.lower()) > 1})
        if dupes:
            raise ValueError(f"labels collide ignoring case: {dupes}; drop or rename first")
        return self.df.select(*[F.col(p).alias(lab) for p, lab in zip(self.physical, self.labels)])


#: ``salt_buckets`` for as many tasks as the session shuffles into.
SALT_BUCKETS = 0
#: A key is split from this part of a task's mean rows on, and into parts of that size.
SPLIT_FROM, PART = 4, 8
#: Sketches of the input are combined in two steps, the first in so many groups.
SKETCH_GROUPS = 64
#: Items that the sketch functions track at most.
SKETCH_LIMIT = 1_000_000


def session_tasks(df: DataFrame) -> int:
    """The tasks that the session of ``df`` shuffles into."""
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def heavy_keys(df: DataFrame, key: str, tasks: int) -> dict:
    """{key: parts} for every key (null included) that holds more than a quarter of the mean
    rows of one of ``tasks`` tasks; parts of it are an eighth of that mean.

    Heavy-hitter sketches find them: one sketch of bounded size for each input task,
    combined in two steps, so no key column is shuffled. A sketch of 32 items a task
    cannot miss a key of that share (beyond SKETCH_LIMIT items, of 8 / SKETCH_LIMIT of all rows).
    There are less than 4 keys a task; they come to the driver as a small table of the plan."""
    items = min(SKETCH_LIMIT, max(1024, 32 * tasks))
    most = min(items, 4 * tasks)
    sketch = F.expr(f"approx_top_k_accumulate(k, {items})")
    grouped = (df.select(F.col(key).alias("k"), (F.spark_partition_id() % SKETCH_GROUPS).alias("g"))
               .groupBy("g").agg(sketch.alias("s"), F.count(F.lit(1)).alias("n")))
    # by a constant, since tasks without rows cannot begin an ungrouped combination
    found = grouped.groupBy(F.lit("all")).agg(F.expr(f"approx_top_k_estimate(approx_top_k_combine(s, {items}), {most})").alias("top"),
                        F.sum("n").alias("n")).first()
    if found is None:
        return {}
    total = found["n"]
    return {r["item"]: -(-r["count"] * PART * tasks // total) for r in found["top"] if r["count"] * SPLIT_FROM * tasks > total}


def salted_join(left: DataFrame, right: DataFrame, lk: str, rk: str, how: str, spread: Column, hot: Mapping,
                null_safe: bool = False) -> DataFrame:
    """Equi-join ``left.lk == right.rk`` (``<=>`` with ``null_safe``) that splits the
    ``hot`` left keys, {key: parts} (:func:`heavy_keys`).

    A left row of a hot key gets salt ``pmod(hash(spread), parts)`` - ``spread`` should be
    deterministic per row (e.g. its source position), so a recomputed task
    salts identically - and every right row of a hot key is repeated once per
    part. Cold rows keep salt 0. Each left row meets each right row of its key
    exactly once, so the result equals the plain join; only the work of a hot
    key is spread over as many tasks as its rows fill. Without hot keys it is the plain join.
    """
    same = F.col(lk).eqNullSafe(F.col(rk)) if null_safe else F.col(lk) == F.col(rk)
    if not hot:
        return left.join(right, same, how)
    spark, kind = left.sparkSession, left.schema[lk].dataType
    parts = spark.createDataFrame(list(hot.items()), StructType([StructField("__hot", kind), StructField("__parts", IntegerType())]))

    def parted(df: DataFrame, key: str) -> DataFrame:  # less than four rows a task
        return df.join(F.broadcast(parts), F.col(key).eqNullSafe(F.col("__hot")), "left")

    salt = F.when(F.col("__parts") > 1, F.pmod(F.xxhash64(spread), F.col("__parts")).cast("int")).otherwise(0)
    ls = parted(left, lk).withColumn("__lsalt", salt).drop("__hot", "__parts")
    copies = F.sequence(F.lit(0), F.coalesce("__parts", F.lit(1)) - 1)
    rs = parted(right, rk).withColumn("__rsalt", F.explode(copies)).drop("__hot", "__parts")
    return ls.join(rs, same & (F.col("__lsalt") == F.col("__rsalt")), how).drop("__lsalt", "__rsalt")


def merge(left: DataFrame, right: DataFrame, on: str | tuple[str, str], how: str = "left",
          suffixes: tuple[str, str] = ("_x", "_y"), null_safe: bool = True,
          salt_buckets: int | None = None, hot: Mapping | None = None) -> LabeledFrame:
    """``left.merge(right, on=..., how=...)`` with pandas labelling.

    Output labels: all left labels, then the right labels except the key;
    labels present on both sides (case-sensitive) get ``suffixes``. With
    ``null_safe`` a null key matches a null key, as pandas does; without it (keys that
    cannot be null) the join keeps a partitioning that the inputs have on the key.
    Either way it is one join of one plan of each side. If both
    inputs carry ``_row``, the result's ``_row`` orders by left then right,
    the order pandas produces; otherwise the left ``_row`` is kept.

    ``salt_buckets`` is the number of tasks that the join's rows should fill evenly (SALT_BUCKETS:
    as the session shuffles): left keys too large for that are split (:func:`salted_join`,
    for ``how='left'`` or ``'inner'``). ``hot`` has these keys with their parts where they are
    known, else sketches find them (:func:`heavy_keys`).
    """
    lkey, rkey = (on, on) if isinstance(on, str) else on
    lf, rf = LabeledFrame.of(left, "l"), LabeledFrame.of(right, "r")
    llabs = [lab for lab in lf.labels if lab != ROW]
    rlabs = [lab for lab in rf.labels if lab != ROW and not (lab == rkey and lkey == rkey)]
    overlap = set(llabs) & set(rlabs)
    lname, rname = lf.physical[lf.labels.index(lkey)], rf.physical[rf.labels.index(rkey)]
    if salt_buckets is not None:
        if how not in ("left", "inner"):
            raise ValueError("salted merge supports how='left' or 'inner'")
        hot = heavy_keys(lf.df, lname, salt_buckets or session_tasks(left)) if hot is None else hot
    spread = lf.col(ROW) if ROW in lf.labels else F.struct(*[F.col(c) for c in lf.physical])
    joined = salted_join(lf.df, rf.df, lname, rname, how, spread, hot or {}, null_safe)

    cols: list[Column] = []
    labels: list[str] = []
    for lab in llabs:
        cols.append(lf.col(lab))
        labels.append(lab + suffixes[0] if lab in overlap else lab)
    for lab in rlabs:
        cols.append(rf.col(lab))
        labels.append(lab + suffixes[1] if lab in overlap else lab)
    suffixed = {lab + sfx for lab in overlap for sfx in suffixes}
    clashes = sorted(lab for lab in suffixed if labels.count(lab) > 1)
    if clashes:
        # pandas refuses such a merge too
        raise ValueError(f"suffixes would duplicate labels {clashes}")
    if ROW in lf.labels and ROW in rf.labels:
        cols.append(F.struct(lf.col(ROW).alias("l"), rf.col(ROW).alias("r")))
        labels.append(ROW)
    elif ROW in lf.labels:
        cols.append(lf.col(ROW))
        labels.append(ROW)
    out = joined.select(*[c.alias(f"__m{i}") for i, c in enumerate(cols)])
    return LabeledFrame(out, tuple(labels))


def clean_labels(frame: LabeledFrame, remove: str = "\n") -> LabeledFrame:
    """Remove a character sequence from every label."""
    return frame.relabel(lambda lab: lab.replace(remove, ""))


def _pairs_by_label(frame: LabeledFrame) -> list[tuple[int, int]]:
    """(first index, later index) for every label seen before."""
    seen: dict[str, int] = {}
    pairs = []
    for i, lab in enumerate(frame.labels):
        if lab == ROW:
            continue
        if lab in seen:
            pairs.append((seen[lab], i))
        else:
            seen[lab] = i
    return pairs


def duplicate_label_checks(frame: LabeledFrame) -> tuple[list[tuple[int, int]], list[Column]]:
    """The (first, later) index pairs of repeated labels and, per pair, an
    aggregate that is true when the two copies differ on any row (null equals
    null; different types never compare equal, as with pandas dtypes)."""
    pairs = _pairs_by_label(frame)
    phys = frame.physical
    types = dict(frame.df.dtypes)
    exprs = []
    for i, (a, b) in enumerate(pairs):
        if types[phys[a]] != types[phys[b]]:
            e = F.lit(True)
        else:
            e = F.coalesce(F.max((~F.col(phys[a]).eqNullSafe(F.col(phys[b]))).cast("int")) > 0, F.lit(False))
        exprs.append(e.alias(f"d{i}"))
    return pairs, exprs


def decisions_from(pairs: list[tuple[int, int]], values) -> dict[tuple[int, int], bool]:
    return {pair: bool(values[f"d{i}"]) for i, pair in enumerate(pairs)}


def duplicate_label_differences(frame: LabeledFrame) -> dict[tuple[int, int], bool]:
    """For each later copy of a label: does it differ from the first copy on
    any row? One aggregate pass, one boolean per pair (bounded by the number
    of columns). See :func:`starloom.plans.warehouse.conform_records` for the
    same check folded into a write with ``DataFrame.observe``."""
    pairs, exprs = duplicate_label_checks(frame)
    if not pairs:
        return {}
    return decisions_from(pairs, frame.df.agg(*exprs).first())


def resolve_duplicate_labels(frame: LabeledFrame, dup_suffix: str = "_dup",
                             differences: dict[tuple[int, int], bool] | None = None) -> LabeledFrame:
    """A later column whose label repeats an earlier one is dropped if
    its values equal the first copy's, else relabelled ``<label>_dup``.

    The outcome depends on the data, so it costs one eager aggregate
    (:func:`duplicate_label_differences`); pass ``differences`` to reuse a
    decision already taken.
    """
    diffs = duplicate_label_differences(frame) if differences is None else differences
    if not diffs:
        return frame
    keep = [True] * len(frame.labels)
    labels = list(frame.labels)
    for (_, later), differs in diffs.items():
        if differs:
            labels[later] = labels[later] + dup_suffix
        else:
            keep[later] = False
    relabeled = LabeledFrame(frame.df, tuple(labels))
    return relabeled.keep(keep)


def conflict_report(frame: LabeledFrame, key: str, suffixes: tuple[str, str] = ("_x", "_y")) -> DataFrame:
    """Rows where the two copies of an overlapping column differ.

    pandas ``!=`` counts a null on either side as a difference, including null
    against null. Long form: ``key, column, left_value, right_value`` (values
    as text so all columns share one schema)."""
    sx, sy = suffixes
    copies = []
    for lab in frame.labels:
        base = lab[: -len(sx)]
        if lab.endswith(sx) and frame.has(base + sy):
            x, y = frame.col(lab), frame.col(base + sy)
            copies.append(F.struct(F.coalesce(x != y, F.lit(True)).alias("differs"), F.lit(base).alias("column"),
                                   x.cast("string").alias("left_value"), y.cast("string").alias("right_value")))
    if not copies:
        spark = frame.df.sparkSession
        return spark.createDataFrame([], "key string, column string, left_value string, right_value string")
    # one scan: the copies of a row come out of one array. The filter is behind it, as that of an array is not compiled
    each = frame.df.select(frame.col(key).alias("key"), F.inline(F.array(*copies)))
    return each.where("differs").drop("differs")


def keep_right(frame: LabeledFrame, suffixes: tuple[str, str] = ("_x", "_y")) -> LabeledFrame:
    """Drop every ``*_x`` column, strip ``_y`` from every ``*_y`` label.
    The right copy wins even where it is null (no coalesce)."""
    sx, sy = suffixes
    kept = frame.keep([not lab.endswith(sx) for lab in frame.labels])
    return kept.relabel(lambda lab: lab[: -len(sy)] if lab.endswith(sy) else lab)


def keep_left(frame: LabeledFrame, suffixes: tuple[str, str] = ("_x", "_y")) -> LabeledFrame:
    """P5: remove the suffix text *anywhere* in each label, then keep only the
    first column of each resulting label."""
    relabeled = frame
    for s in suffixes:
        relabeled = relabeled.relabel(lambda lab, s=s: lab.replace(s, ""))
    seen: set[str] = set()
    mask = []
    for lab in relabeled.labels:
        mask.append(lab not in seen)
        seen.add(lab)
    return relabeled.keep(mask)


def drop_labels(frame: LabeledFrame, labels: Iterable[str]) -> LabeledFrame:
    """Drop by exact (case-sensitive) label."""
    drop = set(labels)
    return frame.keep([lab not in drop for lab in frame.labels])
