"""Key integrity as distributed data-quality jobs (inventory K5, K6, J10).

A Parquet table cannot carry enforced constraints, so each check returns the
offending keys as a DataFrame (empty when the data is clean) and
:func:`enforce` raises when any check finds offenders. Whole-number and date keys
are checked as words of 64 bits (:mod:`starloom.operators.key_words`), so a clean table
shuffles its words alone. Tables that lie bucketed on the key or have few keys (days, areas) are grouped, and so are other keys (texts,
several columns): partial aggregation collapses a hot key map-side, and the
anti-join then runs over distinct keys only.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.operators import key_words

REPORT_SCHEMA = "check string, key string, n_rows bigint"


def _key_text(cols: Sequence[str]):
    parts = [F.coalesce(F.col(c).cast("string"), F.lit("NULL")) for c in cols]
    return parts[0] if len(parts) == 1 else F.concat_ws("|", *parts)


def primary_key_violations(df: DataFrame, key: str | Sequence[str], name: str = "", in_place: bool = False) -> DataFrame:
    """K5: keys that are null or occur more than once, with their row count. ``in_place`` says that the
    table lies partitioned on the key or has few keys, so grouping it moves next to nothing."""
    cols = [key] if isinstance(key, str) else list(key)
    if len(cols) == 1 and not in_place and key_words.is_whole(df, cols[0]):
        return key_words.repeated_or_null(df, cols[0]).select(
            F.lit(name or f"pk({cols[0]})").alias("check"), _key_text(["key"]).alias("key"), F.col("n_rows").cast("bigint"))
    any_null = F.lit(False)
    for c in cols:
        any_null = any_null | F.col(c).isNull()
    counted = df.groupBy(*cols).agg(F.count(F.lit(1)).alias("n_rows"))
    bad = counted.where((F.col("n_rows") > 1) | any_null)
    return bad.select(F.lit(name or f"pk({','.join(cols)})").alias("check"), _key_text(cols).alias("key"),
                      F.col("n_rows").cast("bigint"))


def foreign_key_violations(child: DataFrame, child_key: str, parent: DataFrame, parent_key: str,
                           name: str = "") -> DataFrame:
    """K6: non-null child keys with no parent row (null child keys are
    allowed), with the number of child rows carrying each."""
    return _orphans([(name or f"fk({child_key})", child, child_key)], parent, parent_key, in_place=False)


@dataclass(frozen=True)
class ForeignKey:
    child: str
    child_key: str
    parent: str
    parent_key: str


# The warehouse's declared keys.
PRIMARY_KEYS = {
    "dim_date": "date_id",
    "dim_state": "state_id",
    "dim_lga": "lga_id",
    "dim_time": "crash_id",
    "dim_vehicle": "crash_id",
    "dim_person": "person_id",
    "dim_event": "crash_id",
    "dim_road": "crash_id",
    "fact_fatalities": "fatality_id",
    "fact_crashes": "crash_id",
    "fact_number": "number_date_id",
}
FOREIGN_KEYS = (
    ForeignKey("fact_crashes", "date_id", "dim_date", "date_id"),
    ForeignKey("fact_crashes", "lga_id", "dim_lga", "lga_id"),
    ForeignKey("fact_crashes", "state_id", "dim_state", "state_id"),
    ForeignKey("fact_fatalities", "crash_id", "fact_crashes", "crash_id"),
    ForeignKey("fact_fatalities", "person_id", "dim_person", "person_id"),
    ForeignKey("dim_lga", "state_id", "dim_state", "state_id"),
    ForeignKey("fact_number", "date_id", "dim_date", "date_id"),
    ForeignKey("dim_event", "crash_id", "fact_crashes", "crash_id"),
    ForeignKey("dim_road", "crash_id", "fact_crashes", "crash_id"),
    ForeignKey("dim_vehicle", "crash_id", "fact_crashes", "crash_id"),
    ForeignKey("dim_time", "crash_id", "fact_crashes", "crash_id"),
)


def _union(parts: list[DataFrame]) -> DataFrame:
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def _in_place(tables: Mapping[str, DataFrame], table: str, key: str) -> bool:
    in_place = getattr(tables, "groups_in_place", None)
    return bool(in_place and in_place(table, key))


def check_primary_keys(tables: Mapping[str, DataFrame], keys: Mapping[str, str] = PRIMARY_KEYS) -> DataFrame:
    return _union([primary_key_violations(tables[t], k, f"{t}.{k}", _in_place(tables, t, k)) for t, k in keys.items()])


def _orphans(children: Sequence[tuple[str, DataFrame, str]], parent: DataFrame, parent_key: str,
             in_place: bool) -> DataFrame:
    """The report of the foreign keys ``children`` (check, table, column) on one parent key. The checks'
    rows are united and counted together, with one count a check, and the counts are unpivoted.

    A parent that lies partitioned on its key (or has few keys) stays where it is: the children's keys, grouped first, are
    shuffled to it once. Else whole numbers and dates are compared as words."""
    names = [name for name, _, _ in children]
    types = {df.schema[key].dataType for _, df, key in children} | {parent.schema[parent_key].dataType}
    if not in_place and len(types) == 1 and key_words.is_whole(parent, parent_key):
        orphans = key_words.orphans([(df, key) for _, df, key in children], parent, parent_key)
        is_date = parent.schema[parent_key].dataType.typeName() == "date"
        text = (F.date_from_unix_date(F.col("key").cast("int")) if is_date else F.col("key")).cast("string")
    else:
        united = _union([df.where(F.col(key).isNotNull()).select(F.lit(i).alias("__i"), F.col(key).alias("__k"))
                         for i, (_, df, key) in enumerate(children)])
        keys = united.groupBy("__k").agg(*[F.count_if(F.col("__i") == i).alias(f"n{i}") for i in range(len(children))])
        known = parent.select(F.col(parent_key).alias("__k")).where(F.col("__k").isNotNull())
        orphans = keys.join(known, "__k", "left_anti")
        text = F.col("__k").cast("string")
    counts = F.explode(F.array(*[F.struct(F.lit(name).alias("check"), F.col(f"n{i}").alias("n"))
                                 for i, name in enumerate(names)]))
    return orphans.select(text.alias("key"), counts.alias("c")).where("c.n > 0").select(
        "c.check", "key", F.col("c.n").cast("bigint").alias("n_rows"))


def check_foreign_keys(tables: Mapping[str, DataFrame], fks: Sequence[ForeignKey] = FOREIGN_KEYS) -> DataFrame:
    """All foreign keys, one comparison for each parent key, whatever the number of its children."""
    by_parent: dict[tuple[str, str], list[ForeignKey]] = {}
    for f in fks:
        by_parent.setdefault((f.parent, f.parent_key), []).append(f)
    return _union([
        _orphans([(f"{f.child}.{f.child_key}->{f.parent}.{f.parent_key}", tables[f.child], f.child_key) for f in group],
                 tables[parent], key, _in_place(tables, parent, key))
        for (parent, key), group in by_parent.items()])


class IntegrityError(Exception):
    pass


def enforce(report: DataFrame) -> None:
    """Raise if the report has any row. Only a bounded sample (10 rows) of
    offenders reaches the driver, for the message."""
    sample = report.limit(10).collect()
    if sample:
        raise IntegrityError("key violations, e.g. " + "; ".join(f"{r['check']}={r['key']} x{r['n_rows']}"
                                                                 for r in sample))


def check_warehouse(tables: Mapping[str, DataFrame]) -> None:
    """Raise :class:`IntegrityError` if a primary or foreign key of the warehouse offends."""
    enforce(check_primary_keys(tables).unionByName(check_foreign_keys(tables)))
