"""Association rules with multi-item consequents (inventory M1-M7, A8, F8).

Transactions here have one item per attribute (``feature=value``), so an
itemset never holds two values of one feature and every itemset of size k is
a value combination of k attributes. Counting all itemsets up to ``max_len``
is therefore a grouping over every subset of the attribute columns:

1. pre-aggregate: ``groupBy(all attributes).count()`` - partial aggregation
   collapses rows map-side, so even one combination holding a third of all
   rows is a single row per task before the shuffle; these combinations are written once;
2. one ``explode`` of the (few) subset projections of each combination row,
   then ``groupBy(items).sum``;
3. keep itemsets with ``count / N >= min_support`` where N is a scalar
   subquery (no collect, no cross join).

This is the one counting method, whatever the number of attributes, so the
answer never depends on their number. Rules are generated by exploding subset
masks of each itemset and two equi-joins for the antecedent and consequent
supports; Spark picks the join strategy from the sizes it measures.

MLlib's FP-Growth is not used: it rounds the support to a count (an itemset
exactly at the border can be lost) and its rules have single-item consequents.
"""

from __future__ import annotations

from collections.abc import Sequence
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starloom.functions.scalar import (
    MISSING_TOKENS,
    SPEED_EDGES,
    SPEED_LABELS,
    bin_right_closed,
    item_text,
    null_if_in,
    safe_double,
)
from starloom.session import scratch_path, stored

# The six attributes of a transaction, in the reference's order.
ATTRIBUTES = ("Road User", "Age Group", "Gender", "Speed Category", "Time of Day", "National Road Type")
SPEED_SOURCE = "Speed Limit"
SPEED_FEATURE = "Speed Category"
REQUIRED = "Road User"
RULE_COLUMNS = ("antecedents", "consequents", "antecedent support", "consequent support", "support",
                "confidence", "lift", "leverage", "conviction", "zhangs_metric")


def transactions(records: DataFrame, attributes: Sequence[str] = ATTRIBUTES,
                 missing: Sequence[str] = MISSING_TOKENS) -> DataFrame:
    """M1: one row per complete record, one column per attribute holding its
    ``feature=value`` item, and ``items`` (array, sorted).

    Every cell is read as text and the missing tokens become null; records
    without a road user go first (support is relative to what is left), then
    the speed is parsed and binned right-closed, and a record missing any
    attribute is dropped whole.
    """
    cleaned = {}
    for a in attributes:
        if a == SPEED_FEATURE:
            cleaned[a] = safe_double(null_if_in(F.col(SPEED_SOURCE).cast("string"), missing))
        else:
            cleaned[a] = null_if_in(F.col(a).cast("string"), missing)
    base = records.where(cleaned[REQUIRED].isNotNull()) if REQUIRED in cleaned else records
    cells = _generated(base, cleaned)
    binned = {a: bin_right_closed(F.col(a), SPEED_EDGES, SPEED_LABELS) if a == SPEED_FEATURE else F.col(a) for a in attributes}
    complete = _generated(cells, {a: item_text(a, c) for a, c in binned.items()}).dropna(how="any")
    return complete.withColumn("items", F.array_sort(F.array(*[F.col(a) for a in attributes])))


def _generated(df: DataFrame, columns: dict[str, Column]) -> DataFrame:
    """``df.select`` of the named columns, each computed once a row: a generator's output is not put in
    the place of its mentions in what follows, as a projection is. The speed would else be parsed for every
    edge of its bins and for every filter, in one method too long to be compiled."""
    return df.select(F.inline(F.array(F.struct(*[c.alias(a) for a, c in columns.items()]))))


def frequent_itemsets(tx: DataFrame, attributes: Sequence[str] = ATTRIBUTES, min_support: float = 0.05,
                      max_len: int = 3) -> DataFrame:
    """M3: itemsets (sorted array ``items``) with ``count``, ``total`` (the number
    of transactions), ``support``, ``size``; support >= ``min_support`` (compared as
    the double ``count / total``), size <= ``max_len``. The transactions are read once: their distinct
    combinations are written to the shared checkpoint folder, and total and itemsets are counted from these."""
    attrs = list(attributes)
    combos = stored(tx.groupBy(*attrs).agg(F.count(F.lit(1)).alias("__cnt")), scratch_path(tx.sparkSession, "combinations"))
    subsets = [s for k in range(1, max_len + 1) for s in combinations(attrs, k)]
    projections = F.array(*[F.array_sort(F.array(*[F.col(a) for a in s])) for s in subsets])
    counted = (combos.select(F.explode(projections).alias("items"), "__cnt")
               .groupBy("items").agg(F.sum("__cnt").alias("count")))
    total = combos.agg(F.sum("__cnt")).scalar()
    support = F.col("count") / F.col("total")
    return (counted.select("items", F.col("count").cast("bigint").alias("count"), total.cast("bigint").alias("total"))
            .select("items", "count", "total", support.alias("support"), F.size("items").alias("size"))
            .where(F.col("support") >= F.lit(min_support)))


def _subset(items: Column, mask: Column, inside: bool) -> Column:
    bit = lambda i: F.call_function("shiftright", mask, i).bitwiseAND(F.lit(1))
    return F.filter(items, lambda x, i: (bit(i) == 1) if inside else (bit(i) == 0))


def association_rules(itemsets: DataFrame, min_lift: float = 1.0) -> DataFrame:
    """M4: every split of a frequent itemset (size >= 2) into a non-empty
    antecedent and consequent, with the eight metrics, kept when
    ``lift >= min_lift``.

    With ``min_lift == 1`` the test is exact on integer counts
    (``count * N >= count_a * count_c``, N being the ``total`` that the itemsets
    carry); other thresholds compare the double lift.
    """
    sets = itemsets.select("items", "count", "total", "support", "size")
    multi = sets.where(F.col("size") >= 2)
    masks = F.sequence(F.lit(1), F.call_function("shiftleft", F.lit(1), F.col("size")) - 2)
    splits = multi.select("items", F.col("count").alias("c"), F.col("total").alias("n"), F.col("support").alias("s"),
                          F.explode(masks).alias("mask"))
    splits = splits.select("c", "n", "s", _subset(F.col("items"), F.col("mask"), True).alias("antecedents"),
                           _subset(F.col("items"), F.col("mask"), False).alias("consequents"))
    ante = sets.select(F.col("items").alias("antecedents"), F.col("count").alias("ca"), F.col("support").alias("sa"))
    cons = sets.select(F.col("items").alias("consequents"), F.col("count").alias("cc"), F.col("support").alias("sc"))
    r = splits.join(ante, "antecedents").join(cons, "consequents")
    conf = F.col("s") / F.col("sa")
    lift = conf / F.col("sc")
    leverage = F.col("s") - F.col("sa") * F.col("sc")
    conviction = F.when(conf == 1.0, F.lit(float("inf"))).otherwise((F.lit(1.0) - F.col("sc")) / (F.lit(1.0) - conf))
    denom = F.greatest(F.col("s") * (F.lit(1.0) - F.col("sa")), F.col("sa") * (F.col("sc") - F.col("s")))
    zhang = F.when(denom == 0, F.lit(0.0)).otherwise(leverage / denom)
    out = r.select(
        "antecedents", "consequents", F.col("sa").alias("antecedent support"),
        F.col("sc").alias("consequent support"), F.col("s").alias("support"), conf.alias("confidence"),
        lift.alias("lift"), leverage.alias("leverage"), conviction.alias("conviction"),
        zhang.alias("zhangs_metric"), "c", "n", "ca", "cc")
    if min_lift == 1.0:
        # support = count / N for all three, so lift >= 1 <=> c * N >= ca * cc.
        # decimal(38,0) products cannot overflow at any realistic row count.
        dec = "decimal(38,0)"
        keep = (F.col("c").cast(dec) * F.col("n").cast(dec)) >= (F.col("ca").cast(dec) * F.col("cc").cast(dec))
    else:
        keep = F.col("lift") >= F.lit(min_lift)
    return out.where(keep).drop("c", "n", "ca", "cc")


def consequent_mentions(rules: DataFrame, text: str = "Road User=") -> DataFrame:
    """M5 filter (F8): rules whose consequent has an item containing ``text``."""
    return rules.where(F.exists("consequents", lambda i: i.contains(text)))


def rule_order(rules: DataFrame) -> list[Column]:
    """Lift then confidence, both descending; item texts break ties so a
    top-k is deterministic."""
    return [F.desc("lift"), F.desc("confidence"), F.array_join("antecedents", "\u0001"),
            F.array_join("consequents", "\u0001")]


def road_user_rules(rules: DataFrame, text: str = "Road User=") -> DataFrame:
    """M5: filtered and sorted."""
    filtered = consequent_mentions(rules, text)
    return filtered.orderBy(*rule_order(filtered))


def top_rules(rules: DataFrame, k: int = 5) -> DataFrame:
    """M6: the first ``k`` rules in rule order (the limit is the feature)."""
    return rules.orderBy(*rule_order(rules)).limit(k)


def consequent_items(rules: DataFrame) -> DataFrame:
    """Distinct items over all consequents."""
    return rules.select(F.explode("consequents").alias("item")).distinct()


def sample_itemsets(itemsets: DataFrame, k: int = 10) -> DataFrame:
    """M7: the first ``k`` itemsets by size, then items (the order Apriori
    emits them over alphabetically sorted item columns)."""
    return itemsets.orderBy("size", F.array_join("items", "\u0001")).limit(k)


def one_hot(tx: DataFrame, items: Sequence[str]) -> DataFrame:
    """M2: boolean column per item of the given domain; one row per transaction.

    The domain is an argument, so the schema is known before any data is read. An
    item outside it fails the job: none is dropped without a word."""
    domain = F.array(*[F.lit(it) for it in items])
    outside = F.array_except("items", domain)
    checked = tx.select(F.when(F.size(outside) == 0, F.col("items")).otherwise(
        F.raise_error(F.concat(F.lit("items outside the domain: "), F.array_join(outside, ", ")))).alias("items"))
    return checked.select(*[F.array_contains("items", it).alias(it) for it in sorted(items)])
