"""The rule-mining job: reload the processed export, build transactions,
mine frequent itemsets and rules, keep rules about road users, write them
(only if any), and report the top five - or, when no rule qualifies, the
distinct consequent items and a sample of itemsets. The counterpart of
running the reference's rule-mining script (inventory R1, M1-M7, S4, K4).

    python -m starloom.plans.rule_job --processed P --out OUT
"""

from __future__ import annotations

import argparse
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from starloom.operators import rules
from starloom.session import scratch_path, stored
from starloom.sinks.tables import write_rules
from starloom.sources.delimited import ROW, header_labels, read_sheet_csv
from starloom.sources.records import AT, quoted_records

# The reference's mining parameters.
MIN_SUPPORT = 0.05
MAX_LEN = 3
MIN_LIFT = 1.0
TOP = 5
SAMPLE = 10


@dataclass
class RuleJobResult:
    written: bool
    rules: DataFrame            # road-user rules, sorted
    top: DataFrame | None       # first five, when any rule qualified
    consequent_items: DataFrame | None   # fallback outputs otherwise
    sample_itemsets: DataFrame | None


def run(records: DataFrame, out: str, fmt: str = "parquet", min_support: float = MIN_SUPPORT,
        max_len: int = MAX_LEN, min_lift: float = MIN_LIFT) -> RuleJobResult:
    """The records are read once: itemsets and rules are written to the shared
    checkpoint folder and every further step reads these small tables."""
    spark = records.sparkSession
    itemsets = stored(rules.frequent_itemsets(rules.transactions(records), min_support=min_support, max_len=max_len),
                       scratch_path(spark, "itemsets"))
    all_rules = stored(rules.association_rules(itemsets, min_lift=min_lift), scratch_path(spark, "all-rules"))
    road = rules.road_user_rules(all_rules)
    if write_rules(road, out, fmt=fmt):
        return RuleJobResult(True, road, rules.top_rules(road, TOP), None, None)
    return RuleJobResult(False, road, None, rules.consequent_items(all_rules),
                         rules.sample_itemsets(itemsets, SAMPLE))


def read_processed(spark: SparkSession, path: str) -> DataFrame:
    """The processed export (CSV with a header record); every cell is read as
    text, as the reference's cleaning does, and may hold line breaks."""
    records = quoted_records(spark, path)
    # the first record of a split; no record is sorted for it
    first = records.where("nth = 0").agg(F.min_by("record", F.struct(*AT))).first()[0]
    if first is None:
        raise ValueError(f"{path}: no header record")
    labels = header_labels(first)
    schema = StructType([StructField(lab, StringType()) for lab in labels])
    return read_sheet_csv(spark, path, schema, records=records).drop(ROW)


def main(argv: list[str] | None = None) -> None:
    ap = argparse.ArgumentParser(description=__doc__.splitlines()[0])
    ap.add_argument("--processed", required=True)
    ap.add_argument("--out", required=True)
    ap.add_argument("--format", default="parquet", choices=("parquet", "csv", "json"))
    a = ap.parse_args(argv)
    spark = SparkSession.builder.getOrCreate()
    res = run(read_processed(spark, a.processed), a.out, fmt=a.format)
    if res.written:
        print(f"rules written to {a.out}; the strongest:")
        for r in res.top.collect():  # five rows
            print(f"  {' & '.join(r.antecedents)} => {' & '.join(r.consequents)} "
                  f"[support {r.support:.3f}, confidence {r.confidence:.3f}, lift {r.lift:.3f}]")
    else:
        print(f"no rule mentions a road user; all consequent items: {a.out}-consequents, itemsets: {a.out}-itemsets")
        res.consequent_items.write.mode("overwrite").parquet(f"{a.out.rstrip('/')}-consequents")
        res.sample_itemsets.write.mode("overwrite").parquet(f"{a.out.rstrip('/')}-itemsets")


if __name__ == "__main__":
    main()
