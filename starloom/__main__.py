"""Command line: ``python -m starloom {etl,rules,sql} ...``

* ``etl``   - build the warehouse from exported sheets (see ``starloom.plans.etl``);
* ``rules`` - mine rules from the processed export (``starloom.plans.rule_job``);
* ``sql``   - run one report statement, written for the PostgreSQL warehouse,
  over a warehouse folder written by ``etl`` (``<out>/warehouse``).
"""

from __future__ import annotations

import argparse
import sys


def _sql(argv: list[str]) -> None:
    from pyspark.sql import SparkSession

    from starloom.plans.sql_text import run_statement
    from starloom.sinks.tables import open_warehouse

    ap = argparse.ArgumentParser(prog="starloom sql")
    ap.add_argument("--warehouse", required=True, help="folder holding the eleven table folders")
    ap.add_argument("--statement", help="SQL text; read from stdin when absent")
    ap.add_argument("--out", required=True, help="folder for the whole result (CSV)")
    ap.add_argument("--show", type=int, default=0, help="also print this many of its rows")
    a = ap.parse_args(argv)
    spark = SparkSession.builder.getOrCreate()
    result = run_statement(spark, open_warehouse(spark, a.warehouse), a.statement or sys.stdin.read())
    result.write.mode("overwrite").option("header", True).csv(a.out)
    if a.show:
        spark.read.schema(result.schema).option("header", True).csv(a.out).show(a.show, truncate=False)


def main(argv: list[str] | None = None) -> None:
    argv = list(sys.argv[1:] if argv is None else argv)
    if not argv or argv[0] not in ("etl", "rules", "sql"):
        print(__doc__)
        raise SystemExit(2)
    cmd, rest = argv[0], argv[1:]
    if cmd == "etl":
        from starloom.plans import etl
        etl.main(rest)
    elif cmd == "rules":
        from starloom.plans import rule_job
        rule_job.main(rest)
    else:
        _sql(rest)


if __name__ == "__main__":
    main()
