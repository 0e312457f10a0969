"""Benchmark: the ETL and the headline queries on $BENCH_SF_DIR (default
/root/testdata/sf0.1) with local[$BENCH_CPUS]. Prints one JSON line.

Each entry is forced to completion with a ``noop`` write (no rows reach the
driver). Timings are the median of warm runs after one warm-up run; ``spread`` has the least and the
largest of them. The reports run first, on the written warehouse, before the long jobs. ``value`` sums
``etl_build`` and the headline queries, as in earlier rounds; ``etl_job`` (the user's job on
exported sheets) and the single tables come beside it.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from starloom.plans import catalog, etl  # noqa: E402
from starloom.session import build_session, scratch_path  # noqa: E402

BASE = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
RUNS = int(os.environ.get("BENCH_RUNS", "3"))
REPORT_RUNS = int(os.environ.get("BENCH_REPORT_RUNS", str(RUNS + 2)))

HEADLINE = ("q1_top_lga", "q2_state_crashes", "q3_weekday_time", "q4_holidays", "q5_vehicle_types",
            "q6_dwelling_rate", "k5_primary_keys", "k6_foreign_keys", "m5_road_user_rules")
#: Entries that build the tables and mine the rules, timed over the parts that the session has built.
PARTS = ("b1_conform_records", "b2_conform_counts", "p6_conflict_report", "d1_dim_date", "d2_dim_state", "d3_dim_lga",
         "d4_dim_time", "d5_dim_vehicle", "d6_dim_person", "d7_dim_event", "d8_dim_road", "t1_fact_fatalities",
         "t2_fact_crashes", "t3_fact_number", "m1_transactions", "m2_one_hot", "m3_frequent_itemsets", "m4_rules")


def _force(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def _time(fn, runs: int) -> list[float]:
    fn()  # warm-up
    samples = []
    for _ in range(runs):
        t = time.perf_counter()
        fn()
        samples.append(time.perf_counter() - t)
    return samples


def main() -> None:
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(master=f"local[{cpus}]", shuffle_partitions=int(cpus) * 2)
    qs = catalog.queries()
    times: dict[str, list[float]] = {}
    catalog.stored_warehouse(spark, BASE)
    for name in HEADLINE:
        times[name] = _time(lambda n=name: _force(qs[n](spark, BASE)), REPORT_RUNS)
    times["etl_build"] = _time(lambda: catalog.run_etl(spark, BASE), RUNS)
    sheets = catalog._exported(spark, BASE)
    times["etl_job"] = _time(lambda: etl.run(spark, sheets, scratch_path(spark, "bench-etl"), enforce_keys=False), 1)
    for name in PARTS:
        times[name] = _time(lambda n=name: _force(qs[n](spark, BASE)), RUNS)
    results = {k: statistics.median(v) for k, v in times.items()}
    sf = os.path.basename(BASE.rstrip("/")).replace("sf", "")
    print(json.dumps({
        "metric": "total_median_sec",
        "value": round(sum(results[k] for k in ("etl_build", *HEADLINE)), 3),
        "unit": "sec",
        "queries": {k: round(v, 3) for k, v in results.items()},
        "spread": {k: [round(min(v), 3), round(max(v), 3)] for k, v in times.items()},
        "sf": float(sf) if sf.replace(".", "", 1).isdigit() else sf,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
