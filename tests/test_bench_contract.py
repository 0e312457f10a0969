"""bench.py prints one JSON line with the keys the driver records."""

import json
import os
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_bench_prints_one_json_line():
    env = dict(os.environ, BENCH_SF_DIR="/root/testdata/sf0.001", BENCH_RUNS="1", BENCH_CPUS="4")
    r = subprocess.run([sys.executable, "bench.py"], cwd=ROOT, env=env, capture_output=True, text=True, timeout=1500)
    assert r.returncode == 0, r.stderr[-2000:]
    lines = [l for l in r.stdout.splitlines() if l.strip()]
    assert len(lines) == 1
    out = json.loads(lines[0])
    assert {"metric", "value", "unit", "queries", "sf"} <= set(out)
    assert out["unit"] == "sec" and out["sf"] == 0.001
    assert out["queries"] and all(v >= 0 for v in out["queries"].values())
    import bench
    assert {"etl_job", *bench.HEADLINE, *bench.PARTS} <= set(out["queries"])
    assert abs(out["value"] - sum(out["queries"][k] for k in ("etl_build", *bench.HEADLINE))) < 0.01
