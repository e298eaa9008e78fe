"""bench.py prints one JSON line with the fields the round driver reads."""

import json
import os
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_bench_prints_one_json_line():
    env = dict(os.environ, BENCH_SF_DIR="/root/testdata/sf0.001", BENCH_CPUS="2")
    out = subprocess.run([sys.executable, os.path.join(ROOT, "bench.py"), "store_sales_hopping"],
                         env=env, capture_output=True, text=True, timeout=600, check=True)
    lines = [line for line in out.stdout.splitlines() if line.strip()]
    assert len(lines) == 1
    rec = json.loads(lines[0])
    assert rec["metric"] and rec["unit"] == "sec" and rec["sf"] == 0.001
    assert set(rec["queries"]) == {"store_sales_hopping"} and rec["value"] > 0
