"""bench.py runs end to end and prints one JSON line (smallest scale)."""

import json
import os
import subprocess
import sys

from conftest import ROOT, SMALL


def test_bench_prints_one_json_line():
    env = {**os.environ, "BENCH_SF_DIR": SMALL, "BENCH_CPUS": "2"}
    out = subprocess.run([sys.executable, os.path.join(ROOT, "bench.py")], env=env, capture_output=True,
                         text=True, timeout=900, check=True).stdout.strip().splitlines()
    lines = [line for line in out if line.startswith("{")]
    assert len(lines) == 1
    result = json.loads(lines[0])
    assert result["unit"] == "sec" and result["value"] > 0 and result["sf"] == 0.001
    assert {"mart_daily_sales", "staging_build", "sales_build"} <= set(result["queries"])
