"""bench.py prints exactly one JSON line with the fields the driver reads."""

from __future__ import annotations

import json
import os
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_bench_prints_one_json_line():
    env = dict(os.environ, BENCH_SF_DIR="/root/testdata/sf0.001", BENCH_REPEATS="1", BENCH_CPUS="2")
    out = subprocess.run(
        [sys.executable, os.path.join(ROOT, "bench.py"), "q01_max_people_per_booking"],
        capture_output=True, text=True, env=env, timeout=600, check=True,
    )
    lines = [line for line in out.stdout.splitlines() if line.strip()]
    assert len(lines) == 1
    result = json.loads(lines[0])
    assert result["metric"] and result["unit"] == "sec" and result["sf"] == 0.001
    assert set(result["queries"]) == {"q01_max_people_per_booking"}
    assert result["value"] == result["queries"]["q01_max_people_per_booking"] > 0
