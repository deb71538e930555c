"""bench.py prints one JSON line with the agreed fields (run at sf0.001)."""

from __future__ import annotations

import json
import os
import subprocess
import sys

from helpers import ROOT, SF_SMALL


def test_bench_prints_one_json_line():
    env = {**os.environ, "BENCH_SF_DIR": SF_SMALL, "BENCH_REPEAT": "1", "BENCH_CPUS": "4"}
    out = subprocess.run([sys.executable, os.path.join(ROOT, "bench.py")], env=env, capture_output=True,
                         text=True, timeout=900, check=True).stdout.strip().splitlines()
    lines = [line for line in out if line.startswith("{")]
    assert len(lines) == 1
    result = json.loads(lines[0])
    assert result["metric"] == "headline_queries_total" and result["unit"] == "sec"
    assert result["sf"] == 0.001 and "errors" not in result
    assert set(result["queries"]) >= {"session_features", "document_features", "event_features"}
    assert abs(sum(result["queries"].values()) - result["value"]) < 0.01
