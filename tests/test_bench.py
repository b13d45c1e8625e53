"""bench.py prints exactly one JSON line with the agreed keys."""

import json
import os
import subprocess
import sys

from conftest import ROOT, SMALL


def test_bench_prints_one_json_line():
    env = dict(os.environ, BENCH_SF_DIR=SMALL, BENCH_CPUS="2", BENCH_QUERIES="time_travel,apply_changes")
    out = subprocess.run([sys.executable, os.path.join(ROOT, "bench.py")], env=env, capture_output=True,
                         text=True, timeout=600)
    assert out.returncode == 0, out.stderr[-2000:]
    lines = [ln for ln in out.stdout.splitlines() if ln.strip()]
    assert len(lines) == 1
    rec = json.loads(lines[0])
    assert rec["unit"] == "sec" and rec["metric"] == "total_sec" and rec["sf"] == 0.001
    assert set(rec["queries"]) == {"time_travel", "apply_changes"}
    assert abs(rec["value"] - sum(rec["queries"].values())) < 0.01
