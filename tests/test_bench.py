"""bench.py prints the one JSON line the driver records."""

import json
import os
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_bench_prints_one_json_line():
    env = dict(os.environ, BENCH_SF_DIR="/root/testdata/sf0.001", BENCH_CPUS="2",
               BENCH_REPEAT="1", BENCH_ONLY="c20,c18_po")
    out = subprocess.run([sys.executable, os.path.join(ROOT, "bench.py")], env=env,
                         capture_output=True, text=True, timeout=600, check=True)
    lines = [ln for ln in out.stdout.splitlines() if ln.strip()]
    assert len(lines) == 1
    rec = json.loads(lines[0])
    assert rec["unit"] == "sec" and rec["metric"] and rec["errors"] == {}
    assert set(rec["queries"]) == {"c18_po_throughput", "c18_po_throughput_wide",
                                   "c20_throughput_groups"}
    assert rec["value"] == round(sum(rec["queries"].values()), 3)
