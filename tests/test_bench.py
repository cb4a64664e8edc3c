import json
import os
import subprocess
import sys

from conftest import ROOT, SMOKE_DIR


def test_bench_prints_one_json_line():
    env = dict(os.environ, BENCH_SF_DIR=SMOKE_DIR, BENCH_CPUS="2", BENCH_REPEATS="1",
               BENCH_QUERIES="mean_close,word_count")
    out = subprocess.run([sys.executable, os.path.join(ROOT, "bench.py")], env=env, capture_output=True,
                         text=True, timeout=600, check=True)
    lines = [line for line in out.stdout.splitlines() if line.strip()]
    assert len(lines) == 1
    d = json.loads(lines[0])
    assert d["metric"] == "total_query_seconds" and d["unit"] == "sec" and d["sf"] == 0.001
    assert set(d["queries"]) == {"mean_close", "word_count"}
    assert abs(d["value"] - sum(d["queries"].values())) < 1e-3
    assert d["errors"] == {}
