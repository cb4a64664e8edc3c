"""Run the test suite, the oracle check and the bench; print a short summary.

    python scripts/check_all.py [--oracle-dir DIR] [--bench-dir DIR] [--skip-tests]

Each step runs in its own process with a time limit. Exit status is non-zero
when any step fails.
"""

from __future__ import annotations

import argparse
import json
import os
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def _run(cmd: list[str], timeout: int, env: dict | None = None) -> subprocess.CompletedProcess:
    return subprocess.run(cmd, cwd=ROOT, capture_output=True, text=True, timeout=timeout, env=env)


def main(argv: list[str]) -> int:
    ap = argparse.ArgumentParser()
    ap.add_argument("--oracle-dir", default="/root/testdata/sf0.01")
    ap.add_argument("--bench-dir", default="/root/testdata/sf0.1")
    ap.add_argument("--skip-tests", action="store_true")
    args = ap.parse_args(argv[1:])
    ok = True

    if not args.skip_tests:
        tests = _run([sys.executable, "-m", "pytest", "tests/", "-q"], timeout=3600)
        last = (tests.stdout.strip().splitlines() or ["no output"])[-1]
        print(f"tests:  {'ok' if tests.returncode == 0 else 'FAILED'}  {last}")
        ok &= tests.returncode == 0

    oracle = _run([sys.executable, "scripts/oracle_check.py", args.oracle_dir], timeout=3600)
    lines = oracle.stdout.strip().splitlines()
    failures = [line for line in lines if line.startswith("FAIL")]
    summary = next((line for line in reversed(lines) if line.startswith("summary")), "no summary")
    print(f"oracle: {'ok' if oracle.returncode == 0 else 'FAILED'}  {summary}")
    for line in failures:
        print(f"        {line}")
    ok &= oracle.returncode == 0

    env = dict(os.environ, BENCH_SF_DIR=args.bench_dir)
    bench = _run([sys.executable, "bench.py"], timeout=3600, env=env)
    try:
        result = json.loads(bench.stdout.strip().splitlines()[-1])
        print(
            f"bench:  {result['value']} s for {result['n_queries']} queries at sf{result['sf']}"
            f" (cold first run {result['first_run_total']} s, errors {len(result['errors'])})"
        )
        ok &= not result["errors"]
    except (IndexError, ValueError, KeyError):
        print("bench:  FAILED (no JSON line)")
        ok = False
    return 0 if ok else 1


if __name__ == "__main__":
    sys.exit(main(sys.argv))
