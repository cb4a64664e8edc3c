"""The command-line entry points, each in its own process."""

import os
import subprocess
import sys

from conftest import ROOT, SMOKE_DIR, write_text


def _run(args, timeout=600):
    return subprocess.run([sys.executable, "-m", *args], cwd=ROOT, capture_output=True, text=True, timeout=timeout)


def test_runner_cli_writes_the_named_outputs(scratch):
    out = os.path.join(scratch, "out")
    done = _run(["quarry.plans.run", SMOKE_DIR, out, "mean_close", "top_spender"])
    assert done.returncode == 0, done.stderr[-2000:]
    lines = dict(line.split("\t") for line in done.stdout.strip().splitlines())
    assert set(lines) == {"mean_close", "top_spender"}
    assert all(os.path.exists(os.path.join(p, "_SUCCESS")) for p in lines.values())


def test_jobs_cli_word_count_and_usage(scratch):
    texts = os.path.join(scratch, "texts")
    os.makedirs(texts)
    write_text(os.path.join(texts, "a.txt"), "one two two\n")
    out = os.path.join(scratch, "out")
    done = _run(["quarry.plans.jobs", "wordcount", texts, out])
    assert done.returncode == 0, done.stderr[-2000:]
    assert done.stdout.startswith("word_count\t")
    bad = _run(["quarry.plans.jobs", "nosuchjob"])
    assert bad.returncode == 2 and "usage" in bad.stdout
