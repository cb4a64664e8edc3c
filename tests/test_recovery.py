import os
import subprocess
import sys

from conftest import ROOT, SMOKE_DIR


def test_checkpointed_join_survives_a_failed_task():
    """A scan task fails on its first attempt; Spark reruns it and every answer is unchanged."""
    out = subprocess.run(
        [sys.executable, os.path.join(ROOT, "tests", "recovery_job.py"), SMOKE_DIR],
        capture_output=True, text=True, timeout=600,
    )
    assert out.returncode == 0, out.stderr[-2000:]
    assert "RECOVERED" in out.stdout
    assert "injected task failure" in out.stderr  # the failure really happened
