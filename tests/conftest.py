from __future__ import annotations

import decimal
import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

# Expected sums are exact: the usual 28 digits round a 1e15 with sixteen places.
decimal.getcontext().prec = 100

SMOKE_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from quarry.session import build_session

    s = build_session(master="local[*]", app="quarry-tests", shuffle_partitions=8)
    yield s
    s.stop()


@pytest.fixture()
def scratch(tmp_path):
    """A fresh per-test folder for files a test writes and reads back."""
    return str(tmp_path)


def rows(df, *cols):
    """Collected rows as sorted tuples (tests only)."""
    sel = df.select(*cols) if cols else df
    return sorted(tuple(r) for r in sel.collect())


def write_text(path: str, text: str, newline: str = "\n") -> str:
    with open(path, "w", encoding="utf-8", newline="") as fh:
        fh.write(text.replace("\n", newline))
    return path
