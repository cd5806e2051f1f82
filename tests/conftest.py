from __future__ import annotations

import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))

from riskloom.session import local_session  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"
SF_ORACLE = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    s = local_session(4, shuffle_partitions=4, app="riskloom-tests")
    yield s
    s.stop()


def rows(df, *cols):
    """Collect ``cols`` (all columns by default) as a list of tuples."""
    sel = df.select(*cols) if cols else df
    return [tuple(r) for r in sel.collect()]
