"""Registered queries against their DuckDB SQL on the smallest tables."""

from __future__ import annotations

import sys

import pytest

from riskloom.llm.queries import ORACLE_SQL, QUERIES

from .conftest import ROOT, SF

sys.path.insert(0, str(ROOT / "tools"))

from oracle_check import _rows, duck  # noqa: E402


@pytest.mark.parametrize("key", ORACLE_SQL)
def test_query_matches_its_sql(spark, key):
    got = QUERIES[key](spark, SF)
    want = duck(SF).execute(ORACLE_SQL[key])
    columns = [d[0] for d in want.description]
    assert sorted(got.columns) == sorted(columns)
    assert _rows(got.columns, [tuple(r) for r in got.collect()]) == _rows(columns, want.fetchall())
