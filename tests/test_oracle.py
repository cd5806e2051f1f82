"""Registered queries against their DuckDB oracle SQL on the small tables, and
the driver contract of ``__spark_entry__``."""

from __future__ import annotations

import importlib
import sys
from pathlib import Path

import pytest

from conftest import ROOT, SF_SMALL

sys.path.insert(0, str(ROOT / "tools"))

from oracle_check import _rows, duck  # noqa: E402

entry = importlib.import_module("__spark_entry__")

# A cross-section: every operator family, all cheap at sf0.001.
KEYS = [
    "typed",
    "clean_merchant",
    "null_profile",
    "impute_median",
    "impute_default",
    "parsed_time_iso",
    "calendar_flags",
    "user_totals",
    "prev_event",
    "trailing_count_packed",
    "features",
    "correlation_matrix",
    "stats_by_class",
    "segment_rates",
    "undersample",
    "oversample",
    "scaled_features",
    "classification_metrics",
    "best_model",
    "csv_lines",
    "typed_contract",
    "impute_contract",
    "features_contract",
    "features_carried",
    "features_incremental",
    "totals_incremental",
    "csv_rejects",
    "months_rewritten",
    "resumed_features",
    "median_sketch",
    "balance_train",
    "skip_invalid",
    "valid_date_report",
]


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


@pytest.mark.parametrize("key", KEYS)
def test_query_matches_oracle(spark, con, key):
    sdf = entry.queries()[key](spark, SF_SMALL)
    s_rows = [tuple(r) for r in sdf.collect()]
    res = con.execute(entry.oracle_sql()[key])
    d_cols = [d[0] for d in res.description]
    d_rows = res.fetchall()
    assert sorted(sdf.columns) == sorted(d_cols)
    assert _rows(sdf.columns, s_rows) == _rows(d_cols, d_rows)


def test_contract(spark):
    qs, sql = entry.QUERIES, {k: v for k, v in entry.oracle_sql().items() if k in entry.QUERIES}
    assert set(qs) <= set(entry.queries())
    assert len(qs) == 65
    assert set(sql) == set(qs)
    df = entry.entry(spark)
    assert df.columns == ["rank", "hour", "n_rows", "fraud_pct"]
    assert 0 < df.count() <= 5


def test_every_query_reads_the_given_tables():
    # every oracle statement reads a driver table (directly or through the raw view)
    for key, text in entry.ORACLE_SQL.items():
        assert "FROM events" in text or "FROM orders" in text, key
