"""Reports against numpy/pandas on small frames."""

from __future__ import annotations

import numpy as np
import pytest

from riskloom.operators import profiling

from conftest import rows


def _frame(spark, n=300, seed=3):
    rnd = np.random.default_rng(seed)
    amt = rnd.gamma(2.0, 20.0, n)
    hour = rnd.integers(0, 24, n)
    y = (rnd.random(n) < 0.2 + 0.01 * hour).astype(int)
    const = np.ones(n)
    data = [(float(a), int(h), int(yy), float(c)) for a, h, yy, c in zip(amt, hour, y, const)]
    return spark.createDataFrame(data, "amt double, hour int, is_fraud int, is_night double"), amt, hour, y


def test_correlation_matrix_matches_numpy_and_constant_is_null(spark):
    df, amt, hour, y = _frame(spark)
    got = {(a, b): c for a, b, c in rows(profiling.correlation_matrix(df))}
    want = np.corrcoef(np.vstack([amt, hour, y]))
    names = ["amt", "hour", "is_fraud"]
    for i, a in enumerate(names):
        for j, b in enumerate(names):
            assert got[(a, b)] == pytest.approx(round(want[i, j], 3), abs=1e-9)
    assert got[("is_night", "amt")] is None and got[("is_night", "is_night")] is None
    assert len(got) == 16


def test_label_correlation_top_drops_undefined(spark):
    df, *_ = _frame(spark)
    out = rows(profiling.label_correlation_top(df, 5))
    assert [r[1] for r in out] and "is_night" not in [r[1] for r in out]
    assert [r[0] for r in out] == list(range(1, len(out) + 1))


def test_rate_by_hour_and_class_distribution(spark):
    df, amt, hour, y = _frame(spark)
    top = rows(profiling.rate_by_hour_top(df, 5))
    rates = {h: y[hour == h].mean() * 100 for h in np.unique(hour)}
    best = sorted(rates, key=lambda h: (-rates[h], h))[:5]
    assert [r[1] for r in top] == best
    dist = {r[0]: (r[1], r[2]) for r in rows(profiling.class_distribution(df))}
    assert dist[1][0] == int(y.sum()) and dist[1][1] == pytest.approx(round(y.mean() * 100, 4))


def test_stats_by_class_median_interpolates(spark):
    df = spark.createDataFrame([(1.0, 0), (2.0, 0), (3.0, 0), (10.0, 0), (5.0, 1)], "amt double, is_fraud int")
    got = {r[0]: r for r in profiling.stats_by_class(df).collect()}
    assert got[0]["amt_median"] == 2.5 and got[0]["amt_count"] == 4 and got[0]["amt_mean"] == 4.0
    assert got[1]["amt_std"] is None  # one row: sample std undefined


def test_segment_rates_median_split(spark):
    df = spark.createDataFrame(
        [(1.0, 0, 0, 0, 1), (2.0, 1, 1, 0, 2), (3.0, 1, 0, 1, 3), (4.0, 0, 1, 1, 4)],
        "amt double, is_fraud int, is_night int, is_rapid_transaction int, user_transaction_count int",
    )
    got = {(r[0], r[1]): (r[2], r[3]) for r in rows(profiling.segment_rates(df))}
    assert got[("amount", "high")] == (2, 50.0) and got[("amount", "low")] == (2, 50.0)
    assert got[("time_of_day", "night")] == (2, 50.0)
    assert got[("speed", "rapid")] == (2, 50.0)
    assert set(k[0] for k in got) == {"time_of_day", "amount", "frequency", "speed"}


def test_split_audit_handles_parts(spark):
    df = spark.createDataFrame([("train", 1), ("train", 0), ("test", 0)], "split string, is_fraud int")
    got = {r[0]: r[1:] for r in rows(profiling.split_audit(df))}
    assert got == {"train": (2, 1, 50.0), "test": (1, 0, 0.0)}


def test_reports_prune_columns_and_push_filters(spark):
    import re

    from riskloom.plans import catalog

    from conftest import SF_SMALL

    stored = catalog.stored_features(spark, SF_SMALL)

    def read_schemas(df):
        plan = df._jdf.queryExecution().executedPlan().toString()
        return [set(re.findall(r"(\w+):", m)) for m in re.findall(r"ReadSchema: struct<([^>]*)>", plan)], plan

    schemas, plan = read_schemas(profiling.class_distribution(stored))
    assert schemas and all(s == {"is_fraud"} for s in schemas)
    assert "PushedFilters: [IsNotNull(is_fraud)]" in plan
    schemas, _ = read_schemas(profiling.rate_by_hour_top(stored))
    assert schemas and all(s == {"is_fraud", "hour"} for s in schemas)


def test_amount_summary_counts_nan_as_missing(spark):
    df = spark.createDataFrame([(1.0, 0), (2.0, 1), (float("nan"), 1), (None, 0)], "amt double, is_fraud int")
    r = profiling.amount_summary(df).first()
    assert (r.n, r["mean"], r["max"], r.p50) == (2, 1.5, 2.0, 1.5)
