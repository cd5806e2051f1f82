"""The end-to-end batch with every sink, on the smallest tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from riskloom.operators import modeling
from riskloom.plans import pipeline
from riskloom.session import scratch_path
from riskloom.sources import files, fixtures

from conftest import SF_SMALL


def test_run_pipeline_end_to_end(spark):
    raw = fixtures.raw_transactions(spark, SF_SMALL)
    paths = {k: scratch_path(spark, k) for k in ("data", "models", "metrics")}
    res = pipeline.run_pipeline(
        raw,
        balance_method="oversample",
        save_data_path=paths["data"],
        save_model_path=paths["models"],
        save_metrics_path=paths["metrics"],
    )
    # T5 dropped-row count is a lazy one-row report
    obs = res.reports["valid_dates"].first().asDict()
    assert obs["rows_in"] >= obs["rows_invalid_date"] > 0
    assert res.features.count() == obs["rows_in"] - obs["rows_invalid_date"]
    # reports are lazy DataFrames over the whole feature table
    assert set(res.reports) >= {"class_distribution", "correlation_matrix", "segment_rates"}
    assert res.reports["class_distribution"].agg(F.sum("n_rows")).first()[0] == res.features.count()
    # balanced training part is exactly 1:1, test part untouched (natural ratio)
    counts = dict(res.balanced_train.groupBy("is_fraud").count().collect())
    assert counts[0] == counts[1]
    assert res.balanced_train.join(res.test, "trans_num", "left_semi").count() == 0
    # rows of each step, in order
    steps = [(r.step, r.n_rows) for r in res.reports["row_counts"].collect()]
    assert [s for s, _ in steps] == ["raw", "features", "train", "balanced_train", "test"]
    n = dict(steps)
    assert n["raw"] == raw.count() and n["train"] + n["test"] == n["features"] == res.features.count() and n["balanced_train"] == sum(counts.values())
    # metrics: one row per model; best model per metric; sinks written
    assert res.metrics.count() == 3
    assert sorted(r[0] for r in res.best.select("metric").collect()) == ["accuracy", "f1_score", "roc_auc"]
    assert modeling.load_model(res.saved["model"]) is not None
    saved = files.read_csv(spark, paths["data"])
    assert "features" not in saved.columns and saved.count() == res.balanced_train.count()
    assert files.read_table(spark, paths["metrics"], fmt="csv", header="true").count() == 3


def test_unknown_balance_method_is_an_error(spark):
    df = spark.createDataFrame([("1", 1)], "trans_num string, is_fraud int")
    try:
        pipeline.balance(df, "smote")
    except ValueError:
        return
    raise AssertionError("expected ValueError")
