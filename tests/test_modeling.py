"""Vectors, scaling, the three classifiers and model persistence.

Labels of the driver's tables carry no signal, so quality is asserted on a
separable label derived from the amount (SURVEY section 5.4)."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from riskloom.operators import evaluation, modeling, sampling
from riskloom.plans import catalog, pipeline
from riskloom.session import scratch_path

from conftest import SF_SMALL, rows


@pytest.fixture(scope="module")
def separable(spark):
    feats = catalog.stored_features(spark, SF_SMALL)
    med = feats.approxQuantile("amt", [0.5], 0.0)[0]
    return feats.withColumn("is_fraud", (F.col("amt") > med).cast("int"))


def test_feature_matrix_order_and_zero_fill(spark):
    df = spark.createDataFrame([(1.5, None, float("nan"))], "amt double, hour int, minute double")
    fm = modeling.feature_matrix(df, ["amt", "hour", "minute"])
    out = modeling.vector_columns_as_fields(fm, "features", ["a", "b", "c"])
    assert rows(out, "a", "b", "c") == [(1.5, 0.0, 0.0)]
    with pytest.raises(ValueError):
        modeling.feature_matrix(df, ["amt", "missing_col"])


def test_scaler_constant_column_is_zero(spark):
    df = spark.createDataFrame([(1.0, 1.0), (3.0, 1.0)], "x double, c double")
    fm = modeling.feature_matrix(df, ["x", "c"])
    z = modeling.fit_scaler(fm).transform(fm)
    out = rows(modeling.vector_columns_as_fields(z, "scaled_features", ["x", "c"]), "x", "c")
    assert [r[1] for r in out] == [0.0, 0.0]
    assert [r[0] for r in out] == pytest.approx([-0.70710678, 0.70710678])


def test_three_models_learn_a_separable_label_and_round_trip(spark, separable):
    train, test = sampling.train_test(separable)
    bal = pipeline.balance(train, "undersample")
    models = modeling.train_all(bal)
    assert list(models) == list(modeling.MODEL_NAMES)
    preds = pipeline.score_models(models, test)
    metrics = {r["model"]: r for r in evaluation.classification_metrics(preds).collect()}
    for name in modeling.MODEL_NAMES:
        assert metrics[name]["roc_auc"] > 0.9, name
    # one scan for all models, and the scores of each model on its own
    plan = preds._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1
    for name in modeling.MODEL_NAMES:
        own = sorted(rows(modeling.score(models[name], test), "trans_num", "prediction", "score"))
        assert sorted(rows(preds.where(F.col("model") == name), "trans_num", "prediction", "score")) == own
    scored = modeling.score(models["Random Forest"], test)
    assert scored.where((F.col("score") < 0) | (F.col("score") > 1)).count() == 0
    path = modeling.save_model(models["Logistic Regression"], scratch_path(spark, "models"), "Logistic Regression")
    assert path.endswith("Logistic_Regression")
    again = modeling.score(modeling.load_model(path), test)
    a = sorted(rows(modeling.score(models["Logistic Regression"], test), "trans_num", "score"))
    b = sorted(rows(again, "trans_num", "score"))
    assert a == b
