"""One-aggregate metrics agree with MLlib's evaluators; exact AUC agrees
with brute-force pair counting."""

from __future__ import annotations

import random

import pytest
from pyspark.ml.evaluation import MulticlassClassificationEvaluator

from riskloom.operators import evaluation

from conftest import rows


def _preds(spark, n=400, seed=7):
    rnd = random.Random(seed)
    data = []
    for i in range(n):
        y = 1 if rnd.random() < 0.3 else 0
        s = round(rnd.random() + 0.3 * y, 2)  # ties on purpose
        data.append(("m1", i, y, 1.0 if s > 0.6 else 0.0, s))
        data.append(("m2", i, y, 1.0 if rnd.random() < 0.5 else 0.0, float(rnd.randint(0, 3))))
    return spark.createDataFrame(data, "model string, trans_num int, is_fraud int, prediction double, score double")


def _brute_auc(pairs):
    pos = [s for y, s in pairs if y == 1]
    neg = [s for y, s in pairs if y == 0]
    tot = sum(1.0 if p > q else 0.5 if p == q else 0.0 for p in pos for q in neg)
    return tot / (len(pos) * len(neg))


def test_metrics_match_mllib(spark):
    df = _preds(spark)
    got = {r["model"]: r for r in evaluation.classification_metrics(df).collect()}
    for m in ("m1", "m2"):
        part = df.where(df.model == m).selectExpr("cast(is_fraud as double) as is_fraud", "prediction")
        ev = MulticlassClassificationEvaluator(labelCol="is_fraud", predictionCol="prediction")
        assert got[m]["f1_score"] == pytest.approx(ev.setMetricName("f1").evaluate(part))
        assert got[m]["accuracy"] == pytest.approx(ev.setMetricName("accuracy").evaluate(part))
        p = ev.setMetricName("precisionByLabel").setMetricLabel(1.0).evaluate(part)
        r = ev.setMetricName("recallByLabel").setMetricLabel(1.0).evaluate(part)
        assert got[m]["precision"] == pytest.approx(p)
        assert got[m]["recall"] == pytest.approx(r)
        assert got[m]["tn"] + got[m]["fp"] + got[m]["fn"] + got[m]["tp"] == 400


def test_exact_auc_with_ties(spark):
    df = _preds(spark)
    auc = dict(rows(evaluation.roc_auc(df)))
    for m in ("m1", "m2"):
        pairs = [(r[0], r[1]) for r in rows(df.where(df.model == m), "is_fraud", "score")]
        assert auc[m] == pytest.approx(_brute_auc(pairs), abs=1e-12)


def test_confusion_absent_cells_are_zero(spark):
    df = spark.createDataFrame([("m", 1, 1.0, 0.9), ("m", 1, 1.0, 0.8)], "model string, is_fraud int, prediction double, score double")
    assert rows(evaluation.confusion_matrix(df)) == [("m", 0, 0, 0, 2)]


def test_best_model_tie_goes_to_training_order(spark):
    m = spark.createDataFrame(
        [("A", 0.5, 0.7, 0.9), ("B", 0.5, 0.8, 0.9)], "model string, accuracy double, f1_score double, roc_auc double"
    )
    got = {r[0]: r[1] for r in rows(evaluation.best_model(m, order=["B", "A"]))}
    assert got == {"accuracy": "B", "f1_score": "B", "roc_auc": "B"}
    got = {r[0]: r[1] for r in rows(evaluation.best_model(m, order=["A", "B"]))}
    assert got == {"accuracy": "A", "f1_score": "B", "roc_auc": "A"}
