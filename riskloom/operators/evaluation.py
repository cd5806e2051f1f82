"""Classifier evaluation (E1-E11) over a long prediction table.

Input: one row per (model, scored row) with the label, the 0/1 ``prediction``
and a ``score`` that ranks positives higher.  Every count-based metric of every
model comes from ONE grouped aggregate (four ``count_if`` per model) instead of
one evaluator job per metric per model; the exact ROC AUC of all models is one
pass of running counts over ranges of the scores.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskloom.sources.files import materialize

LABEL = "is_fraud"
MODEL = "model"
# Fixed values (reference behaviour): metrics compared across models and the
# metrics used to pick a best model.
COMPARISON_METRICS = ("accuracy", "precision", "recall", "f1_score", "roc_auc")
BEST_BY = ("accuracy", "f1_score", "roc_auc")


def confusion_matrix(preds: DataFrame, label: str = LABEL, prediction: str = "prediction", model: str = MODEL) -> DataFrame:
    """Tn / fp / fn / tp per model; an absent cell is 0."""
    y = F.col(label).cast("double")
    p = F.col(prediction).cast("double")
    return preds.groupBy(model).agg(
        F.count_if((y == 0) & (p == 0)).cast("bigint").alias("tn"),
        F.count_if((y == 0) & (p == 1)).cast("bigint").alias("fp"),
        F.count_if((y == 1) & (p == 0)).cast("bigint").alias("fn"),
        F.count_if((y == 1) & (p == 1)).cast("bigint").alias("tp"),
    )


def _ratio0(num: Column, den: Column) -> Column:
    """num / den, 0.0 when den is 0 (MLlib's convention for precision)."""
    return F.coalesce(F.try_divide(num.cast("double"), den.cast("double")), F.lit(0.0))


def _f(p: Column, r: Column) -> Column:
    return F.when((p + r) == 0, F.lit(0.0)).otherwise(F.lit(2.0) * p * r / (p + r))


def rates_from_counts(cm: DataFrame) -> DataFrame:
    """E2-E5 from confusion counts, with MLlib's semantics.

    precision/recall/f1_positive are for label 1; ``f1_score`` is the
    support-weighted F1 over both labels (what ``metricName="f1"`` returns)."""
    tn, fp, fn, tp = (F.col(c) for c in ("tn", "fp", "fn", "tp"))
    n0, n1 = tn + fp, fn + tp
    n = n0 + n1
    p1, r1 = _ratio0(tp, tp + fp), F.try_divide(tp.cast("double"), n1.cast("double"))
    p0, r0 = _ratio0(tn, tn + fn), F.try_divide(tn.cast("double"), n0.cast("double"))
    f1_1, f1_0 = _f(p1, F.coalesce(r1, F.lit(0.0))), _f(p0, F.coalesce(r0, F.lit(0.0)))
    weighted = F.try_divide(n0.cast("double") * f1_0 + n1.cast("double") * f1_1, n.cast("double"))
    return cm.withColumns(
        {
            "accuracy": F.try_divide((tp + tn).cast("double"), n.cast("double")),
            "precision": p1,
            "recall": r1,
            "f1_score": weighted,
            "f1_positive": f1_1,
        }
    )


def roc_auc(preds: DataFrame, label: str = LABEL, score: str = "score", model: str = MODEL) -> DataFrame:
    """Exact area under ROC of every model as ``(model, roc_auc)``.

    Ties get half credit (the Mann-Whitney statistic).  Rows are counted by model
    and score, the counts are dealt out by range, each range adds up its own rows
    from the totals of the ranges below it: a constant number of jobs for any
    number of models, and no task holds more than one range.  Without label 1 the area
    is 0, without label 0 it is 1, as MLlib has it."""
    y = F.col(label).cast("double")
    counts = (
        preds.where(F.col(score).isNotNull() & y.isin(0.0, 1.0))
        .groupBy(F.col(model).alias("_model"), F.col(score).cast("double").alias("_s"))
        .agg(F.count_if(y == 1).alias("_pos"), F.count_if(y == 0).alias("_neg"))
    )
    ranged = materialize(counts.repartitionByRange("_model", "_s").withColumn("_range", F.spark_partition_id()), "auc-counts")
    totals = ranged.groupBy("_model", "_range").agg(F.sum("_pos").alias("_p"), F.sum("_neg").alias("_n"))
    lower = Window.partitionBy("_model").orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    every = Window.partitionBy("_model")
    totals = totals.select(
        F.col("_model").alias("_m"),
        F.col("_range").alias("_r"),
        F.coalesce(F.sum("_n").over(lower), F.lit(0)).alias("_base"),
        F.sum("_p").over(every).alias("_all_pos"),
        F.sum("_n").over(every).alias("_all_neg"),
    )
    inside = Window.partitionBy("_model", "_range").orderBy("_s").rowsBetween(Window.unboundedPreceding, -1)
    below = F.col("_base") + F.coalesce(F.sum("_neg").over(inside), F.lit(0))
    joined = ranged.join(totals, F.col("_model").eqNullSafe(F.col("_m")) & (F.col("_range") == F.col("_r")))
    wins = joined.withColumn("_wins", F.col("_pos") * (below + F.col("_neg") / 2))
    summed = wins.groupBy("_model").agg(F.sum("_wins").alias("_w"), F.max("_all_pos").alias("_p"), F.max("_all_neg").alias("_n"))
    area = F.when(F.col("_p") == 0, 0.0).when(F.col("_n") == 0, 1.0).otherwise(F.try_divide(F.col("_w"), F.col("_p").cast("double") * F.col("_n")))
    return summed.select(F.col("_model").alias(model), area.alias("roc_auc"))


def classification_metrics(
    preds: DataFrame,
    label: str = LABEL,
    prediction: str = "prediction",
    score: str = "score",
    model: str = MODEL,
) -> DataFrame:
    """One row per model -- model, accuracy, precision, recall, f1_score,
    f1_positive, roc_auc, tn, fp, fn, tp."""
    cm = confusion_matrix(preds, label, prediction, model)
    auc = roc_auc(preds, label, score, model)
    return rates_from_counts(cm).join(auc, on=model, how="left")


def model_comparison(metrics: DataFrame, digits: int = 4) -> DataFrame:
    """The five comparison metrics per model, rounded."""
    return metrics.select(MODEL, *[F.bround(F.col(m), digits).alias(m) for m in COMPARISON_METRICS])


def best_model(metrics: DataFrame, by: Sequence[str] = BEST_BY, order: Sequence[str] | None = None) -> DataFrame:
    """For each metric, the model with the highest value as
    ``(metric, model, value)``.  Ties go to the earlier model in ``order``
    (the training order) or, without it, to the smaller model name."""
    long = metrics.select(MODEL, *by).unpivot([MODEL], list(by), "metric", "value")
    if order:
        pos = F.array_position(F.array(*[F.lit(m) for m in order]), F.col(MODEL))
    else:
        pos = F.lit(0)
    w = Window.partitionBy("metric").orderBy(F.col("value").desc_nulls_last(), pos, F.col(MODEL))
    ranked = long.withColumn("_rank", F.row_number().over(w))
    return ranked.where(F.col("_rank") == 1).select("metric", MODEL, "value")
