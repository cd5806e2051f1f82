"""Feature vectors, scaling and the three classifiers.

Each model is a whole ``PipelineModel`` (assembler -> scaler -> classifier), so
a saved model scores raw feature tables on its own and the scaler is fitted on
the training rows only.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.operators.cleaning import present
from riskloom.operators.missing import zero_fill

LABEL = "is_fraud"
# Fixed values (reference behaviour): the model features, in order.
MODEL_FEATURES = (
    "amt",
    "hour",
    "minute",
    "is_night",
    "is_business_hours",
    "day_of_month",
    "user_transaction_count",
    "user_avg_amt",
    "hours_since_last_trans",
    "is_rapid_transaction",
    "trans_count_last_24h",
)
# Fixed values (reference behaviour): hyper-parameters of the three models.
LR_PARAMS = {"maxIter": 50, "regParam": 0.01, "elasticNetParam": 0.5}
RF_PARAMS = {"numTrees": 50, "maxDepth": 10, "seed": 42}
GBT_PARAMS = {"maxIter": 50, "maxDepth": 5, "stepSize": 0.1, "seed": 42}
MODEL_NAMES = ("Logistic Regression", "Random Forest", "Gradient Boosting")


def select_features(df: DataFrame, features: Sequence[str] = MODEL_FEATURES, missing: str = "error") -> list[str]:
    """P10: the wanted features that exist, in order (absent -> error by default)."""
    return present(df, features, missing)


def assembler(features: Sequence[str], output: str = "features") -> VectorAssembler:
    """L1: rows with NULL/NaN inputs are skipped (after M8 none are)."""
    return VectorAssembler(inputCols=list(features), outputCol=output, handleInvalid="skip")


def scaler(input_col: str = "features", output: str = "scaled_features") -> StandardScaler:
    """L2: (x - mean) / sample std; a constant column scales to 0.0."""
    return StandardScaler(inputCol=input_col, outputCol=output, withStd=True, withMean=True)


def feature_matrix(df: DataFrame, features: Sequence[str] = MODEL_FEATURES, missing: str = "error") -> DataFrame:
    """P10 + M8 + L1: zero-fill the features and assemble the ``features`` vector."""
    feats = select_features(df, features, missing)
    return assembler(feats).transform(zero_fill(df, feats))


def fit_scaler(train: DataFrame, input_col: str = "features"):
    """L2 fitted on the training part only (no test leakage)."""
    return scaler(input_col).fit(train)


def vector_columns_as_fields(df: DataFrame, vector: str, names: Sequence[str], prefix: str = "") -> DataFrame:
    """Expose a vector column as one double column per element (for reports/oracles)."""
    arr = vector_to_array(F.col(vector))
    return df.withColumns({f"{prefix}{n}": arr[i] for i, n in enumerate(names)})


def classifier(name: str, features_col: str = "scaled_features", label: str = LABEL):
    """L3-L5 with the reference's hyper-parameters."""
    common = {"featuresCol": features_col, "labelCol": label}
    if name == "Logistic Regression":
        return LogisticRegression(**common, **LR_PARAMS)
    if name == "Random Forest":
        return RandomForestClassifier(**common, **RF_PARAMS)
    if name == "Gradient Boosting":
        return GBTClassifier(**common, **GBT_PARAMS)
    raise ValueError(f"unknown model {name!r}")


def model_pipeline(name: str, features: Sequence[str] = MODEL_FEATURES) -> Pipeline:
    return Pipeline(stages=[assembler(features), scaler(), classifier(name)])


def prepare_training(train: DataFrame, features: Sequence[str] = MODEL_FEATURES) -> DataFrame:
    """Label as double and zero-filled features: the columns the pipelines read."""
    feats = select_features(train, features)
    return zero_fill(train, feats).withColumn(LABEL, F.col(LABEL).cast("double"))


def train_model(train: DataFrame, name: str, features: Sequence[str] = MODEL_FEATURES) -> PipelineModel:
    """One of L3-L5 as a fitted ``PipelineModel``."""
    return model_pipeline(name, features).fit(prepare_training(train, features))


def train_all(
    train: DataFrame, names: Sequence[str] = MODEL_NAMES, features: Sequence[str] = MODEL_FEATURES
) -> dict[str, PipelineModel]:
    """Fit every model on one persisted copy of the training rows, of the columns that the models read."""
    data = prepare_training(train, features).select(LABEL, *select_features(train, features)).persist()
    try:
        return {n: model_pipeline(n, features).fit(data) for n in names}
    finally:
        data.unpersist()


def score(model: PipelineModel, df: DataFrame, features: Sequence[str] = MODEL_FEATURES) -> DataFrame:
    """Score a table -> adds ``rawPrediction``, ``probability``, ``prediction``
    and the positive-class ``score`` (probability of label 1)."""
    feats = select_features(df, features)
    out = model.transform(zero_fill(df, feats))
    return out.withColumn("score", vector_to_array(F.col("probability"))[1])


def score_all(models: Mapping[str, PipelineModel], df: DataFrame, features: Sequence[str] = MODEL_FEATURES, keep: Sequence[str] = ()) -> DataFrame:
    """E1 for all models in one scan: ``keep`` with ``model``, ``prediction`` and ``score``,
    a row for each model and row of ``df``.

    The models are transforms in a chain, each with the vectors of the one before dropped and
    its results under a name of its own; one generator gives the long form."""
    feats = select_features(df, features)
    out = zero_fill(df, feats).select(*dict.fromkeys([*keep, *feats]))
    results = []
    for i, (name, model) in enumerate(models.items()):
        before = out.columns
        out = model.transform(out)
        own = {f"_p{i}": F.col("prediction"), f"_s{i}": vector_to_array(F.col("probability"))[1]}
        out = out.select(*before, *[c.alias(n) for n, c in own.items()])
        results.append(F.struct(F.lit(name).alias("model"), F.col(f"_p{i}").alias("prediction"), F.col(f"_s{i}").alias("score")))
    return out.select(*keep, F.inline(F.array(*results)))


def save_model(model: PipelineModel, base_path: str, name: str) -> str:
    """K3: overwrite-save under ``base_path``; spaces in the name become '_'."""
    path = f"{base_path.rstrip('/')}/{name.replace(' ', '_')}"
    model.write().overwrite().save(path)
    return path


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)
