"""Registered queries: one callable ``(spark, sf_dir) -> DataFrame`` per key.

Every query reads the driver's parquet tables (``events`` through the derived
raw transaction table, ``orders`` for date layouts) over all rows.  Computed
doubles that depend on summation order are rounded to 6 decimals in the
output so that two engines can be compared value by value.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.operators import (
    behavior,
    calendar,
    cleaning,
    evaluation,
    missing,
    modeling,
    profiling,
    sampling,
    sketches,
    timeline,
)
from riskloom.plans import pipeline
from riskloom.session import scratch_path
from riskloom.sources import files, fixtures
from riskloom.sources.stages import Stages, input_digest

Query = Callable[[SparkSession, str], DataFrame]

R6 = 6  # decimals of order-dependent doubles in query outputs


def _r(c: str, digits: int = R6):
    return F.round(F.col(c), digits).alias(c)


# ---------------------------------------------------------------- shared inputs
def raw(spark: SparkSession, sf: str) -> DataFrame:
    return fixtures.raw_transactions(spark, sf)


def typed(spark: SparkSession, sf: str) -> DataFrame:
    return cleaning.clean_and_type(raw(spark, sf))


def prepared(spark: SparkSession, sf: str) -> DataFrame:
    return pipeline.prepare(raw(spark, sf))


def calendar_table(spark: SparkSession, sf: str) -> DataFrame:
    return calendar.calendar_features(prepared(spark, sf))


def keyed(spark: SparkSession, sf: str) -> DataFrame:
    return behavior.add_user_key(calendar_table(spark, sf))


def features(spark: SparkSession, sf: str, clock: str = "epoch") -> DataFrame:
    return pipeline.engineer_features(prepared(spark, sf), clock=clock)


def stored_features(spark: SparkSession, sf: str) -> DataFrame:
    """The feature table written once to the shared checkpoint folder, for
    queries that read it more than once (subqueries, union branches, fits)."""
    return files.materialize(features(spark, sf), "features")


def txn_rule_scores(spark: SparkSession, sf: str) -> DataFrame:
    """Rule-based predictions (no model) for the evaluation operators."""
    t = calendar_table(spark, sf)
    amt_rule = t.select(
        F.col("trans_num"),
        F.lit("amt_rule").alias("model"),
        F.col("is_fraud"),
        F.when(F.col("amt") > 40, 1.0).otherwise(0.0).alias("prediction"),
        F.col("amt").cast("double").alias("score"),
    )
    night_rule = t.select(
        F.col("trans_num"),
        F.lit("night_rule").alias("model"),
        F.col("is_fraud"),
        F.when((F.col("hour") >= 22) | (F.col("hour") <= 5), 1.0).otherwise(0.0).alias("prediction"),
        (-F.col("hour")).cast("double").alias("score"),
    )
    return amt_rule.unionByName(night_rule)


# ------------------------------------------------------------ sources / sinks
def q_csv_roundtrip(spark, sf):
    """S1 + K1: write the raw table as CSV (quotes, backslashes, line breaks
    inside fields) to the shared scratch folder and scan it back."""
    path = scratch_path(spark, "csv-roundtrip")
    files.save_table(raw(spark, sf), path, fmt="csv")
    return files.read_csv(spark, path, columns=fixtures.RAW_COLUMNS, multi_line=True)


def q_csv_lines(spark, sf):
    """S1, line mode (large files split): fields without line breaks, and rows shorter and
    longer than the header."""
    flat = raw(spark, sf).withColumn("merchant", F.regexp_replace("merchant", "[\\n\\r]", " "))
    path = scratch_path(spark, "csv-lines")
    files.save_table(flat, path, fmt="csv")
    # the same lines read with two columns less and one more than they have
    short = files.read_csv(spark, path, columns=fixtures.RAW_COLUMNS[:-2])
    wide = files.read_csv(spark, path, columns=[*fixtures.RAW_COLUMNS, "absent"])
    return wide.join(short.select("trans_num", F.col("city").alias("city_of_short")), "trans_num")


LINE_COLUMNS = ("event_id", "event_type", "props", "user_id", "last")


def q_csv_rejects(spark, sf):
    """S1 with a quarantine: the records of uneven lines that fit, and the others with their reason."""
    path = scratch_path(spark, "uneven")
    lines = fixtures.uneven_lines(spark, sf)
    lines.write.text(path)
    fits, others = files.read_csv_checked(spark, path, LINE_COLUMNS, header=False)
    kept = fits.select("event_id", "props", F.lit("fits").alias("reason"), F.lit(len(LINE_COLUMNS)).alias("n_fields"))
    return kept.unionByName(others.select(F.substring_index("raw", ",", 1).alias("event_id"), F.lit(None).cast("string").alias("props"), "reason", "n_fields"))


def q_months_rewritten(spark, sf):
    """K1: months written in two batches, one of them again with other rows and again with its own; the
    others stay as they were."""
    path = scratch_path(spark, "months")
    cal = files.materialize(calendar_table(spark, sf).select("trans_num", "amt", "is_fraud", "year", "month"), "months-source")

    def save(df):
        files.save_table(df, path, fmt="parquet", partition_by=["year", "month"], only_touched=True)

    save(cal.where("month <= 6"))
    save(cal.where("month > 6"))
    save(cal.where("month = 6").withColumn("amt", F.lit(-1.0).cast("float")))
    save(cal.where("month = 6"))
    return files.read_table(spark, path)


def q_resumed_features(spark, sf):
    """The feature stage of a run, read by a second run through the manifest."""
    source, folder = raw(spark, sf), scratch_path(spark, "resume")
    digest = input_digest(source, clock="epoch")
    Stages(spark, folder, digest).keep("features", lambda: features(spark, sf))
    again = Stages(spark, folder, digest)
    found = again.keep("features", lambda: features(spark, sf))
    if again.resumed != ["features"]:
        raise RuntimeError("the stored stage was not found")
    return _feature_report(found)


def q_drop_vectors(spark, sf):
    """K2: the assembled feature matrix written without vector columns and read back."""
    fm = modeling.feature_matrix(features(spark, sf))
    kept = files.drop_vector_columns(fm)
    path = scratch_path(spark, "no-vectors")
    files.save_table(kept, path, fmt="parquet")
    cols = ["trans_num", "is_fraud", *modeling.MODEL_FEATURES]
    stored = files.read_table(spark, path)
    return stored.select(*[_r(c) if c in ("user_avg_amt", "hours_since_last_trans") else F.col(c) for c in cols])


# -------------------------------------------------------- the whole input contract
def contract(spark: SparkSession, sf: str) -> DataFrame:
    return fixtures.contract_transactions(spark, sf)


def q_typed_contract(spark, sf):
    """P1-P5, C1-C4 on every column of the raw contract."""
    return cleaning.clean_and_type(contract(spark, sf))


def q_impute_contract(spark, sf):
    """M2-M6 with the default (approximate) median and text fill."""
    filled = missing.handle_missing(cleaning.clean_and_type(contract(spark, sf)), essential=None)
    return filled.select("trans_num", "city_pop", "state", "job", "merchant")


def q_features_contract(spark, sf):
    """R3 on rows with quoted and time-less dates."""
    return _feature_report(pipeline.engineer_features(pipeline.prepare(contract(spark, sf))))


def q_run_pipeline(spark, sf):
    """R1 end to end with its sinks: each model scored every labelled test row, its metrics are
    proportions, and what was saved can be read."""
    base = scratch_path(spark, "run")
    done = pipeline.run_pipeline(
        raw(spark, sf), do_eda=False, save_data_path=f"{base}/data", save_model_path=f"{base}/model", save_metrics_path=f"{base}/metrics"
    )
    saved = files.read_table(spark, done.saved["metrics"], fmt="csv", header="true", inferSchema="true")
    kept = files.read_csv(spark, done.saved["data"]).count()
    modeling.load_model(done.saved["model"])
    ok = F.lit(True)
    for c in _METRIC_COLS:
        ok = ok & F.col(c).between(0.0, 1.0)
    return saved.select(
        "model", (F.col("tn") + F.col("fp") + F.col("fn") + F.col("tp")).cast("bigint").alias("n_scored"), F.lit(kept).cast("bigint").alias("n_balanced"), ok.alias("proportions")
    )


# ------------------------------------------------------------ typing, cleaning
def q_typed(spark, sf):
    return typed(spark, sf)


def q_clean_strings(spark, sf):
    r = cleaning.clean_string_columns(raw(spark, sf))
    return r.select("trans_num", "merchant", "category", "city", "job", "dob")


def q_clean_merchant(spark, sf):
    r = raw(spark, sf)
    return cleaning.clean_merchant(r).select("trans_num", "merchant")


# ---------------------------------------------------------------- missing data
def q_null_profile(spark, sf):
    t = typed(spark, sf)
    before = missing.null_profile(t).withColumn("stage", F.lit("typed"))
    after = missing.null_profile(missing.handle_missing(t), nonzero_only=False).withColumn("stage", F.lit("imputed"))
    return before.unionByName(after).select("stage", "column_name", "null_count")


def q_drop_essential(spark, sf):
    t = typed(spark, sf)
    return missing.drop_essential(t, missing.essential_columns(t)).select("trans_num", "amt", "is_fraud")


def q_impute_median(spark, sf):
    t = typed(spark, sf)
    out = missing.handle_missing(t, essential=["is_fraud"], exact_median=True)
    return out.select("trans_num", "amt", "is_fraud")


def q_impute_unknown(spark, sf):
    return prepared(spark, sf).select("trans_num", "merchant", "job", "trans_date_trans_time")


def q_impute_default(spark, sf):
    return pipeline.missing_value_stage(raw(spark, sf))


# ---------------------------------------------------------------- date & time
_FIELDS = ["trans_num", "year", "month", "day", "hour", "minute"]


def q_parsed_time(spark, sf):
    return calendar.parse_datetime(typed(spark, sf), iso_dates=False).select(*_FIELDS)


def q_parsed_time_iso(spark, sf):
    d = fixtures.mixed_layout_dates(spark, sf)
    return calendar.parse_datetime(d, iso_dates=True).select(*_FIELDS)


def q_valid_dates(spark, sf):
    p = calendar.parse_datetime(prepared(spark, sf))
    return calendar.valid_dates(p).select(*_FIELDS)


def q_calendar_flags(spark, sf):
    return calendar_table(spark, sf).select("trans_num", "hour", "is_night", "is_business_hours", "day_of_month")


def q_packed_clock(spark, sf):
    return calendar_table(spark, sf).select("trans_num", "trans_seconds")


def q_epoch_clock(spark, sf):
    return calendar_table(spark, sf).select("trans_num", "epoch_seconds")


# ----------------------------------------------------------- behaviour windows
def q_user_key(spark, sf):
    return behavior.add_user_key(typed(spark, sf)).select("trans_num", "user_id")


def q_user_totals(spark, sf):
    t = behavior.user_totals(keyed(spark, sf))
    return t.select("trans_num", "user_id", "user_transaction_count", _r("user_avg_amt"))


def _seq(spark, sf, clock):
    return behavior.sequence_features(keyed(spark, sf), spec=pipeline.CLOCKS[clock])


def q_prev_event(spark, sf):
    return _seq(spark, sf, "packed").select("trans_num", "user_id", "trans_seconds", "prev_clock")


def q_gap_features(spark, sf):
    s = _seq(spark, sf, "packed")
    return s.select("trans_num", _r("hours_since_last_trans"), "is_rapid_transaction")


def q_trailing_count_packed(spark, sf):
    return _seq(spark, sf, "packed").select("trans_num", "trans_count_last_24h")


def q_trailing_count_24h(spark, sf):
    return _seq(spark, sf, "epoch").select("trans_num", "trans_count_last_24h")


def q_gap_hours(spark, sf):
    s = _seq(spark, sf, "epoch")
    return s.select("trans_num", "epoch_seconds", "prev_clock", _r("hours_since_last_trans"), "is_rapid_transaction")


FEATURE_OUTPUT = [
    "trans_num",
    "user_id",
    "amt",
    "is_fraud",
    "hour",
    "minute",
    "is_night",
    "is_business_hours",
    "day_of_month",
    "trans_seconds",
    "epoch_seconds",
    "user_transaction_count",
    "user_avg_amt",
    "hours_since_last_trans",
    "is_rapid_transaction",
    "trans_count_last_24h",
]
_ROUNDED = ("user_avg_amt", "hours_since_last_trans")


def _feature_report(df: DataFrame) -> DataFrame:
    return df.select(*[_r(c) if c in _ROUNDED else F.col(c) for c in FEATURE_OUTPUT])


def q_features(spark, sf):
    return _feature_report(features(spark, sf))


def q_features_carried(spark, sf):
    """W1-W7 by states carried across range partitions; every clock of more than 4 rows is split."""
    return _feature_report(timeline.sequence_features(keyed(spark, sf), spec=behavior.EPOCH, hot_rows=4))


def q_prev_event_carried(spark, sf):
    s = timeline.sequence_features(keyed(spark, sf), spec=behavior.PACKED)
    return s.select("trans_num", "user_id", "trans_seconds", "prev_clock", "trans_count_last_24h")


def _state(spark, sf):
    """A state of three batches, by thirds of the time that the events span, and the batches' names."""
    rows = files.materialize(keyed(spark, sf), "keyed")
    ends = rows.agg(F.min("epoch_seconds").alias("lo"), F.max("epoch_seconds").alias("hi")).first()
    lo, step = ends["lo"] or 0, ((ends["hi"] or 0) - (ends["lo"] or 0)) // 3 + 1
    third = F.coalesce(F.expr(f"(epoch_seconds - {lo}) div {step}"), F.lit(2))  # rows without a time come last
    state = scratch_path(spark, "timeline-state")
    for k in range(3):
        timeline.append(rows.where(third == k), state, str(k))
    return state


def q_features_incremental(spark, sf):
    """W3-W5, W7 of each batch from the stored state of all batches."""
    state = _state(spark, sf)
    parts = [timeline.batch_features(spark, state, str(k), with_totals=False) for k in range(3)]
    out = parts[0].unionByName(parts[1]).unionByName(parts[2])
    return out.select("trans_num", "epoch_seconds", "prev_clock", _r("hours_since_last_trans"), "is_rapid_transaction", "trans_count_last_24h")


def q_totals_incremental(spark, sf):
    """W1, W2 of every user from the hourly sums of three batches."""
    t = timeline.totals(spark, _state(spark, sf))
    return t.select(F.col("_user").alias("user_id"), "user_transaction_count", _r("user_avg_amt"))


# ------------------------------------------------------------------ profiling
def q_valid_date_report(spark, sf):
    """A4: rows read and rows dropped for their date."""
    return calendar.date_validity_report(calendar.parse_datetime(prepared(spark, sf)))


SKETCH_PROBS = (0.05, 0.25, 0.5, 0.75, 0.95)


def q_median_sketch(spark, sf):
    """M4, A3 approximate: stored sketches of 16 parts, merged; whether each quantile's rank is
    within a hundredth of the rows."""
    t = typed(spark, sf).select("trans_num", F.col("amt").cast("double").alias("amt")).where("amt IS NOT NULL")
    t = files.materialize(t.withColumn("part", F.pmod(F.xxhash64("trans_num"), F.lit(16))), "sketched")
    stored = files.materialize(sketches.build(t, ["amt"], by=["part"]), "sketches")
    q = sketches.quantiles(stored, SKETCH_PROBS).where("column = 'amt'")
    values = q.select(F.struct(*[c for c in q.columns if c.startswith("q_")]).alias("q")).scalar()
    names = [c for c in q.columns if c.startswith("q_")]
    counts = t.agg(
        F.count(F.lit(1)).alias("n"),
        *[F.count_if(F.col("amt") < values.getField(c)).alias(f"below_{c}") for c in names],
        *[F.count_if(F.col("amt") <= values.getField(c)).alias(f"upto_{c}") for c in names],
    )
    rows = [
        F.struct(F.lit(p).alias("prob"), F.col("n"), ((F.col(f"below_{c}") <= (p + 0.01) * F.col("n")) & (F.col(f"upto_{c}") >= (p - 0.01) * F.col("n"))).alias("within"))
        for p, c in zip(SKETCH_PROBS, names)
    ]
    return counts.select(F.inline(F.array(*rows)))


def q_class_distribution(spark, sf):
    return profiling.class_distribution(features(spark, sf))


def q_amount_summary(spark, sf):
    return profiling.amount_summary(stored_features(spark, sf))


def q_correlation_matrix(spark, sf):
    return profiling.correlation_matrix(stored_features(spark, sf))


def q_label_correlation_top5(spark, sf):
    return profiling.label_correlation_top(stored_features(spark, sf), 5)


def q_stats_by_class(spark, sf):
    return profiling.stats_by_class(stored_features(spark, sf))


def q_rate_by_hour_top5(spark, sf):
    return profiling.rate_by_hour_top(features(spark, sf), 5)


def q_segment_rates(spark, sf):
    return profiling.segment_rates(stored_features(spark, sf))


def q_split_audit(spark, sf):
    return profiling.split_audit(sampling.split(features(spark, sf)))


# ------------------------------------------------------------------- sampling
def q_class_filter(spark, sf):
    return sampling.class_filter(calendar_table(spark, sf), 1).select("trans_num", "amt", "is_fraud")


#: Rows of the sampling key; below the row count of every input, so that it cuts.
SAMPLE_SIZE = 500


def q_sample_n(spark, sf):
    return sampling.smallest_n(stored_features(spark, sf), SAMPLE_SIZE).select("trans_num", "is_fraud", "amt")


def q_undersample(spark, sf):
    return sampling.undersample(stored_features(spark, sf)).select("trans_num", "is_fraud", "amt")


def q_balance_train(spark, sf):
    """Each balance method applied to the training part by name; rows of each class."""
    train, _ = sampling.train_test(stored_features(spark, sf))
    parts = [pipeline.balance(train, m).groupBy("is_fraud").agg(F.count(F.lit(1)).alias("n_rows")).withColumn("method", F.lit(m)) for m in ("undersample", "oversample", "none")]
    return parts[0].unionByName(parts[1]).unionByName(parts[2]).where("is_fraud IS NOT NULL").select("method", "is_fraud", "n_rows")


def q_oversample(spark, sf):
    return sampling.oversample(stored_features(spark, sf)).select("trans_num", "is_fraud", "amt")


# ------------------------------------------------------------ vectors, scaling
def q_feature_matrix(spark, sf):
    fm = modeling.feature_matrix(features(spark, sf))
    names = list(modeling.MODEL_FEATURES)
    out = modeling.vector_columns_as_fields(fm, "features", names, prefix="f_")
    return out.select("trans_num", *[_r(f"f_{n}") for n in names])


def q_skip_invalid(spark, sf):
    """The wanted columns that exist are assembled; rows with a NULL among them are left out."""
    t = calendar.calendar_features(typed(spark, sf))
    names = cleaning.present(t, ["amt", "absent", "hour", "is_fraud"])
    fm = modeling.assembler(names).transform(t)
    out = modeling.vector_columns_as_fields(fm, "features", names, prefix="f_")
    return out.select("trans_num", *[_r(f"f_{n}") for n in names])


def q_scaled_features(spark, sf):
    fm = modeling.feature_matrix(stored_features(spark, sf))
    train = sampling.split(fm).where(F.col("split") == "train")
    model = modeling.fit_scaler(train)
    names = list(modeling.MODEL_FEATURES)
    out = modeling.vector_columns_as_fields(model.transform(fm), "scaled_features", names, prefix="z_")
    return out.select("trans_num", *[_r(f"z_{n}") for n in names])


def q_pipeline_features(spark, sf):
    """R1 up to the balanced training table (what step 9 persists)."""
    feats = stored_features(spark, sf)
    train, _ = sampling.train_test(feats)
    bal = pipeline.balance(train, "undersample")
    fm = modeling.prepare_training(bal)
    cols = ["trans_num", "is_fraud", *modeling.MODEL_FEATURES]
    return fm.select(*[_r(c) if c in _ROUNDED else F.col(c) for c in cols])


# ---------------------------------------------------------------- classifiers
#: Where the models and the test part of an application and input were stored: paths only.
_STORED: dict[tuple[str, str], tuple[dict[str, str], str]] = {}


def trained(spark: SparkSession, sf: str) -> dict:
    """The three models and the test part.  They are trained and stored once for
    each application and input, and every key loads them."""
    key = (spark.sparkContext.applicationId, sf)
    if key not in _STORED:
        train, test = sampling.train_test(stored_features(spark, sf))
        bal = files.materialize(pipeline.balance(train, "undersample"), "balanced-train")
        models = modeling.train_all(bal)
        saved = {name: modeling.save_model(m, scratch_path(spark, "model"), name) for name, m in models.items()}
        path = scratch_path(spark, "test-part")
        test.write.parquet(path)
        _STORED[key] = (saved, path)
    saved, path = _STORED[key]
    return {"models": {name: modeling.load_model(p) for name, p in saved.items()}, "test": spark.read.parquet(path)}


def _scores(spark, sf, name):
    """Every test row once, whether its score is a proportion, and whether the
    prediction follows from it."""
    t = trained(spark, sf)
    s = modeling.score(t["models"][name], t["test"])
    return s.select(
        "trans_num",
        F.col("is_fraud").cast("int").alias("is_fraud"),
        F.col("score").between(0.0, 1.0).alias("in_range"),
        (F.col("prediction") == (F.col("score") > 0.5).cast("double")).alias("follows"),
    )


def q_lr_scores(spark, sf):
    return _scores(spark, sf, "Logistic Regression")


def q_rf_scores(spark, sf):
    return _scores(spark, sf, "Random Forest")


def q_gbt_scores(spark, sf):
    return _scores(spark, sf, "Gradient Boosting")


def _model_metrics(spark, sf) -> DataFrame:
    t = trained(spark, sf)
    preds = files.materialize(pipeline.score_models(t["models"], t["test"]), "model-scores")
    return evaluation.classification_metrics(preds)


def q_model_metrics(spark, sf):
    """The metrics file has a row for each model, which counts every labelled test row."""
    m = _model_metrics(spark, sf)
    path = scratch_path(spark, "metrics")
    files.save_metrics(m, path)  # K4
    back = files.read_table(spark, path, fmt="csv", header="true", inferSchema="true")
    return back.select(
        "model",
        (F.col("tn") + F.col("fp") + F.col("fn") + F.col("tp")).cast("bigint").alias("n_rows"),
        F.col("roc_auc").between(0.0, 1.0).alias("in_range"),
    )


def q_model_roundtrip(spark, sf):
    """K3: save the best model by F1, load it back; both give every test row the same score."""
    t = trained(spark, sf)
    m = _model_metrics(spark, sf)
    best = evaluation.best_model(m, order=list(modeling.MODEL_NAMES))
    name = best.where(F.col("metric") == "f1_score").select("model").first()[0]
    path = modeling.save_model(t["models"][name], scratch_path(spark, "models"), name)
    loaded = modeling.load_model(path)
    first = modeling.score(t["models"][name], t["test"]).select(*t["test"].columns, F.col("score").alias("_first"))
    again = modeling.score(loaded, first)
    return again.select("trans_num", (F.col("score") == F.col("_first")).alias("same"))


# ------------------------------------------------------------------ evaluation
_METRIC_COLS = ["accuracy", "precision", "recall", "f1_score", "f1_positive", "roc_auc"]


def stored_rule_scores(spark: SparkSession, sf: str) -> DataFrame:
    """Rule scores written once: the grouped counts and each model's AUC sort
    scan this table instead of re-parsing the raw text."""
    return files.materialize(txn_rule_scores(spark, sf), "rule-scores")


def _rule_metrics(spark, sf) -> DataFrame:
    return evaluation.classification_metrics(stored_rule_scores(spark, sf))


def q_classification_metrics(spark, sf):
    m = _rule_metrics(spark, sf)
    return m.select("model", *[_r(c) for c in _METRIC_COLS], "tn", "fp", "fn", "tp")


def q_confusion_matrix(spark, sf):
    return evaluation.confusion_matrix(txn_rule_scores(spark, sf))


def q_roc_auc(spark, sf):
    return evaluation.roc_auc(stored_rule_scores(spark, sf)).select("model", _r("roc_auc"))


def q_model_comparison(spark, sf):
    return evaluation.model_comparison(_rule_metrics(spark, sf))


def q_best_model(spark, sf):
    b = evaluation.best_model(_rule_metrics(spark, sf))
    return b.select("metric", "model", _r("value"))


QUERIES: dict[str, Query] = {
    "csv_roundtrip": q_csv_roundtrip,
    "csv_lines": q_csv_lines,
    "typed_contract": q_typed_contract,
    "impute_contract": q_impute_contract,
    "features_contract": q_features_contract,
    "run_pipeline": q_run_pipeline,
    "csv_rejects": q_csv_rejects,
    "months_rewritten": q_months_rewritten,
    "resumed_features": q_resumed_features,
    "drop_vectors": q_drop_vectors,
    "typed": q_typed,
    "clean_strings": q_clean_strings,
    "clean_merchant": q_clean_merchant,
    "null_profile": q_null_profile,
    "drop_essential": q_drop_essential,
    "impute_median": q_impute_median,
    "impute_unknown": q_impute_unknown,
    "impute_default": q_impute_default,
    "parsed_time": q_parsed_time,
    "parsed_time_iso": q_parsed_time_iso,
    "valid_dates": q_valid_dates,
    "calendar_flags": q_calendar_flags,
    "packed_clock": q_packed_clock,
    "epoch_clock": q_epoch_clock,
    "user_key": q_user_key,
    "user_totals": q_user_totals,
    "prev_event": q_prev_event,
    "gap_features": q_gap_features,
    "trailing_count_packed": q_trailing_count_packed,
    "trailing_count_24h": q_trailing_count_24h,
    "gap_hours": q_gap_hours,
    "features": q_features,
    "features_carried": q_features_carried,
    "prev_event_carried": q_prev_event_carried,
    "features_incremental": q_features_incremental,
    "totals_incremental": q_totals_incremental,
    "valid_date_report": q_valid_date_report,
    "median_sketch": q_median_sketch,
    "class_distribution": q_class_distribution,
    "amount_summary": q_amount_summary,
    "correlation_matrix": q_correlation_matrix,
    "label_correlation_top5": q_label_correlation_top5,
    "stats_by_class": q_stats_by_class,
    "rate_by_hour_top5": q_rate_by_hour_top5,
    "segment_rates": q_segment_rates,
    "split_audit": q_split_audit,
    "class_filter": q_class_filter,
    "sample_n": q_sample_n,
    "undersample": q_undersample,
    "oversample": q_oversample,
    "balance_train": q_balance_train,
    "feature_matrix": q_feature_matrix,
    "skip_invalid": q_skip_invalid,
    "scaled_features": q_scaled_features,
    "pipeline_features": q_pipeline_features,
    "lr_scores": q_lr_scores,
    "rf_scores": q_rf_scores,
    "gbt_scores": q_gbt_scores,
    "model_metrics": q_model_metrics,
    "model_roundtrip": q_model_roundtrip,
    "classification_metrics": q_classification_metrics,
    "confusion_matrix": q_confusion_matrix,
    "roc_auc": q_roc_auc,
    "model_comparison": q_model_comparison,
    "best_model": q_best_model,
}
