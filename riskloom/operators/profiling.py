"""Descriptive reports (A1-A13) as Spark aggregates over the full table.

Each report is a small DataFrame (one row per class / hour / segment / pair);
nothing but the report leaves the cluster.  Rates are percentages (X4); report
values are rounded half-to-even like the reference's pandas ``round``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskloom.operators.quantiles import exact_median_row, exact_quantiles

LABEL = "is_fraud"
# Fixed values (reference behaviour): the columns of the correlation analysis, in order.
CORRELATION_FEATURES = (
    "amt",
    "hour",
    "minute",
    "is_night",
    "is_business_hours",
    "user_transaction_count",
    "user_avg_amt",
    "hours_since_last_trans",
    "is_rapid_transaction",
    "trans_count_last_24h",
    "is_fraud",
)


def _labelled(df: DataFrame, label: str) -> DataFrame:
    return df.where(F.col(label).isNotNull())


def class_distribution(df: DataFrame, label: str = LABEL) -> DataFrame:
    """A1 + A2: rows per label (NULL labels excluded) and the share in percent.

    The total is a window over the (at most a few rows) aggregate."""
    counts = _labelled(df, label).groupBy(label).agg(F.count(F.lit(1)).cast("bigint").alias("n_rows"))
    total = F.sum("n_rows").over(Window.partitionBy())
    return counts.select(
        F.col(label),
        F.col("n_rows"),
        F.bround(F.col("n_rows") * 100.0 / total, 4).alias("pct"),
    )


def amount_summary(df: DataFrame, column: str = "amt", label: str = LABEL, exact: bool = True) -> DataFrame:
    """A3: count, mean, stddev, min, quartiles, max of the amount in one aggregate.

    Exact quartiles come from bounded histogram passes (a scalar subquery);
    ``exact=False`` takes them from the quantile sketch instead.  NaN counts as missing
    in every figure."""
    x = F.col(column).cast("double")
    data = _labelled(df, label)
    data = data.withColumn(column, F.when(~F.isnan(x), F.col(column)))
    if exact:
        qs = exact_quantiles(data, [column], [0.25, 0.5, 0.75])
        q = qs.select(F.array("q_0_25", "q_0_5", "q_0_75")).scalar()
    else:
        q = F.percentile_approx(x, [0.25, 0.5, 0.75], 10000)
    agg = data.agg(
        F.count(x).cast("bigint").alias("n"),
        F.avg(x).alias("mean"),
        F.stddev_samp(x).alias("stddev"),
        F.min(x).alias("min"),
        q.alias("_q"),
        F.max(x).alias("max"),
    )
    return agg.select(
        "n",
        F.round("mean", 6).alias("mean"),
        F.round("stddev", 6).alias("stddev"),
        "min",
        F.round(F.col("_q")[0], 6).alias("p25"),
        F.round(F.col("_q")[1], 6).alias("p50"),
        F.round(F.col("_q")[2], 6).alias("p75"),
        "max",
    )


def _complete(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    cond = None
    for c in cols:
        term = F.col(c).isNotNull() & ~F.isnan(F.col(c).cast("double"))
        cond = term if cond is None else cond & term
    return df.where(cond)


def _centred_moments(data: DataFrame, cols: Sequence[str], pairs: Sequence[tuple[str, str]]) -> DataFrame:
    """One row: for every pair (a, b), sum((a - mean_a) * (b - mean_b)).

    Two passes over ``data``: the means (one scalar subquery), then plain sums
    of centred products -- numerically stable like a two-pass variance, and a
    handful of double sums per pair, so the aggregate stays inside whole-stage
    codegen (the covar/stddev buffers of dozens of pairs exceed its field limit)."""
    means = data.agg(*[F.avg(c).alias(c) for c in cols]).select(F.struct(*cols).alias("m")).scalar()
    # centre once per row (one subquery reference per column), then plain sums
    centred = data.select(*[(F.col(c) - means.getField(c)).alias(c) for c in cols])
    return centred.agg(*[F.sum(F.col(a) * F.col(b)).alias(f"s|{a}|{b}") for a, b in pairs])


def _corr_from(a: str, b: str) -> Column:
    sab, saa, sbb = (F.col(f"`s|{x}|{y}`") for x, y in ((a, b), (a, a), (b, b)))
    return F.try_divide(sab, F.sqrt(saa * sbb))


def correlation_matrix(
    df: DataFrame, columns: Sequence[str] = CORRELATION_FEATURES, digits: int = 3
) -> DataFrame:
    """A5: Pearson matrix of the present numeric features and the label as
    ``(feature_a, feature_b, corr)``, rows with any NULL removed.

    All k(k+1)/2 centred cross-products come from ONE aggregate (after a
    means pass) and are unpivoted; constant columns give NULL (ANSI-safe)."""
    cols = [c for c in columns if c in df.columns]
    data = _complete(df, cols).select(*[F.col(c).cast("double").alias(c) for c in cols])
    pairs = [(a, b) for i, a in enumerate(cols) for b in cols[i:]]
    moments = _centred_moments(data, cols, pairs)
    entries = []
    for a, b in pairs:
        r = _corr_from(a, b).cast("double")
        entries.append(F.struct(F.lit(a).alias("feature_a"), F.lit(b).alias("feature_b"), r.alias("corr")))
        if a != b:
            entries.append(F.struct(F.lit(b).alias("feature_a"), F.lit(a).alias("feature_b"), r.alias("corr")))
    long = moments.select(F.inline(F.array(*entries)))
    return long.select("feature_a", "feature_b", F.bround("corr", digits).alias("corr"))


def label_correlations(df: DataFrame, columns: Sequence[str] = CORRELATION_FEATURES, label: str = LABEL) -> DataFrame:
    """Correlation of every present feature with the label, long form, undefined dropped."""
    feats = [c for c in columns if c in df.columns and c != label]
    cols = feats + [label]
    data = _complete(df, cols).select(*[F.col(c).cast("double").alias(c) for c in cols])
    pairs = [(c, label) for c in feats] + [(c, c) for c in cols]
    moments = _centred_moments(data, cols, pairs)
    wide = moments.select(*[_corr_from(c, label).alias(c) for c in feats])
    long = wide.unpivot([], feats, "feature", "corr")
    return long.where(F.col("corr").isNotNull() & ~F.isnan("corr"))


def label_correlation_top(df: DataFrame, k: int = 5, columns: Sequence[str] = CORRELATION_FEATURES) -> DataFrame:
    """The k features most correlated with the label by |r| (signed r shown).

    Top-k over at most a dozen rows; ties broken by feature name."""
    ranked = label_correlations(df, columns).withColumn(
        "rank", F.row_number().over(Window.orderBy(F.abs("corr").desc(), F.col("feature")))
    )
    return ranked.where(F.col("rank") <= k).select(
        F.col("rank").cast("int").alias("rank"), "feature", F.bround("corr", 3).alias("corr")
    )


def stats_by_class(df: DataFrame, label: str = LABEL) -> DataFrame:
    """Per class -- amount mean/median/std/count; mean/median of user
    average, user count and 24 h count (those present), 2 decimals.

    Moments are one grouped aggregate; the medians of all columns come from
    one bounded exact-quantile pass grouped by class, pivoted and joined on
    the class (one row per class on both sides)."""
    data = _labelled(df, label)
    cols = [c for c in ("amt", "user_avg_amt", "user_transaction_count", "trans_count_last_24h") if c in df.columns]
    aggs = []
    if "amt" in cols:
        x = F.col("amt").cast("double")
        aggs += [
            F.bround(F.avg(x), 2).alias("amt_mean"),
            F.bround(F.stddev_samp(x), 2).alias("amt_std"),
            F.count(x).cast("bigint").alias("amt_count"),
        ]
    for c in cols:
        if c != "amt":
            aggs.append(F.bround(F.avg(F.col(c).cast("double")), 2).alias(f"{c}_mean"))
    moments = data.groupBy(label).agg(*aggs)
    if not cols:
        return moments
    # the label has two values: the per-class tables are bounded
    med = exact_quantiles(data, cols, [0.5], by=[label])
    medians = med.groupBy(label).pivot("column", cols).agg(F.first("q_0_5"))
    medians = medians.select(label, *[F.bround(F.col(c), 2).alias(f"{c}_median") for c in cols])
    return moments.join(medians, on=label, how="left")


def rate_by_hour_top(df: DataFrame, k: int = 5, label: str = LABEL) -> DataFrame:
    """A8 + B8: the k hours with the highest positive rate (ties: earlier hour).

    At most 24 groups; the top-k is a report limit, not a row cap."""
    by_hour = (
        _labelled(df, label)
        .where(F.col("hour").isNotNull())
        .groupBy("hour")
        .agg(F.count(F.lit(1)).cast("bigint").alias("n_rows"), F.avg(F.col(label).cast("double")).alias("_rate"))
    )
    ranked = by_hour.withColumn("rank", F.row_number().over(Window.orderBy(F.col("_rate").desc(), F.col("hour"))))
    return ranked.where(F.col("rank") <= k).select(
        F.col("rank").cast("int").alias("rank"),
        "hour",
        "n_rows",
        F.bround(F.col("_rate") * 100.0, 4).alias("fraud_pct"),
    )


def segment_rates(df: DataFrame, label: str = LABEL) -> DataFrame:
    """Positive rate night/day, amount above/at-or-below its median,
    user frequency above/at-or-below its median, rapid/normal.

    The two medians are scalar subqueries (one aggregate); all segment counts
    come from ONE further aggregate, unpivoted to ``(segment, bucket, n_rows, fraud_pct)``."""
    data = _labelled(df, label)
    y = F.col(label).cast("double")
    segs: list[tuple[str, str, Column]] = []
    if "is_night" in data.columns:
        segs += [("time_of_day", "night", F.col("is_night") == 1), ("time_of_day", "day", F.col("is_night") == 0)]
    medians = {}
    for seg, c in (("amount", "amt"), ("frequency", "user_transaction_count")):
        if c in data.columns:
            medians[c] = seg
    if medians:
        med_row = exact_median_row(data, list(medians))
        med = med_row.select(F.struct(*[F.col(c) for c in medians]).alias("m")).scalar()
        for c, seg in medians.items():
            x = F.col(c).cast("double")
            segs += [(seg, "high", x > med.getField(c)), (seg, "low", x <= med.getField(c))]
    if "is_rapid_transaction" in data.columns:
        segs += [
            ("speed", "rapid", F.col("is_rapid_transaction") == 1),
            ("speed", "normal", F.col("is_rapid_transaction") == 0),
        ]
    aggs = []
    for i, (_, _, cond) in enumerate(segs):
        aggs += [F.count_if(cond).cast("bigint").alias(f"n{i}"), F.avg(F.when(cond, y)).alias(f"r{i}")]
    wide = data.agg(*aggs)
    rows = F.array(
        *[
            F.struct(
                F.lit(seg).alias("segment"),
                F.lit(b).alias("bucket"),
                F.col(f"n{i}").alias("n_rows"),
                F.bround(F.col(f"r{i}") * 100.0, 4).alias("fraud_pct"),
            )
            for i, (seg, b, _) in enumerate(segs)
        ]
    )
    return wide.select(F.inline(rows))


def split_audit(df: DataFrame, split_col: str = "split", label: str = LABEL) -> DataFrame:
    """Rows, positives and positive percentage per split part (NULL rate
    for an empty part instead of a division error)."""
    return df.groupBy(split_col).agg(
        F.count(F.lit(1)).cast("bigint").alias("n_rows"),
        F.count_if(F.col(label) == 1).cast("bigint").alias("n_positive"),
        F.bround(F.try_divide(F.count_if(F.col(label) == 1) * 100.0, F.count(F.lit(1))), 4).alias("positive_pct"),
    )
