"""Hand-made clocks (FIXTURES section 3) and a brute-force cross-check of
the bucketed plan against plain per-user windows."""

from __future__ import annotations

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskloom.operators import behavior, calendar
from riskloom.plans import catalog

from conftest import SF_SMALL, rows

STAMPS = ["1/1/2019 00:00", "1/1/2019 23:59", "1/2/2019 00:00", "1/31/2019 23:00", "2/1/2019 00:00"]


def _one_user(spark, stamps=STAMPS):
    schema = T.StructType(
        [
            T.StructField("trans_num", T.StringType()),
            T.StructField("trans_date_trans_time", T.StringType()),
            T.StructField("amt", T.FloatType()),
            T.StructField("user_id", T.StringType()),
        ]
    )
    data = [(f"t{i}", s, float(i + 1), "u1") for i, s in enumerate(stamps)]
    return calendar.calendar_features(spark.createDataFrame(data, schema))


def _by_num(df, *cols):
    return [r[1:] for r in sorted(rows(df, "trans_num", *cols))]


def test_packed_clock_semantics(spark):
    out = behavior.sequence_features(_one_user(spark), spec=behavior.PACKED)
    got = _by_num(out, "hours_since_last_trans", "trans_count_last_24h", "is_rapid_transaction")
    assert [g[0] for g in got] == pytest.approx([-1.0, 0.2359, 0.7641, 29.23, 69.77])
    assert [g[1] for g in got] == [1, 2, 3, 1, 1]  # 31 January never counts on 1 February
    assert [g[2] for g in got] == [0, 1, 1, 0, 0]


def test_bucket_must_divide_frame():
    with pytest.raises(ValueError):
        behavior.ClockSpec("epoch_seconds", 86400, 3600.0, 7000)


def test_real_time_semantics(spark):
    out = behavior.sequence_features(_one_user(spark), spec=behavior.EPOCH)
    got = _by_num(out, "hours_since_last_trans", "trans_count_last_24h", "user_transaction_count", "user_avg_amt")
    assert [g[0] for g in got] == pytest.approx([-1.0, 23 + 59 / 60, 1 / 60, 719.0, 1.0])
    assert [g[1] for g in got] == [1, 2, 3, 1, 2]
    assert all(g[2] == 5 for g in got)
    assert all(g[3] == pytest.approx(3.0) for g in got)


def test_user_key_skips_null_parts(spark):
    schema = T.StructType([T.StructField(c, T.StringType()) for c in ("city", "job", "dob")])
    df = spark.createDataFrame([("a", None, "c"), (None, None, None)], schema)
    assert [r[0] for r in rows(behavior.add_user_key(df), "user_id")] == ["a_c", ""]


def _plain_windows(df, spec):
    """Single per-user windows: the textbook form (one task per user)."""
    clock = spec.column
    by_user = Window.partitionBy("user_id")
    ordered = by_user.orderBy(F.col(clock).asc_nulls_first(), F.col("trans_num"))
    trailing = Window.partitionBy("user_id").orderBy(F.col(clock).asc_nulls_first()).rangeBetween(-spec.frame, 0)
    out = df.withColumns(
        {
            "user_transaction_count": F.count(F.lit(1)).over(by_user),
            "user_avg_amt": F.avg(F.col("amt").cast("double")).over(by_user),
            "prev_clock": F.lag(clock).over(ordered),
            "trans_count_last_24h": F.count(F.lit(1)).over(trailing),
        }
    )
    gap = F.when(F.col("prev_clock").isNotNull(), (F.col(clock) - F.col("prev_clock")) / F.lit(spec.unit))
    return out.withColumn("hours_since_last_trans", gap.otherwise(F.lit(-1.0)))


SPECS = [
    behavior.PACKED,
    behavior.EPOCH,
    behavior.ClockSpec("epoch_seconds", 86400, 3600.0, 60),  # k = 1440 minute buckets
    behavior.ClockSpec("trans_seconds", 10000, 10000.0, 1),  # k = 10000
    behavior.ClockSpec("epoch_seconds", 86400, 3600.0, 86400),  # k = 1
]


@pytest.mark.parametrize("spec", SPECS, ids=["packed", "epoch", "epoch-minute", "packed-unit", "epoch-day"])
def test_bucketed_plan_equals_plain_windows(spark, spec):
    keyed = catalog.keyed(spark, SF_SMALL)
    # add rows with a NULL clock (no time part) and exact clock ties
    extra = keyed.where(F.col("trans_num").endswith("3")).withColumns(
        {
            "trans_num": F.concat(F.col("trans_num"), F.lit("x")),
            spec.column: F.when(F.col("hour") % 2 == 0, F.lit(None).cast("long")).otherwise(F.col(spec.column)),
        }
    )
    data = keyed.unionByName(extra)
    cols = ["user_transaction_count", "prev_clock", "trans_count_last_24h"]
    got = behavior.sequence_features(data, spec=spec)
    want = _plain_windows(data, spec)

    def norm(df):
        return sorted(
            (r[0], *r[1:4], round(r[4], 6), round(r[5], 6))
            for r in rows(df, "trans_num", *cols, "user_avg_amt", "hours_since_last_trans")
        )

    assert norm(got) == norm(want)


def test_wide_rows_shuffle_once_by_user_and_bucket(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        feats = catalog.features(spark, SF_SMALL)
        plan = feats._jdf.queryExecution().executedPlan().toString().splitlines()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    gen_at = [i for i, ln in enumerate(plan) if "Generate explode" in ln]
    assert len(gen_at) == 1, "own rows and context copies come from one generator pass"
    above = [ln for ln in plan[: gen_at[0]] if "Exchange" in ln]
    # the exchange right above the generator is the only one the wide rows take
    assert "hashpartitioning(_user" in above[-1] and "_bucket" in above[-1]
    # the join back does not shuffle the window output again
    join_at = [i for i, ln in enumerate(plan) if "SortMergeJoin" in ln]
    assert join_at and not any("Exchange" in ln for ln in plan[join_at[0] + 1 : join_at[0] + 4])


def test_rows_without_clock_and_key_are_spread(spark):
    df = spark.range(2000).selectExpr("CAST(NULL AS STRING) trans_num", "'u' user_id", "CAST(NULL AS BIGINT) epoch_seconds", "CAST(id AS DOUBLE) amt")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        out = behavior.sequence_features(df, spec=behavior.EPOCH)
        sizes = [n for (_, n) in rows(out.groupBy(F.spark_partition_id()).count())]
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
    assert sum(sizes) == 2000 and len(sizes) > 1 and max(sizes) < 1200
    assert {(r.trans_count_last_24h, r.prev_clock, r.user_transaction_count) for r in out.collect()} == {(2000, None, 2000)}
