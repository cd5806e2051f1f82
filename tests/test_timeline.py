"""Carried features equal plain windows; increments equal one batch."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from riskloom.operators import behavior, timeline
from riskloom.plans import catalog
from riskloom.session import scratch_path
from riskloom.sources import files

from conftest import SF_SMALL, rows
from test_behavior import SPECS, _plain_windows

COLS = ["user_transaction_count", "prev_clock", "trans_count_last_24h"]


def _norm(df, *more):
    cols = [*COLS, *more]
    return sorted(((r[0], *r[1:4], *[round(x, 6) for x in r[4:]]) for r in rows(df, "trans_num", *cols)), key=str)


def _data(spark, spec):
    keyed = catalog.keyed(spark, SF_SMALL)
    extra = keyed.where(F.col("trans_num").endswith("3")).withColumns(
        {
            "trans_num": F.concat(F.col("trans_num"), F.lit("x")),
            spec.column: F.when(F.col("hour") % 2 == 0, F.lit(None).cast("long")).otherwise(F.col(spec.column)),
        }
    )
    return keyed.unionByName(extra)


@pytest.mark.parametrize("spec", SPECS[:2], ids=["packed", "epoch"])
def test_carried_features_equal_plain_windows(spark, spec):
    data = _data(spark, spec)
    got = timeline.sequence_features(data, spec=spec, hot_rows=2)
    assert got.columns[: len(data.columns)] == data.columns
    assert _norm(got, "user_avg_amt", "hours_since_last_trans") == _norm(_plain_windows(data, spec), "user_avg_amt", "hours_since_last_trans")
    bucketed = behavior.sequence_features(data, spec=spec)
    assert sorted(rows(got, "trans_num", "is_rapid_transaction")) == sorted(rows(bucketed, "trans_num", "is_rapid_transaction"))


def test_a_hot_minute_spreads_over_all_tasks(spark, monkeypatch):
    # half of all rows in one minute of one user, whole rows repeated among them
    hot = spark.range(6000).select(F.concat(F.lit("h"), (F.col("id") % 5900).cast("string")).alias("trans_num"), F.lit("u0").alias("user_id"), (F.col("id") % 60 + 1_000_000).alias("epoch_seconds"))
    rest = spark.range(6000).select(
        F.concat(F.lit("r"), F.col("id").cast("string")).alias("trans_num"),
        F.when(F.col("id") % 10 == 0, F.lit(None)).otherwise(F.concat(F.lit("u"), (F.col("id") % 50).cast("string"))).alias("user_id"),
        (F.col("id") * 97 % 400_000 + 800_000).alias("epoch_seconds"),
    )
    data = files.materialize(hot.unionByName(rest).withColumn("amt", F.lit(2.0)), "hot-minute")
    want = _norm(_plain_windows(data, behavior.EPOCH))
    settings = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}  # nothing but the operator spreads rows
    stored, keep = {}, files.materialize
    monkeypatch.setattr(timeline, "materialize", lambda d, name: stored.setdefault(name, keep(d, name)))
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        got = timeline.sequence_features(data, spec=behavior.EPOCH, hot_rows=50)
        assert _norm(got) == want
        here = got.where("user_id = 'u0' AND epoch_seconds BETWEEN 1000000 AND 1000059").groupBy(F.spark_partition_id()).count()
        parts = [n for (_, n) in rows(here)]
    finally:
        for k in settings:
            spark.conf.unset(k)
    assert len(parts) == 4 and max(parts) < 0.4 * sum(parts)  # all four tasks of the session
    # half of all rows are no more than sixty rows of the timeline
    assert stored["timeline-ranges"].where("_user = 'u0' AND _kind = 1 AND _clock BETWEEN 1000000 AND 1000059").count() == 60


def test_a_user_is_several_ranges(spark, monkeypatch):
    data = files.materialize(spark.range(8000).selectExpr("cast(id as string) trans_num", "'u' user_id", "id * 37 % 900000 epoch_seconds", "1.0D amt"), "one-user")
    stored, keep = {}, files.materialize
    monkeypatch.setattr(timeline, "materialize", lambda d, name: stored.setdefault(name, keep(d, name)))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = timeline.sequence_features(data, spec=behavior.EPOCH)
        assert _norm(got) == _norm(_plain_windows(data, behavior.EPOCH))
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    sizes = [n for (_, n) in rows(stored["timeline-ranges"].groupBy("_part").count())]
    assert len(sizes) == 4 and max(sizes) < 0.4 * sum(sizes)


def test_three_increments_equal_one_batch(spark):
    spec = behavior.EPOCH
    data = files.materialize(_data(spark, spec), "increments")
    cuts = data.approxQuantile("epoch_seconds", [0.3, 0.6], 0.0)
    at = F.col("epoch_seconds")
    batches = {"a": at < cuts[0], "b": (at >= cuts[0]) & (at < cuts[1]), "c": (at >= cuts[1]) | at.isNull()}
    state, outs = scratch_path(spark, "state"), []
    for name, cond in batches.items():
        timeline.append(data.where(cond), state, name, spec)
        if name == "b":  # a retry replaces itself
            timeline.append(data.where(cond), state, name, spec)
        outs.append(timeline.batch_features(spark, state, name, spec))
    whole = timeline.sequence_features(data, spec=spec)
    seq = lambda df: sorted(rows(df, "trans_num", "prev_clock", "trans_count_last_24h", "is_rapid_transaction"), key=str)
    assert seq(outs[0].unionByName(outs[1]).unionByName(outs[2])) == seq(whole)
    # totals are those of all batches
    want = {(r[0]): (r[1], round(r[2], 6)) for r in rows(whole, "user_id", "user_transaction_count", "user_avg_amt")}
    got = {r._user: (r.user_transaction_count, round(r.user_avg_amt, 6)) for r in timeline.totals(spark, state).collect()}
    assert got == want
    last = sorted(rows(outs[2], "trans_num", "user_transaction_count"))
    assert last == sorted(rows(whole.where(batches["c"]), "trans_num", "user_transaction_count"))


def test_timelines_merge_in_any_order(spark):
    df = spark.createDataFrame([("a", "u", 1, 1.0), ("b", "u", 1, 2.0), ("c", None, None, None), ("a", "u", 2, 4.0)], "trans_num string, user_id string, epoch_seconds long, amt double")
    made = [timeline.timeline(timeline._rows(df.where(c), behavior.EPOCH, "user_id", n), "trans_num", "amt") for n, c in (("x", "trans_num <> 'a'"), ("y", "trans_num = 'a'"))]
    pick = lambda d: sorted(rows(d, "_user", "_keyless", "_clock", "_n", "_sum", "_n_amt", "_first.tie"), key=str)
    one = pick(timeline.merged(made[0].unionByName(made[1])))
    assert one == pick(timeline.merged(made[1].unionByName(made[0])))
    assert one == [("", True, None, 1, None, 0, "c"), ("u", False, 1, 2, 3.0, 2, "a"), ("u", False, 2, 1, 4.0, 1, "a")]


def test_empty_table(spark):
    df = spark.createDataFrame([], "trans_num string, user_id string, epoch_seconds long, amt double")
    assert timeline.sequence_features(df).count() == 0
    state = scratch_path(spark, "empty-state")
    timeline.append(df, state, "a")
    assert timeline.batch_features(spark, state, "a").count() == 0 and timeline.totals(spark, state).count() == 0
