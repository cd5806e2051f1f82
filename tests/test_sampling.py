"""Exact, layout-independent balancing, sampling and split."""

from __future__ import annotations

import hashlib
from collections import Counter

from pyspark.sql import functions as F

from riskloom.operators import sampling

from conftest import SF_SMALL, rows


def _h(key: str) -> int:
    return int(hashlib.md5(key.encode()).hexdigest()[:8], 16)


def _labelled(spark, n_pos, n_neg, extra_null=1):
    data = [(f"p{i}", 1) for i in range(n_pos)] + [(f"n{i}", 0) for i in range(n_neg)]
    data += [(f"z{i}", None) for i in range(extra_null)]
    return spark.createDataFrame(data, "trans_num string, is_fraud int")


def test_hash_matches_md5_prefix(spark):
    df = spark.createDataFrame([("123",), ("abc",)], "trans_num string")
    got = rows(sampling.with_hash(df), "trans_num", "_h")
    assert got == [("123", _h("123")), ("abc", _h("abc"))]


def test_undersample_three_positives(spark):
    df = _labelled(spark, 3, 10)
    out = rows(sampling.undersample(df))
    c = Counter(r[1] for r in out)
    assert c == {1: 3, 0: 3}
    # the kept negatives are the three smallest by (hash, key)
    negs = sorted((f"n{i}" for i in range(10)), key=lambda k: (_h(k), k))[:3]
    assert sorted(r[0] for r in out if r[1] == 0) == sorted(negs)


def test_oversample_copies(spark):
    df = _labelled(spark, 3, 10)
    out = rows(sampling.oversample(df))
    c = Counter(r[1] for r in out)
    assert c == {1: 10, 0: 10}
    copies = sorted(Counter(r[0] for r in out if r[1] == 1).values(), reverse=True)
    assert copies == [4, 3, 3]  # q=3, r=1
    first = min((f"p{i}" for i in range(3)), key=lambda k: (_h(k), k))
    assert Counter(r[0] for r in out)[first] == 4


def test_no_positives_returns_the_other_class(spark):
    df = _labelled(spark, 0, 5)
    assert sampling.undersample(df).count() == 5
    assert sampling.oversample(df).count() == 5


def test_rows_without_or_with_repeated_keys_are_kept(spark):
    data = [(None if i < 20 else f"k{i % 30}", i) for i in range(100)]
    df = spark.createDataFrame(data, "trans_num string, amt int")
    for n in (10, 50, 99, 100, 200):
        assert sampling.smallest_n(df, n).count() == min(n, 100)
    same_row = spark.createDataFrame([("a", 1)] * 40, "trans_num string, amt int")
    assert sampling.smallest_n(same_row, 7).count() == 7
    pos = [(None, 1)] * 25 + [("x", 0)] * 75
    labelled = spark.createDataFrame(pos, "trans_num string, is_fraud int")
    assert Counter(r[1] for r in rows(sampling.undersample(labelled))) == {1: 25, 0: 25}
    uneven = spark.createDataFrame([(None, 1)] * 25 + [("x", 0)] * 73, "trans_num string, is_fraud int")
    assert Counter(r[1] for r in rows(sampling.oversample(uneven))) == {1: 73, 0: 73}
    assert sampling.split(df).count() == 100


def test_seeds_draw_other_rows(spark):
    df = spark.range(300).select(F.col("id").cast("string").alias("trans_num"), (F.col("id") % 5 == 0).cast("int").alias("is_fraud"))
    draw = lambda s: {r[0] for r in rows(sampling.undersample(df, seed=s), "trans_num")}
    assert draw(1) == draw(1) != draw(2)
    side = lambda s: dict(rows(sampling.split(df, seed=s), "trans_num", "split"))
    assert side(1) == side(1) != side(2)


def test_minority_is_the_smaller_class(spark):
    df = _labelled(spark, 7, 2)
    assert Counter(r[1] for r in rows(sampling.undersample(df))) == {1: 2, 0: 2}
    assert Counter(r[1] for r in rows(sampling.oversample(df))) == {1: 7, 0: 7}


def test_smallest_n_matches_sort_and_ignores_layout(spark):
    df = spark.read.parquet(f"{SF_SMALL}/events.parquet").select(
        F.col("event_id").cast("string").alias("trans_num")
    )
    keys = [r[0] for r in rows(df)]
    want = sorted(sorted(keys, key=lambda k: (_h(k), k))[:137])
    for layout in (df, df.repartition(7), df.coalesce(1)):
        got = sorted(r[0] for r in rows(sampling.smallest_n(layout, 137)))
        assert got == want
    assert sampling.smallest_n(df, 10**6).count() == len(keys)


def test_split_is_complete_disjoint_and_stable(spark):
    df = spark.read.parquet(f"{SF_SMALL}/events.parquet").select(
        F.col("event_id").cast("string").alias("trans_num")
    )
    a = dict(rows(sampling.split(df)))
    b = dict(rows(sampling.split(df.repartition(5))))
    assert a == b and len(a) == df.count()
    share = sum(v == "train" for v in a.values()) / len(a)
    assert 0.6 < share < 0.8
    train, test = sampling.train_test(df)
    assert train.count() + test.count() == df.count()
    assert train.join(test, "trans_num").count() == 0


def test_oversample_at_a_ratio_of_a_million(spark):
    n = 1_000_000
    df = spark.range(n + 1).select(F.col("id").cast("string").alias("trans_num"), (F.col("id") == 7).cast("int").alias("is_fraud"))
    out = sampling.oversample(df)
    positives = out.where("is_fraud = 1").groupBy(F.spark_partition_id().alias("p")).agg(F.count(F.lit(1)).alias("n"), F.min("trans_num").alias("k"))
    got = positives.collect()
    assert sum(r.n for r in got) == n and {r.k for r in got} == {"7"}
    assert len(got) >= 4 and max(r.n for r in got) < n / 2  # the copies of one row are spread
    assert out.where("is_fraud = 0").count() == n


def test_repeat_rows_in_levels(spark):
    df = spark.createDataFrame([("a", 0), ("b", 1), ("c", 2), ("d", 16), ("e", 17), ("f", 124), ("g", 125), ("g", 125), ("h", None)], "k string, n int")
    out = sampling.repeat_rows(df, F.col("n"), 125, fan=5)
    assert out.columns == ["k", "n"]
    # every array has at most `fan` elements: one generator for each level
    assert out._jdf.queryExecution().executedPlan().toString().count("Generate explode(sequence") == 3
    assert Counter(r[0] for r in rows(out)) == {"b": 1, "c": 2, "d": 16, "e": 17, "f": 124, "g": 250}


def test_copies_of_one_row_are_no_window(spark):
    df = spark.range(30_000).select(F.lit("same").alias("trans_num"), F.lit(1.5).alias("amt"))
    mixed = df.unionByName(spark.createDataFrame([(f"k{i}", 2.0) for i in range(50)], "trans_num string, amt double"))
    flagged = sampling.flag_smallest(sampling.with_hash(mixed), 20_000)
    assert flagged.columns == ["trans_num", "amt", "_h", "_sel"]
    by = Counter((r.trans_num == "same", r._sel) for r in flagged.collect())
    assert sum(n for (_, taken), n in by.items() if taken) == 20_000 and sum(by.values()) == 30_050
    assert by[True, True] + by[True, False] == 30_000
    parts = flagged.where("trans_num = 'same'").groupBy(F.spark_partition_id()).count().collect()
    assert len(parts) > 1
