"""Stored quantile sketches: rank error, merges, missing values."""

from __future__ import annotations

import random
from bisect import bisect_left, bisect_right

from pyspark.sql import functions as F

from riskloom.operators import sketches
from riskloom.sources import files

from conftest import rows

PROBS = [0.01, 0.25, 0.5, 0.75, 0.99]


def test_merged_sketches_are_within_a_hundredth_of_the_rank(spark):
    rnd = random.Random(8)
    data = [(k % 7, rnd.expovariate(0.01) if k % 3 else float(k % 10), None if k % 5 else float("nan")) for k in range(30_000)]
    df = spark.createDataFrame(data, "day int, amt double, nothing double").repartition(6)
    daily = files.materialize(sketches.build(df, ["amt", "nothing"], by=["day"]), "sketches")
    assert {r["column"]: r.n for r in sketches.merge(daily).collect()} == {"amt": 30_000, "nothing": 0}
    x = sorted(r[1] for r in data)
    for order in ("day", F.col("day").desc()):
        got = sketches.quantiles(daily.orderBy(order).coalesce(1), PROBS)
        row = got.where("column = 'amt'").first()
        for p, name in zip(PROBS, ("q_0_01", "q_0_25", "q_0_5", "q_0_75", "q_0_99")):
            ranks = bisect_left(x, row[name]) / len(x), bisect_right(x, row[name]) / len(x)
            assert ranks[0] - 0.01 <= p <= ranks[1] + 0.01, (p, row[name])
        assert got.where("column = 'nothing'").first().q_0_5 is None


def test_a_batch_adds_its_own_sketch(spark):
    first = sketches.build(spark.range(1000).selectExpr("cast(id as double) v", "'a' batch"), ["v"], by=["batch"])
    second = sketches.build(spark.range(1000, 3000).selectExpr("cast(id as double) v", "'b' batch"), ["v"], by=["batch"])
    both = sketches.median_row(first.unionByName(second), ["v"]).first().v
    assert abs(both - 1500) <= 30


def test_a_sketch_for_each_file(spark):
    df = files.materialize(spark.range(4000).selectExpr("cast(id as double) v").repartition(3), "three-files")
    got = sketches.build_by_file(df, ["v"])
    assert sorted(set(f for (f,) in rows(got, "file"))) == sorted(df.inputFiles()) or got.select("file").distinct().count() == 3
    assert sum(r.n for r in got.collect()) == 4000
