"""Bounded exact quantiles equal Spark's exact ``percentile``."""

from __future__ import annotations

import math
import random
import struct

import pytest
from pyspark.sql import functions as F

from riskloom.functions.stats import ordered_bits
from riskloom.operators import quantiles
from riskloom.operators.quantiles import exact_median_row, exact_quantiles
from riskloom.sources import files

from conftest import rows


def _data(spark, n=2000, seed=11):
    rnd = random.Random(seed)
    out = []
    for i in range(n):
        g = rnd.choice(["a", "b", "c"])
        x = rnd.choice([1.0, 2.0, 2.0, 3.5]) if g == "a" else round(rnd.gauss(50, 20), 2)
        y = None if i % 7 == 0 else float(rnd.randint(0, 9))
        out.append((g, x, y))
    out.append(("d", None, None))  # a group without values
    out.append(("c", 1e12, 5.0))  # an outlier stretching the bins
    return spark.createDataFrame(out, "g string, x double, y double")


PROBS = [0.0, 0.25, 0.5, 0.75, 0.9, 1.0]


def test_grouped_quantiles_equal_percentile(spark):
    df = _data(spark)
    got = exact_quantiles(df, ["x", "y"], PROBS, by=["g"])
    names = [c for c in got.columns if c.startswith("q_")]
    for col in ("x", "y"):
        want = df.groupBy("g").agg(F.percentile(F.col(col), F.array(*[F.lit(p) for p in PROBS])).alias("w"))
        w = {r[0]: r[1] for r in rows(want)}
        for r in got.where(F.col("column") == col).collect():
            exp = w[r["g"]]
            if exp is None:
                assert all(r[n] is None for n in names) and r["n"] == 0
            else:
                assert [r[n] for n in names] == pytest.approx(exp, rel=1e-12, abs=1e-12)


def test_median_row(spark):
    df = _data(spark)
    got = exact_median_row(df, ["x", "y"]).collect()[0]
    want = df.agg(F.percentile("x", 0.5), F.percentile("y", 0.5)).collect()[0]
    assert got["x"] == pytest.approx(want[0]) and got["y"] == pytest.approx(want[1])


def test_outliers_cost_a_pass_and_no_sort(spark):
    from pyspark.sql import functions as F

    df = spark.range(20_001).select((F.col("id") % 100).cast("double").alias("v")).unionByName(
        spark.createDataFrame([(1e12,), (-1.7e308,), (1.7e308,), (5e-324,)], "v double")
    )
    values = sorted(r.v for r in df.collect())
    got = exact_quantiles(df, ["v"], [0.0, 0.25, 0.5, 1.0]).first()
    for p, name in ((0.0, "q_0"), (0.25, "q_0_25"), (0.5, "q_0_5"), (1.0, "q_1")):
        pos = p * (len(values) - 1)
        lo, hi = values[int(pos)], values[-(-int(pos * 4) // 4) if pos == int(pos) else int(pos) + 1]
        assert got[name] == pytest.approx(lo + (hi - lo) * (pos - int(pos)))


def test_infinite_values_end(spark):
    inf = float("inf")
    values = [-inf, -inf, -inf, 1.0, 2.5, 3.0, 1e308, -1e308, 7.0, inf, inf]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    for part in (df, df.where("v >= 3.0")):
        probs = [0.0, 0.25, 0.5, 0.75, 1.0]
        # a rank between equal values is that value (infinite ones as well), between others it is interpolated
        x = sorted(r.v for r in part.collect())
        want = []
        for p in probs:
            pos = p * (len(x) - 1)
            lo, hi = x[int(pos)], x[min(len(x) - 1, int(pos) + 1)]
            frac = pos - int(pos)
            want.append(lo if frac == 0 or lo == hi else (1 - frac) * lo + frac * hi)
        got = exact_quantiles(part, ["v"], probs).first()
        assert [got[n] for n in ("q_0", "q_0_25", "q_0_5", "q_0_75", "q_1")] == want


def _ieee(x):
    """IEEE 754 bits as a signed number of the same order."""
    n = struct.unpack(">q", struct.pack(">d", x))[0]
    return n if n >= 0 else -(n & 0x7FFF_FFFF_FFFF_FFFF)


def test_ordered_bits_are_the_ieee_bits(spark):
    rnd = random.Random(3)
    values = [struct.unpack(">d", rnd.randbytes(8))[0] for _ in range(20_000)]
    values += [2.0**e for e in range(-1074, 1024)] + [math.nextafter(2.0**e, math.inf) for e in range(-1074, 1024)]
    values += [math.nextafter(2.0**e, 0.0) for e in range(-1074, 1024)] + [0.0, -0.0, math.inf, -math.inf, 1.7976931348623157e308]
    values = [v for v in values if not math.isnan(v)]
    values += [-v for v in values]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    got = df.select("v", ordered_bits(F.col("v")).alias("b")).collect()
    assert all(r.b == _ieee(r.v) for r in got)


def test_four_passes_whatever_the_range(spark, monkeypatch):
    rnd = random.Random(5)
    values = [10.0 ** rnd.uniform(-300, 300) * rnd.choice([-1, 1]) for _ in range(4001)] + [1e-300, 1e300, -1e300, math.inf, -math.inf]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    written = []
    monkeypatch.setattr(quantiles, "materialize", lambda d, name: written.append(name) or files.materialize(d, name))
    got = exact_quantiles(df, ["v"], [0.5, 0.001, 0.999]).first()
    assert len(written) <= 2 + len(quantiles.SHIFTS)  # ranks, one table of each pass, and the values of the open bins
    x = sorted(values)
    for p, name in ((0.5, "q_0_5"), (0.001, "q_0_001"), (0.999, "q_0_999")):
        pos = p * (len(x) - 1)
        lo, hi = x[int(pos)], x[int(pos) + 1] if pos > int(pos) else x[int(pos)]
        frac = pos - int(pos)
        assert got[name] == (lo if frac == 0 else (1 - frac) * lo + frac * hi)


def test_a_null_group_has_quantiles(spark):
    df = spark.createDataFrame([(None, 1.0), (None, 3.0), ("a", 5.0)], "g string, x double")
    got = {r.g: (r.n, r.q_0_5) for r in exact_quantiles(df, ["x"], [0.5], by=["g"]).collect()}
    assert got == {None: (2, 2.0), "a": (1, 5.0)}
