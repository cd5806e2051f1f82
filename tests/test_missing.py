"""M1-M8: one-pass null profile, essential drop, typed and literal imputation."""

from __future__ import annotations

import math

import pytest
from pyspark.sql import types as T

from riskloom.operators import missing

from conftest import rows

SCHEMA = T.StructType(
    [
        T.StructField("amt", T.FloatType()),
        T.StructField("is_fraud", T.IntegerType()),
        T.StructField("city_pop", T.IntegerType()),
        T.StructField("job", T.StringType()),
    ]
)
DATA = [(1.0, 0, 10, "a"), (None, 1, None, None), (3.0, None, 30, "c"), (5.0, 1, 20, None)]


def test_null_profile_one_pass(spark):
    df = spark.createDataFrame(DATA, SCHEMA)
    got = dict(rows(missing.null_profile(df)))
    assert got == {"amt": 1, "is_fraud": 1, "city_pop": 1, "job": 2}
    full = dict(rows(missing.null_profile(df.dropna(), nonzero_only=False)))
    assert full == {"amt": 0, "is_fraud": 0, "city_pop": 0, "job": 0}


def test_essential_columns_by_keyword(spark):
    df = spark.createDataFrame(DATA, SCHEMA).withColumn("user_avg_amt", df_lit(spark))
    assert missing.essential_columns(df) == ["amt", "is_fraud", "user_avg_amt"]


def df_lit(spark):
    from pyspark.sql import functions as F

    return F.lit(1.0)


def test_drop_essential_and_empty_list(spark):
    df = spark.createDataFrame(DATA, SCHEMA)
    assert missing.drop_essential(df, ["amt", "is_fraud"]).count() == 2
    assert missing.drop_essential(df, []).count() == 4


def test_impute_by_type_exact_median(spark):
    df = spark.createDataFrame(DATA, SCHEMA)
    out = missing.handle_missing(df, essential=["is_fraud"], exact_median=True)
    got = sorted(rows(out), key=lambda r: (r[0] is None, r[0]))
    # amt median over rows with a label: (1, 5, NULL) -> median 3.0; city_pop median of (10, 20) -> 15
    assert [r[0] for r in got] == [1.0, 3.0, 5.0]
    assert sorted(r[2] for r in got) == [10, 15, 20]
    assert sorted(r[3] for r in got) == ["a", "unknown", "unknown"]


def test_impute_approx_median_is_a_data_value(spark):
    df = spark.createDataFrame(DATA, SCHEMA)
    out = missing.handle_missing(df, essential=["is_fraud"], exact_median=False)
    assert sorted(r[0] for r in rows(out, "amt")) in ([1.0, 1.0, 5.0], [1.0, 5.0, 5.0])


def test_literal_reference_fill_writes_zero_text(spark):
    df = spark.createDataFrame([("x", None), (None, "1")], "a string, b string")
    out = missing.impute(df, by_type=False)
    assert rows(out) == [("x", "0"), ("0", "1")]


def test_zero_fill_nan_and_null_keeps_int(spark):
    df = spark.createDataFrame([(float("nan"), None), (None, 2), (1.0, 3)], "x double, k int")
    out = missing.zero_fill(df, ["x", "k"])
    assert dict(out.dtypes)["k"] == "int"
    got = rows(out)
    assert [r[0] for r in got] == [0.0, 0.0, 1.0] and [r[1] for r in got] == [0, 2, 3]
    assert not any(isinstance(r[0], float) and math.isnan(r[0]) for r in got)


def test_all_null_numeric_column_fills_zero(spark):
    df = spark.createDataFrame([(None, 1), (None, 0)], "v double, is_fraud int")
    out = missing.impute(df, essential=["is_fraud"])
    assert [r[0] for r in rows(out, "v")] == [pytest.approx(0.0), pytest.approx(0.0)]
