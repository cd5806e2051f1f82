"""Cleaning and typing on hand-made edge rows (FIXTURES section 3)."""

from __future__ import annotations

import pytest
from pyspark.sql import types as T

from riskloom.operators import cleaning

from conftest import rows

S = T.StringType()


def _one_col(spark, name, values):
    return spark.createDataFrame([(v,) for v in values], T.StructType([T.StructField(name, S)]))


def test_clean_text_normalises_and_nulls_sentinels(spark):
    df = _one_col(spark, "merchant", ['a\\b "q"\t\n z ', "NULL", "  ", "null ", "None", "ok"])
    out = [r[0] for r in rows(cleaning.clean_string_columns(df))]
    assert out == ["ab q z", None, None, None, None, "ok"]


def test_clean_text_is_idempotent(spark):
    df = _one_col(spark, "job", ['  x\\y  "z"\r\n\tw ', "a  b"])
    once = cleaning.clean_string_columns(df)
    twice = cleaning.clean_string_columns(once)
    assert rows(once) == rows(twice)


def test_merchant_rule_replaces_instead_of_deleting(spark):
    df = _one_col(spark, "merchant", ["a\\b", '  x"y  ', "\t\n", None, " null"])
    out = [r[0] for r in rows(cleaning.clean_merchant(df))]
    assert out == ["a b", "x y", None, None, "null"]


def test_label_and_population_parsing(spark):
    schema = T.StructType([T.StructField("is_fraud", S), T.StructField("city_pop", S)])
    df = spark.createDataFrame(
        [("1", "1,234"), ("10", "-5"), ("abc", "x"), (" 1", None), (None, "77")], schema
    )
    out = rows(cleaning.cast_columns(df))
    assert out == [(1, 1), (1, 5), (None, None), (None, None), (None, 77)]


def test_amount_and_geo_casts_are_ansi_safe(spark):
    schema = T.StructType([T.StructField(c, S) for c in ("amt", "lat", "trans_date_trans_time")])
    df = spark.createDataFrame([("14.37", "64.75", ' "1/4/2019 0:58" '), ("", "n/a", None)], schema)
    out = cleaning.cast_columns(df)
    assert dict(out.dtypes)["amt"] == "float"
    assert dict(out.dtypes)["lat"] == "double"
    got = rows(out)
    assert got[0][0] == pytest.approx(14.37, rel=1e-6) and got[0][1] == 64.75 and got[0][2] == "1/4/2019 0:58"
    assert got[1] == (None, None, None)


def test_missing_policy(spark):
    df = _one_col(spark, "merchant", ["x"])
    assert cleaning.present(df, ["merchant", "job"]) == ["merchant"]
    with pytest.raises(ValueError):
        cleaning.present(df, ["merchant", "job"], missing="error")


def test_fused_rules_equal_the_step_by_step_rules(spark):
    """The 2-pass C1 and 1-pass C3 equal the literal multi-step regex chains."""
    from pyspark.sql import functions as F

    alphabet = ["a", " ", "\t", "\r", "\n", "\\", '"', "\x0b", "\x0c", "x", "  "]
    import random

    rnd = random.Random(5)
    values = ["".join(rnd.choice(alphabet) for _ in range(rnd.randint(0, 12))) for _ in range(400)]
    df = _one_col(spark, "v", values + [None])
    c = F.col("v")
    c1 = F.trim(
        F.regexp_replace(
            F.regexp_replace(F.regexp_replace(F.regexp_replace(c, r"\\", ""), '"', ""), r"[\t\r\n]+", " "),
            r"\s+",
            " ",
        )
    )
    c3 = F.regexp_replace(
        F.regexp_replace(F.regexp_replace(c, r'[\\"\t\r\n]+', " "), r"\s+", " "), r"^\s+|\s+$", ""
    )
    c3 = F.when(c3.rlike(r"^\s*$") | c3.isNull(), F.lit(None)).otherwise(c3)
    from riskloom.functions import text

    out = df.select(
        text.normalize_text(c).alias("a"), c1.alias("b"), text.clean_merchant_text(c).alias("m"), c3.alias("n")
    ).collect()
    assert all(r["a"] == r["b"] for r in out)
    assert all(r["m"] == r["n"] for r in out)
