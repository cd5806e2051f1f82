"""Stages whose generated methods the JVM compiles: it interprets those of more than 8000 bytes."""

import contextlib
import io
import re

from pyspark.sql import functions as F

from riskloom.functions.stats import ordered_bits
from riskloom.operators import behavior, calendar
from riskloom.plans import pipeline
from riskloom.sources import fixtures

HUGE = 8000


def largest_method(df) -> int:
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain(mode="codegen")
    return max(int(n) for n in re.findall(r"maxMethodCodeSize:(\d+)", out.getvalue()))


def events(spark, tmp_path):
    """Source rows without any value: what is looked at are the plans."""
    columns = "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string"
    spark.createDataFrame([], columns).write.parquet(f"{tmp_path}/events.parquet")
    return str(tmp_path)


def test_preparation_is_compiled(spark, tmp_path):
    raw = fixtures.raw_transactions(spark, events(spark, tmp_path))
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        prepared = behavior.add_user_key(calendar.calendar_features(pipeline.prepare(raw)))
        assert largest_method(prepared) < HUGE
        assert largest_method(pipeline.engineer_features(pipeline.prepare(raw))) < HUGE
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")


def test_order_of_doubles_is_compiled(spark):
    numbers = spark.range(10).select((F.col("id") / 7).alias("v"))
    assert largest_method(numbers.select(ordered_bits(F.col("v")).alias("b"))) < HUGE // 4
    missing = spark.sql("SELECT CAST(NULL AS DOUBLE) AS v").select(ordered_bits(F.col("v")).alias("b"))
    assert missing.first()["b"] is None
