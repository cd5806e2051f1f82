"""The row-local stages run unchanged on a streaming DataFrame."""

from __future__ import annotations

from riskloom.operators.calendar import calendar_features
from riskloom.operators.cleaning import clean_and_type
from riskloom.session import scratch_path
from riskloom.sources import fixtures

from conftest import SF_SMALL


def test_row_local_stages_on_a_stream(spark):
    src = scratch_path(spark, "stream-src")
    batch = fixtures.raw_transactions(spark, SF_SMALL)
    batch.write.parquet(src)
    stream = spark.readStream.schema(batch.schema).parquet(src)
    out = stream
    for stage in (clean_and_type, calendar_features):
        out = stage(out)
    q = out.writeStream.format("memory").queryName("rl_stream_out").outputMode("append").start()
    try:
        q.processAllAvailable()
    finally:
        q.stop()
    streamed = spark.table("rl_stream_out")
    want = batch
    for stage in (clean_and_type, calendar_features):
        want = stage(want)
    assert streamed.count() == want.count()
    assert streamed.exceptAll(want).count() == 0
