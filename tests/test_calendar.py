"""Layout dispatch, ISO branch, missing time part, flags, both clocks."""

from __future__ import annotations

from pyspark.sql import Observation
from pyspark.sql import types as T

from riskloom.operators import calendar

from conftest import rows


def _times(spark, values):
    schema = T.StructType([T.StructField("trans_date_trans_time", T.StringType())])
    return spark.createDataFrame([(v,) for v in values], schema)


FIELDS = ("year", "month", "day", "hour", "minute")


def test_layout_dispatch_literal_rule(spark):
    df = _times(spark, ["1/2/2019 13:05", "01-02-2019 00:58", '"2019-03-04 10:00"', "2019-01-01", "garbage"])
    out = rows(calendar.parse_datetime(df, iso_dates=False), *FIELDS)
    assert out[0] == (2019, 1, 2, 13, 5)
    assert out[1] == (2019, 2, 1, 0, 58)
    # the reference's rule reads an ISO year as the day
    assert out[2] == (2019, 3, 2019, 10, 0)
    assert out[3][3:] == (None, None)
    assert out[4][0] is None


def test_iso_branch(spark):
    df = _times(spark, ["2019-03-04 10:00", "1/2/2019 1:02", "04-03-2019 10:00"])
    out = rows(calendar.parse_datetime(df, iso_dates=True), *FIELDS)
    assert out == [(2019, 3, 4, 10, 0), (2019, 1, 2, 1, 2), (2019, 3, 4, 10, 0)]


def test_valid_dates_and_observation(spark):
    # own session: on PySpark 4.1 a session that used an Observation can no
    # longer serialise MLlib transform closures (see date_validity_report)
    s2 = spark.newSession()
    df = calendar.parse_datetime(_times(s2, ["1/2/2019 1:02", "not-a-date", "2019-01-01"]))
    obs = Observation("t5")
    kept = calendar.valid_dates(df, obs)
    assert kept.count() == 2
    assert obs.get == {"rows_in": 3, "rows_invalid_date": 1}
    report = calendar.date_validity_report(df).first()
    assert (report["rows_in"], report["rows_invalid_date"]) == (3, 1)


def test_flags_and_clocks(spark):
    df = _times(spark, ["1/31/2019 23:00", "2/1/2019 05:00", "2/1/2019 06:00", "2019-01-01"])
    out = calendar.calendar_features(df)
    got = rows(out, "hour", "is_night", "is_business_hours", "day_of_month", "trans_seconds", "epoch_seconds")
    assert got[0] == (23, 1, 0, 31, 201901312300, 1548975600)
    assert got[1][:3] == (5, 1, 0)
    assert got[2][:3] == (6, 0, 0)
    # no time part: hour NULL -> flags 0, both clocks NULL
    assert got[3] == (None, 0, 0, 1, None, None)


def test_epoch_clock_rejects_impossible_dates(spark):
    out = calendar.calendar_features(_times(spark, ["2/31/2019 10:00"]))
    assert rows(out, "trans_seconds", "epoch_seconds") == [(201902311000, None)]
