"""Calendar features from transaction text."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from riskloom.functions import clock

TIME_COLUMN = "trans_date_trans_time"
FIELDS = ("year", "month", "day", "hour", "minute")


def parse_datetime(df: DataFrame, column: str = TIME_COLUMN, iso_dates: bool = True) -> DataFrame:
    """Add int columns year, month, day, hour, minute (NULL when absent).

    The text is split in staged projections (each split once per row; Catalyst
    keeps projections apart when merging would repeat a non-cheap expression).
    The fields then come out of a one-element ``inline(array(struct(...)))``
    generator: filters on them (valid dates, clock not NULL) stay above it
    instead of being pushed below with the whole split/regex chain inlined, so
    the text is parsed once per row and the stage stays inside whole-stage
    codegen (the inlined conditions exceed the 64 KB method limit)."""
    if column not in df.columns:
        raise ValueError(f"time column {column!r} is required")
    helpers = ["_dt_parts", "_dt_date", "_dt_time", "_dt_slash", "_dt_dash", "_dt_colon"]
    staged = (
        df.drop(*[c for c in FIELDS if c in df.columns])
        .withColumn("_dt_parts", F.split(clock.date_clean(F.col(column)), " "))
        .withColumns({"_dt_date": F.get(F.col("_dt_parts"), 0), "_dt_time": F.get(F.col("_dt_parts"), 1)})
        .withColumns(
            {
                "_dt_slash": F.split(F.col("_dt_date"), "/"),
                "_dt_dash": F.split(F.col("_dt_date"), "-"),
                "_dt_colon": F.split(F.col("_dt_time"), ":"),
            }
        )
    )
    fields = clock.parse_from_parts(
        F.col("_dt_date"), F.col("_dt_time"), F.col("_dt_slash"), F.col("_dt_dash"), F.col("_dt_colon"), iso_dates
    )
    parsed = F.struct(*[expr.alias(name) for name, expr in fields.items()])
    return staged.select("*", F.inline(F.array(parsed))).drop(*helpers)


def valid_dates(df: DataFrame, observation: Observation | None = None) -> DataFrame:
    """T5: keep rows with year, month and day (hour may be NULL).

    The dropped count is reported through ``observation`` (metrics ride on the
    next action -- no extra ``count`` job)."""
    ok = F.col("year").isNotNull() & F.col("month").isNotNull() & F.col("day").isNotNull()
    if observation is not None:
        df = df.observe(
            observation,
            F.count(F.lit(1)).alias("rows_in"),
            F.count_if(~ok).alias("rows_invalid_date"),
        )
    return df.where(ok)


def date_validity_report(parsed: DataFrame) -> DataFrame:
    """T5 / A4 as a report: one row ``(rows_in, rows_invalid_date)`` over parsed
    rows -- a lazy aggregate, computed only when the caller asks for it.

    (Pipelines that also score MLlib models use this instead of an
    ``Observation``: on PySpark 4.1 a session that has used an ``Observation``
    can no longer serialise MLlib transform closures.)"""
    ok = F.col("year").isNotNull() & F.col("month").isNotNull() & F.col("day").isNotNull()
    return parsed.agg(
        F.count(F.lit(1)).alias("rows_in"), F.count_if(~ok).cast("bigint").alias("rows_invalid_date")
    )


def calendar_flags(df: DataFrame) -> DataFrame:
    """is_night (22-05), is_business_hours (9-17), day_of_month; NULL hour -> 0."""
    h = F.col("hour")
    return df.withColumns(
        {
            "is_night": F.when((h >= 22) | (h <= 5), 1).otherwise(0),
            "is_business_hours": F.when((h >= 9) & (h <= 17), 1).otherwise(0),
            "day_of_month": F.col("day"),
        }
    )


def add_clocks(df: DataFrame, packed: str = "trans_seconds", epoch: str = "epoch_seconds") -> DataFrame:
    """T9 + T10: the packed YYYYMMDDHHMM clock and real epoch seconds."""
    parts = [F.col(c) for c in FIELDS]
    return df.withColumns({packed: clock.packed_clock(*parts), epoch: clock.epoch_clock(*parts)})


def calendar_features(df: DataFrame, iso_dates: bool = True, observation: Observation | None = None) -> DataFrame:
    """T1-T10 in order: parse, keep valid dates, flags, clocks."""
    return (
        df.transform(lambda d: parse_datetime(d, iso_dates=iso_dates))
        .transform(lambda d: valid_dates(d, observation))
        .transform(calendar_flags)
        .transform(add_clocks)
    )
