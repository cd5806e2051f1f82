"""Fixture tables derived by Spark from the driver's parquet tables.

The engine's input contract is a raw, all-string transaction table.  The test
data holds no such table, so ``raw_transactions`` derives one from ``events``
with every row kept: both date layouts, unparseable dates, NULL amounts and
labels, sentinel strings, quotes, backslashes and control characters.  Its
work grows with ``events``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()

# Column order of the raw transaction contract.
RAW_COLUMNS = (
    "trans_num",
    "trans_date_trans_time",
    "amt",
    "is_fraud",
    "merchant",
    "category",
    "city",
    "job",
    "dob",
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def raw_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dirty, all-string transactions over every ``events`` row."""
    ev = table(spark, sf_dir, "events")
    eid = F.col("event_id")
    date_dash = F.date_format("ts", "dd-MM-yyyy HH:mm")
    date_slash = F.date_format("ts", "M/d/yyyy HH:mm")
    dirty_merchant = F.concat(F.lit("  "), F.col("props"), F.lit("\\\t\nx "))
    return ev.select(
        eid.cast("string").alias("trans_num"),
        F.when(eid % 101 == 0, F.lit("not-a-date"))
        .when(eid % 2 == 0, date_dash)
        .otherwise(date_slash)
        .alias("trans_date_trans_time"),
        F.when(eid % 89 == 0, F.lit(None).cast("string")).otherwise(F.col("value").cast("string")).alias("amt"),
        F.when(eid % 97 == 0, F.lit(None).cast("string"))
        .when(F.col("event_type") == "error", F.lit("1"))
        .otherwise(F.lit("0"))
        .alias("is_fraud"),
        F.when(eid % 13 == 0, F.lit(" null"))
        .when(eid % 11 == 0, F.lit("NULL"))
        .otherwise(dirty_merchant)
        .alias("merchant"),
        F.col("event_type").alias("category"),
        F.concat(F.lit("city"), (F.col("user_id") % 10).cast("string")).alias("city"),
        F.when(F.col("user_id") % 7 == 0, F.lit(None).cast("string"))
        .otherwise(F.concat(F.lit("job"), (F.col("user_id") % 5).cast("string")))
        .alias("job"),
        F.col("user_id").cast("string").alias("dob"),
    )


#: Columns of the raw contract that ``raw_transactions`` leaves out.
CONTRACT_COLUMNS = (*RAW_COLUMNS, "state", "city_pop", "lat", "long", "merch_lat", "merch_long")


def contract_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every column of the raw contract over every ``events`` row: quoted and time-less
    dates, labels with trailing or leading characters, ``None`` and empty text,
    populations with separators, coordinates that are no numbers, NULL numbers."""
    eid, uid = F.col("event_id"), F.col("user_id")
    null = F.lit(None).cast("string")
    day, both = F.date_format("ts", "dd-MM-yyyy"), F.date_format("ts", "dd-MM-yyyy HH:mm")
    label = F.when(F.col("event_type") == "error", F.lit("1")).otherwise(F.lit("0"))
    return table(spark, sf_dir, "events").select(
        eid.cast("string").alias("trans_num"),
        F.when(eid % 5 == 0, day).when(eid % 3 == 0, F.concat(F.lit(' "'), both, F.lit('"'))).otherwise(both).alias("trans_date_trans_time"),
        F.when(eid % 89 == 0, null).otherwise(F.col("value").cast("string")).alias("amt"),
        F.when(eid % 7 == 0, F.lit("10")).when(eid % 11 == 0, F.lit(" 1")).when(eid % 13 == 0, F.lit('0"2020')).otherwise(label).alias("is_fraud"),
        F.when(eid % 4 == 0, F.lit("")).when(eid % 9 == 0, F.lit("None")).otherwise(F.col("props")).alias("merchant"),
        F.col("event_type").alias("category"),
        F.concat(F.lit("city"), (uid % 10).cast("string")).alias("city"),
        F.when(uid % 7 == 0, F.lit(" None ")).otherwise(F.concat(F.lit("job"), (uid % 5).cast("string"))).alias("job"),
        uid.cast("string").alias("dob"),
        F.when(eid % 8 == 0, F.lit("None")).when(eid % 6 == 0, F.lit("")).otherwise(F.concat(F.lit("S\t"), (uid % 6).cast("string"))).alias("state"),
        F.when(eid % 6 == 0, null).when(eid % 10 == 1, F.lit("x")).when(eid % 50 == 2, F.lit("1,234"))
        .otherwise(F.concat((eid % 5 * 100).cast("string"), F.lit(" people"))).alias("city_pop"),
        F.when(eid % 12 == 0, F.lit("n/a")).otherwise(F.concat((uid % 90).cast("string"), F.lit(".25"))).alias("lat"),
        F.when(eid % 12 == 1, null).otherwise(F.concat(F.lit("-"), (uid % 180).cast("string"), F.lit(".5"))).alias("long"),
        F.concat((eid % 90).cast("string"), F.lit(".125")).alias("merch_lat"),
        F.when(eid % 12 == 2, F.lit("")).otherwise((eid % 180).cast("string")).alias("merch_long"),
    )


def mixed_layout_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order dates of every ``orders`` row written in three layouts (ISO, D-M-Y,
    M/D/Y) plus date-only rows: exercises layout dispatch and month boundaries."""
    o = table(spark, sf_dir, "orders")
    k = F.col("o_orderkey")
    d = F.col("o_orderdate")
    return o.select(
        k.cast("string").alias("trans_num"),
        F.when(k % 4 == 0, F.date_format(d, "yyyy-MM-dd HH:mm"))
        .when(k % 4 == 1, F.date_format(d, "dd-MM-yyyy HH:mm"))
        .when(k % 4 == 2, F.date_format(d, "M/d/yyyy H:mm"))
        .otherwise(F.date_format(d, "yyyy-MM-dd"))
        .alias("trans_date_trans_time"),
    )


def uneven_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """CSV lines of every ``events`` row with five fields (one quoted, with separators and
    quotes in it), one field less in some and one more in others."""
    ev = table(spark, sf_dir, "events")
    eid = F.col("event_id")
    quoted = F.concat(F.lit('"'), F.regexp_replace("props", '"', '""'), F.lit(', ""x"""'))
    fields = [eid.cast("string"), F.col("event_type"), quoted, F.col("user_id").cast("string")]
    last = F.when(eid % 17 == 0, F.array()).when(eid % 19 == 0, F.array(F.lit("a"), F.lit("b,c"))).otherwise(F.array(F.lit("a")))
    return ev.select(F.array_join(F.concat(F.array(*fields), last.cast("array<string>")), ",").alias("value"))
