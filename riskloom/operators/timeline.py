"""Behaviour features carried across range partitions, and their mergeable state.

The same features as ``behavior.sequence_features``, for tables where one user has more rows
in one bucket than a task can take, and for daily batches that must not read the
history again.

A *timeline* has one row for each (user, clock): how many rows, their amounts, and the row
that comes first by the tie-break.  It is an aggregate (partial aggregation in the tasks
that read the rows), so a user-minute of half of all rows is at most sixty rows of it.
``carried`` turns it into features of each (user, clock):

1. every clock t is also asked for at t - frame; clocks and questions are dealt out by
   range of (user, time), so that a user with many clocks is many partitions;
2. inside a partition, running counts and the last clock so far;
3. the state at each partition's end, a row for each user in it, is summed up over
   the partitions below: a scan of one row for each partition and user;
4. a trailing count is the running count at t less that before t - frame.

Rows take these values by a join on (user, clock).  A (user, clock) of more than ``hot_rows``
rows is split into parts there, so no key outgrows a task.  The previous clock of a row
is its own clock if another row of the user comes before it at that clock.

Timelines of disjoint sets of rows merge by adding up.  ``append`` stores one for each batch,
``batch_features`` gives the features of a batch's rows from what is stored: the clocks
of the batch's days and of a frame before, and hourly sums of all else.

Defined results: rows without a key are one user; a NULL clock has no previous event, and
its count is the user's number of rows without a clock; repeated rows count each; an empty
table gives no row.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from riskloom.operators.behavior import EPOCH, ClockSpec
from riskloom.sources.files import materialize

USER = ["_user", "_keyless"]
#: Rows of one (user, clock) that are joined in one part, and parts of it at most.
HOT_ROWS = 65_536
MAX_PARTS = 4096


def _rows(df: DataFrame, spec: ClockSpec, key: str, batch: str) -> DataFrame:
    """The rows with user columns, ``_clock``, and an own number."""
    return df.withColumns(
        {
            "_user": F.coalesce(F.col(key).cast("string"), F.lit("")),
            "_keyless": F.col(key).isNull(),
            "_clock": F.col(spec.column).cast("long"),
            "_batch": F.lit(batch),
            "_row": F.monotonically_increasing_id(),
        }
    )


def timeline(rows: DataFrame, tiebreak: str, amount: str | None) -> DataFrame:
    """(user, clock) with the number of rows, amounts and the first row by the tie-break."""
    x = F.col(amount).cast("double") if amount else F.lit(None).cast("double")
    return rows.groupBy(*USER, "_clock").agg(
        F.count(F.lit(1)).alias("_n"),
        F.sum(x).alias("_sum"),
        F.count(x).alias("_n_amt"),
        F.min(F.struct(F.col(tiebreak).alias("tie"), "_batch", "_row")).alias("_first"),
    )


def merged(timelines: DataFrame) -> DataFrame:
    """One timeline of several; the order in which they are merged does not matter."""
    return timelines.groupBy(*USER, "_clock").agg(
        F.sum("_n").alias("_n"), F.sum("_sum").alias("_sum"), F.sum("_n_amt").alias("_n_amt"), F.min("_first").alias("_first")
    )


def _matched(left: DataFrame, right: DataFrame, on: list[str], how: str = "inner") -> DataFrame:
    """Join under which two NULLs are equal."""
    right = right.withColumnsRenamed({c: f"_r{c}" for c in on})
    return left.join(right, reduce(Column.__and__, [F.col(c).eqNullSafe(F.col(f"_r{c}")) for c in on]), how).drop(*[f"_r{c}" for c in on])


def carried(times: DataFrame, spec: ClockSpec, history: DataFrame | None = None) -> DataFrame:
    """``times`` with ``_prev`` (the user's clock before), ``_trailing`` (rows in
    ``[clock - frame, clock]``), ``_count`` and ``_avg`` (of all the user's rows).

    ``history`` replaces what lies before ``times``: for each user the last clock
    ``_older``, and the ``_rows``, ``_sum`` and ``_n_amt`` of all its rows."""
    asked = F.array(
        F.struct(F.lit(1).alias("_kind"), F.col("_clock").alias("_at")), F.struct(F.lit(0).alias("_kind"), (F.col("_clock") - spec.frame).alias("_at"))
    )
    events = times.withColumn("_e", F.explode(F.when(F.col("_clock").isNull(), F.slice(asked, 1, 1)).otherwise(asked))).select("*", "_e.*").drop("_e")
    is_row = F.col("_kind") == 1
    # a question repeats nothing but its clock
    events = events.select(*USER, "_clock", "_kind", "_at", *[F.when(is_row, F.col(c)).alias(c) for c in ("_n", "_sum", "_n_amt", "_first")])
    by_time = [F.col("_at").asc_nulls_first(), F.col("_kind")]
    ranged = events.repartitionByRange(*USER, *by_time).withColumn("_part", F.spark_partition_id())
    ranged = materialize(ranged, "timeline-ranges")

    counted = F.when(is_row & F.col("_clock").isNotNull(), F.col("_n")).otherwise(0)
    inside = Window.partitionBy("_part", *USER).orderBy(*by_time)
    local = ranged.withColumns(
        {
            "_run": F.sum(counted).over(inside.rowsBetween(Window.unboundedPreceding, 0)),
            "_local": F.last(F.when(is_row, F.col("_at")), ignorenulls=True).over(inside.rowsBetween(Window.unboundedPreceding, -1)),
        }
    )
    states = ranged.groupBy("_part", *USER).agg(
        F.sum(counted).alias("_c"), F.max(F.when(is_row, F.col("_at"))).alias("_last"),
        F.sum("_n").alias("_rows"), F.sum("_sum").alias("_sum"), F.sum("_n_amt").alias("_n_amt"),
    )
    lower = Window.partitionBy(*USER).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    every = Window.partitionBy(*USER)
    ends = states.select(
        "_part", *USER, F.coalesce(F.sum("_c").over(lower), F.lit(0)).alias("_below"), F.last("_last", ignorenulls=True).over(lower).alias("_carry"),
        *[F.sum(c).over(every).alias(c) for c in ("_rows", "_sum", "_n_amt")],
    )
    if history is not None:
        ends = ends.drop("_rows", "_sum", "_n_amt").join(history, USER, "left")
        ends = ends.withColumn("_carry", F.coalesce("_carry", "_older")).drop("_older")
    ends = ends.select("_part", *USER, "_below", "_carry", F.col("_rows").alias("_count"), F.try_divide("_sum", "_n_amt").alias("_avg"))
    joined = local.drop("_sum", "_n_amt").join(ends, ["_part", *USER]).withColumn("_upto", F.col("_run") + F.col("_below"))
    out = joined.groupBy(*USER, "_clock").agg(
        F.max("_n").alias("_n"), F.max("_first").alias("_first"), F.max("_count").alias("_count"), F.max("_avg").alias("_avg"),
        F.max(F.when(is_row, F.coalesce("_local", "_carry"))).alias("_prev"),
        F.max(F.when(is_row, F.col("_upto"))).alias("_upto"), F.max(F.when(~is_row, F.col("_upto"))).alias("_before"),
    )
    no_clock = F.col("_clock").isNull()
    return out.select(
        *USER, "_clock", "_n", "_first", "_count", "_avg", F.when(~no_clock, F.col("_prev")).alias("_prev"),
        F.when(no_clock, F.col("_n")).otherwise(F.col("_upto") - F.col("_before")).alias("_trailing"),
    )


def _attach(rows: DataFrame, times: DataFrame, spec: ClockSpec, amount: str | None, with_totals: bool, hot_rows: int) -> DataFrame:
    """The rows with the features of their (user, clock); hot ones in parts."""
    on = [*USER, "_clock"]
    times = materialize(times, "timeline-features")
    parts = F.least(F.expr(f"(_n + {hot_rows - 1}) div {hot_rows}"), F.lit(MAX_PARTS))
    hot = materialize(times.where(F.col("_n") > hot_rows).select(*on, parts.alias("_parts")), "timeline-hot")
    dealt = _matched(rows, hot, on, "left").withColumn("_part", F.pmod(F.xxhash64("_row"), F.coalesce("_parts", F.lit(1)))).drop("_parts")
    sides = times.withColumn("_part", F.explode(F.sequence(F.lit(0).cast("long"), parts - 1)))
    joined = _matched(dealt, sides, [*on, "_part"])
    clock = F.col("_clock")
    first = (F.col("_first._row") == F.col("_row")) & (F.col("_first._batch") == F.col("_batch"))
    prev = F.when(first, F.col("_prev")).otherwise(clock)
    gap = F.when(prev.isNotNull(), (clock - prev) / F.lit(spec.unit)).otherwise(F.lit(-1.0))
    named = {"prev_clock": prev, "hours_since_last_trans": gap, "trans_count_last_24h": F.col("_trailing")}
    if with_totals:
        named["user_transaction_count"] = F.col("_count")
        if amount:
            named["user_avg_amt"] = F.col("_avg")
    out = joined.withColumns(named).withColumn("is_rapid_transaction", F.when(F.col("hours_since_last_trans").between(0, 1), 1).otherwise(0))
    return out.drop(*on, "_part", "_batch", "_row", "_n", "_first", "_count", "_avg", "_prev", "_trailing")


def sequence_features(
    df: DataFrame,
    spec: ClockSpec = EPOCH,
    key: str = "user_id",
    tiebreak: str = "trans_num",
    amount: str | None = "amt",
    with_totals: bool = True,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """``behavior.sequence_features`` by carried states: no user, hour, minute or
    clock value is one task, whatever its share of the rows.  The rows are stored once."""
    rows = materialize(_rows(df, spec, key, ""), "timeline-rows")
    return _attach(rows, carried(timeline(rows, tiebreak, amount), spec), spec, amount, with_totals, hot_rows)


# ------------------------------------------------------------------ state of daily batches
def append(df: DataFrame, state: str, batch: str, spec: ClockSpec = EPOCH, key: str = "user_id", tiebreak: str = "trans_num", amount: str | None = "amt") -> None:
    """Store a batch's rows, their timeline and its sums by bucket under ``state``.

    A batch that is appended again replaces itself, so a failed one is just repeated."""
    spark, name = df.sparkSession, f"batch={batch}"
    _rows(df, spec, key, batch).write.mode("overwrite").parquet(f"{state}/rows/{name}")
    rows = spark.read.parquet(f"{state}/rows/{name}")
    day = F.floor(F.col("_clock") / spec.frame).cast("long")
    times = timeline(rows, tiebreak, amount).withColumn("_day", day)
    times.write.mode("overwrite").partitionBy("_day").parquet(f"{state}/clocks/{name}")
    times = spark.read.schema(times.schema).parquet(f"{state}/clocks/{name}")
    bucket = F.floor(F.col("_clock") / spec.bucket).cast("long").alias("_bucket")
    hours = times.groupBy(*USER, bucket).agg(
        F.sum("_n").alias("_n"), F.sum("_sum").alias("_sum"), F.sum("_n_amt").alias("_n_amt"), F.max("_clock").alias("_last")
    )
    hours.write.mode("overwrite").parquet(f"{state}/hours/{name}")


def totals(spark: SparkSession, state: str) -> DataFrame:
    """_user, _keyless, user_transaction_count and user_avg_amt over all batches."""
    sums = spark.read.parquet(f"{state}/hours").groupBy(*USER).agg(F.sum("_n").alias("_n"), F.sum("_sum").alias("_sum"), F.sum("_n_amt").alias("_n_amt"))
    return sums.select(*USER, F.col("_n").alias("user_transaction_count"), F.try_divide("_sum", "_n_amt").alias("user_avg_amt"))


def batch_features(
    spark: SparkSession, state: str, batch: str, spec: ClockSpec = EPOCH, tiebreak: str = "trans_num", amount: str | None = "amt",
    with_totals: bool = True, hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """The rows of one appended batch with the features that all batches in ``state``
    give them.  Of the other batches the clocks of the batch's own days and of one
    frame before are read, and the sums of all buckets."""
    rows = spark.read.parquet(f"{state}/rows/batch={batch}")
    ends = rows.agg(F.min("_clock").alias("lo"), F.max("_clock").alias("hi")).first()
    first = f"struct<tie: {rows.schema[tiebreak].dataType.simpleString()}, _batch: string, _row: long>"
    columns = f"_user string, _keyless boolean, _clock long, _n long, _sum double, _n_amt long, _first {first}, batch string, _day long"
    stored = spark.read.schema(columns).parquet(f"{state}/clocks")  # a state without rows has no schema
    first_day = None if ends["lo"] is None else ends["lo"] // spec.frame - 1
    near = F.col("_day").isNull()
    if first_day is not None:
        near = near | F.col("_day").between(first_day, ends["hi"] // spec.frame)
    times = merged(stored.where(near).drop("batch", "_day"))
    hours = spark.read.parquet(f"{state}/hours")
    older = F.col("_last") if first_day is None else F.when(F.col("_bucket") < first_day * (spec.frame // spec.bucket), F.col("_last"))
    history = hours.groupBy(*USER).agg(
        F.max(older).alias("_older"), F.sum("_n").alias("_rows"), F.sum("_sum").alias("_sum"), F.sum("_n_amt").alias("_n_amt")
    )
    return _attach(rows, carried(times, spec, history), spec, amount, with_totals, hot_rows)
