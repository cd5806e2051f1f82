"""Per-user behaviour features.

Semantics (per user, events ordered by a clock, ties broken by ``trans_num``):

* ``user_transaction_count`` / ``user_avg_amt``: rows and mean amount of the user;
* previous clock (``lag``), ``hours_since_last_trans`` = (clock - previous) / unit,
  -1.0 when there is no previous event;
* ``is_rapid_transaction`` = gap between 0 and 1 inclusive;
* ``trans_count_last_24h`` = events of the user with clock in ``[t - frame, t]``
  (``RANGE`` frame: clock peers included).

Plan shape, designed so that one user holding a third of all rows does not
become one task:

1. rows are keyed by ``(user, bucket)`` with ``bucket = floor(clock / width)``
   and a width that divides the frame (``frame = k * width``; one hour for the
   real clock, k = 24).  A ``[t - frame, t]`` frame covers the tail of bucket
   ``b - k``, all of buckets ``b - k + 1 .. b - 1`` and the head of ``b``.  One
   generator pass emits every row and a narrow context copy (key, clock,
   tie-break only) for bucket ``b + k``; after ONE exchange on ``(user,
   bucket)`` a ``RANGE [t - frame, t]`` count over own + context rows gives
   the head and the tail, and ``last(own clock)`` the previous event inside
   the bucket -- both windows share one sort.
2. a small ``groupBy(user, bucket)`` aggregate (partial aggregation, reading
   only the pruned key/clock/amount columns; one row per active user-hour)
   gives, by windows over a user's buckets, the count of the full middle
   buckets (``RANGE (k-1) .. 1 PRECEDING`` on the bucket number, so empty
   buckets need no row), the last clock of the previous non-empty bucket, and
   the per-user totals.  It is joined back on ``(user, bucket)`` -- the window
   output is already partitioned that way, so only the small side moves (or
   it is broadcast when AQE measures it small).

The input is read by two branches (rows and the per-bucket aggregate), so it
must be deterministic -- a table, or a plan without ``limit``/``sample``/``rand``
(materialise such an input first).
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskloom.functions.text import join_key

# Fixed values (reference behaviour): the identity key parts and the packed
# clock's "24 h" range and hour unit.
USER_KEY_PARTS = ("city", "job", "dob")
PACKED_FRAME = 10000
PACKED_UNIT = 10000.0
# Real-time semantics (ours): 24 h in seconds, hours in seconds.
EPOCH_FRAME = 86400
EPOCH_UNIT = 3600.0

NULL_BUCKET = -(2**62)  # bucket ids NULL_BUCKET - (0 .. NULL_SPREAD-1): rows whose clock is NULL
NULL_SPREAD = 64


@dataclass(frozen=True)
class ClockSpec:
    """Which clock drives the sequence features and how to read it.

    ``bucket`` is the partitioning width in clock units; it must divide
    ``frame``.  Smaller buckets split hot users finer (still one context copy
    per row) at the cost of more rows in the per-bucket aggregate."""

    column: str
    frame: int
    unit: float
    bucket: int

    def __post_init__(self) -> None:
        if self.bucket <= 0 or self.frame % self.bucket:
            raise ValueError("bucket width must divide the frame")


# Packed clock: 100 units = one hour (..DDHH00 .. ..DDHH59); the frame spans 100 of them.
PACKED = ClockSpec("trans_seconds", PACKED_FRAME, PACKED_UNIT, 100)
EPOCH = ClockSpec("epoch_seconds", EPOCH_FRAME, EPOCH_UNIT, 3600)


def add_user_key(df: DataFrame, parts: Sequence[str] = USER_KEY_PARTS, name: str = "user_id") -> DataFrame:
    """Identity key from city, job and date of birth (NULL parts skipped)."""
    return df.withColumn(name, join_key(*parts))


def user_totals(df: DataFrame, key: str = "user_id", amount: str = "amt") -> DataFrame:
    """W1 + W2 as a two-phase aggregate joined back on the key.

    ``groupBy`` combines map-side, so a hot user costs one partial row per task;
    the join back is a shuffle join that AQE's skew-join splits for hot keys
    (or a broadcast when the per-user table is measured small)."""
    per_user = df.groupBy(F.col(key).alias("_user")).agg(
        F.count(F.lit(1)).alias("user_transaction_count"),
        F.avg(amount).alias("user_avg_amt"),
    )
    # rows without a key are one user, as in a window
    return df.join(per_user, F.col(key).eqNullSafe(F.col("_user")), "left").drop("_user")


def sequence_features(
    df: DataFrame,
    spec: ClockSpec = EPOCH,
    key: str = "user_id",
    tiebreak: str = "trans_num",
    amount: str | None = "amt",
    with_totals: bool = True,
) -> DataFrame:
    """W1-W7 with one wide exchange; see the module docstring for the plan.

    Adds ``prev_clock``, ``hours_since_last_trans``, ``is_rapid_transaction``,
    ``trans_count_last_24h`` and (``with_totals``) ``user_transaction_count``,
    ``user_avg_amt``."""
    clock, frame, width = spec.column, spec.frame, spec.bucket
    k = frame // width
    # NULL-clock rows are spread over NULL_SPREAD sub-buckets by a hash of the
    # tie-break key and the amount (both branches read these, and a key may be NULL too):
    # they need no window (their count is the user's number of NULL-clock rows,
    # their previous clock is NULL), so a user with many unparseable times is not
    # one task.
    spread_by = [tiebreak, *([amount] if amount else [])]
    null_sub = F.lit(NULL_BUCKET) - F.pmod(F.xxhash64(*spread_by), F.lit(NULL_SPREAD))
    bucket = F.when(F.col(clock).isNull(), null_sub).otherwise(F.floor(F.col(clock) / F.lit(width)).cast("long"))
    # rows without a key are one user, as in a window; two columns that are never NULL stand
    # for the key, so that the joins below are plain equalities
    user = ["_user", "_keyless"]
    base = df.withColumns(
        {"_bucket": bucket, "_user": F.coalesce(F.col(key).cast("string"), F.lit("")), "_keyless": F.col(key).isNull()}
    )
    keep = {clock, tiebreak, "_bucket", *user}
    wide = [c for c in base.columns if c not in keep]

    # One pass over the input: every row is emitted as itself (_own) and, when
    # its clock is known, as a narrow context copy for bucket b + k (wide
    # columns NULL, so the copy costs a few bytes in the shuffle).
    copies = F.when(F.col(clock).isNull(), F.array(F.lit(True))).otherwise(F.array(F.lit(True), F.lit(False)))
    doubled = base.select("*", F.explode(copies).alias("_own"))
    own = F.col("_own")
    both = doubled.select(
        *user,
        (F.col("_bucket") + F.when(own, F.lit(0)).otherwise(F.lit(k))).alias("_bucket"),
        F.col(clock),
        F.col(tiebreak),
        own,
        *[F.when(own, F.col(c)).alias(c) for c in wide],
    )

    ordered = Window.partitionBy(*user, "_bucket").orderBy(F.col(clock).asc_nulls_first(), F.col(tiebreak))
    trailing = Window.partitionBy(*user, "_bucket").orderBy(F.col(clock).asc_nulls_first()).rangeBetween(-frame, 0)
    before_me = ordered.rowsBetween(Window.unboundedPreceding, -1)
    windowed = both.withColumn(
        "_lag", F.last(F.when(own, F.col(clock)), ignorenulls=True).over(before_me)
    ).withColumn("_edge", F.count(F.lit(1)).over(trailing))
    mine = windowed.where(own).drop("_own")

    # Small side: one row per user-bucket (partial aggregation map-side, over
    # the narrow pruned columns of the input) with its last clock, carried
    # forward over buckets, and the per-user totals.
    aggs = [F.max(clock).alias("_last"), F.count(F.lit(1)).alias("_n")]
    if with_totals and amount:
        aggs += [F.sum(F.col(amount).cast("double")).alias("_sum_amt"), F.count(amount).alias("_n_amt")]
    per_bucket = base.groupBy(*user, "_bucket").agg(*aggs)
    by_user = Window.partitionBy(*user)
    info_cols = [
        *[F.col(c) for c in user],
        F.col("_bucket"),
        F.lag("_last").over(Window.partitionBy(*user).orderBy("_bucket")).alias("_prev_last"),
        F.sum(F.when(F.col("_bucket") <= NULL_BUCKET, F.col("_n")).otherwise(F.lit(0))).over(by_user).alias("_null_n"),
        F.coalesce(
            F.sum("_n").over(Window.partitionBy(*user).orderBy("_bucket").rangeBetween(-(k - 1), -1)), F.lit(0)
        ).alias("_mid"),
    ]
    if with_totals:
        info_cols.append(F.sum("_n").over(by_user).alias("user_transaction_count"))
        if amount:
            info_cols.append(
                F.try_divide(F.sum("_sum_amt").over(by_user), F.sum("_n_amt").over(by_user)).alias("user_avg_amt")
            )
    info = per_bucket.select(*info_cols)

    joined = mine.join(info, on=[*user, "_bucket"], how="left")
    prev = F.coalesce(F.col("_lag"), F.col("_prev_last"))
    gap = F.when(prev.isNotNull(), (F.col(clock) - prev) / F.lit(spec.unit)).otherwise(F.lit(-1.0))
    count = F.when(F.col(clock).isNull(), F.col("_null_n")).otherwise(F.col("_edge") + F.col("_mid"))
    out = joined.withColumns(
        {"prev_clock": prev, "hours_since_last_trans": gap, "trans_count_last_24h": count}
    ).withColumn("is_rapid_transaction", F.when(F.col("hours_since_last_trans").between(0, 1), 1).otherwise(0))
    return out.drop("_lag", "_prev_last", "_bucket", "_null_n", "_edge", "_mid", *user)
