"""Exact quantiles with bounded per-task state.

Spark's exact ``percentile`` keeps a map of every distinct value of a group and
merges the partial maps of a group in one task.  This operator computes the
same numbers (linear interpolation between the closest ranks,
``pos = p * (n - 1)``) by narrowing the range that holds each needed rank:

1. every value as a 64-bit integer of the same order (``functions.ordered_bits``).  Per group
   (and per value column -- several columns are unpivoted into one long table and handled in
   the same pass), a histogram of its first 16 bits (partial aggregation; at most 65 537 rows
   of a group) gives the number of values and the bin that holds each needed rank;
2. the values of these bins are stored, and the next 16 bits are counted inside them only.
   A rank is found when its bin holds one value, after four passes at the latest, whatever the
   range of the values: 1e-300, 1e300 and infinite ones lie in one histogram.

No step sorts rows or keeps distinct values.  The input is scanned twice, by the first pass and
for what is stored: pass a table (or a materialised intermediate), not an expensive lazy plan.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskloom.functions.stats import ordered_bits
from riskloom.sources.files import materialize

#: Bits of a pass, from the highest.
SHIFTS = (48, 32, 16, 0)


def _q_name(p: float) -> str:
    return "q_" + f"{p:.6f}".rstrip("0").rstrip(".").replace(".", "_")


def exact_quantiles(
    df: DataFrame,
    values: Sequence[str],
    probs: Sequence[float],
    by: Sequence[str] = (),
) -> DataFrame:
    """One row per (``by`` group, value column) with one column per prob.

    Output columns: ``*by``, ``column``, ``n`` and ``q_<p>`` for each prob
    (e.g. ``q_0_5``).  NULL and NaN values are ignored; a group with no value gives
    NULL quantiles.

    Without groups the side tables have one row per column and prob and are
    broadcast; with groups, whose number nothing bounds, the joins are left to AQE."""
    by = list(by)
    small = not by
    keys = by + ["_col"]

    def matched(left: DataFrame, right: DataFrame, on: Sequence[str]) -> DataFrame:
        """Inner join with a side table; two NULLs in a group column are equal."""
        side = right.withColumnsRenamed({c: f"_r{c}" for c in on})
        equal = [F.col(c).eqNullSafe(F.col(f"_r{c}")) if c in by else F.col(c) == F.col(f"_r{c}") for c in on]
        return left.join(F.broadcast(side) if small else side, reduce(Column.__and__, equal)).drop(*[f"_r{c}" for c in on])

    stacked = df.select(
        *by,
        F.explode(
            F.array(*[F.struct(F.lit(v).alias("_col"), (F.col(v).cast("double") + 0.0).alias("_v")) for v in values])
        ).alias("_kv"),
    ).select(*by, F.col("_kv._col").alias("_col"), F.col("_kv._v").alias("_v"))
    valid = F.col("_v").isNotNull() & ~F.isnan("_v")
    data = stacked.withColumn("_bits", F.when(valid, ordered_bits(F.col("_v"))))

    def histogram(rows: DataFrame, by_bins: Sequence[str], shift: int) -> DataFrame:
        return rows.groupBy(*by_bins, F.shiftright("_bits", shift).alias("_next")).agg(
            F.count(F.lit(1)).alias("_c"), F.min("_v").alias("_lo"), F.max("_v").alias("_hi")
        )

    def holding(hist: DataFrame) -> DataFrame:
        """The needed ranks (from 0, ``_k``) in the bins that hold them."""
        at = F.col("_k") - F.col("_before")
        held = hist.where((at < F.col("_end")) & (at >= F.col("_end") - F.col("_c"))).select(
            *keys, "_n", "_i", "_pos", "_k", (F.col("_before") + F.col("_end") - F.col("_c")).alias("_before"),
            F.col("_next").alias("_bin"), "_lo", "_hi",
        )
        return materialize(held, "quantile-ranks")

    def running(by_bins: Sequence[str]) -> Column:
        return F.sum("_c").over(Window.partitionBy(*by_bins).orderBy("_next").rowsBetween(Window.unboundedPreceding, 0))

    # rows without a value are a bin of their own, so that every group is there
    first = materialize(histogram(data, keys, SHIFTS[0]), "quantile-bins")
    stats = first.groupBy(*keys).agg(F.sum(F.when(F.col("_next").isNotNull(), F.col("_c")).otherwise(0)).alias("_n"))
    counted = first.where(F.col("_next").isNotNull()).withColumns({"_end": running(keys), "_n": F.sum("_c").over(Window.partitionBy(*keys))})
    # floor and ceil of p * (n - 1) for every prob
    probed = F.array(*[F.struct(F.lit(i).alias("_i"), F.lit(float(p)).alias("_prob")) for i, p in enumerate(probs)])
    ranks = counted.withColumn("_p", F.explode(probed)).select("*", "_p._i", (F.col("_p._prob") * (F.col("_n") - 1)).alias("_pos"))
    ends = F.array_distinct(F.array(F.floor("_pos").cast("long"), F.ceil("_pos").cast("long")))
    inside = holding(ranks.withColumns({"_k": F.explode(ends), "_before": F.lit(0).cast("long")}))
    found = inside.where("_lo >= _hi")
    bins = [*keys, "_bin"]
    for before, shift in zip(SHIFTS, SHIFTS[1:]):
        targets = inside.where("_lo < _hi")
        if not targets.limit(1).count():
            break
        # the values of the open bins, for the passes that are left
        held = targets.select(*bins).distinct()
        data = matched(data.where(F.col("_bits").isNotNull()).withColumn("_bin", F.shiftright("_bits", before)), held, bins)
        if before == SHIFTS[0]:
            data = materialize(data, "quantile-values")
        hist = histogram(data, bins, shift).withColumn("_end", running(bins))
        inside = holding(matched(hist, targets.drop("_lo", "_hi"), bins))
        found = found.unionByName(inside.where("_lo >= _hi"))

    picked = found.withColumn("_v", F.col("_lo"))
    lo = F.floor("_pos").cast("long")
    per_prob = picked.groupBy(*keys, "_n", "_i", "_pos").agg(
        F.max(F.when(F.col("_k") == lo, F.col("_v"))).alias("_vlo"),
        F.max(F.when(F.col("_k") == F.ceil("_pos").cast("long"), F.col("_v"))).alias("_vhi"),
    )
    frac = F.col("_pos") - F.floor("_pos")
    interp: Column = F.when((frac == 0) | (F.col("_vlo") == F.col("_vhi")), F.col("_vlo")).otherwise(
        (F.lit(1.0) - frac) * F.col("_vlo") + frac * F.col("_vhi")
    )
    wide = per_prob.groupBy(*keys, "_n").agg(
        *[F.max(F.when(F.col("_i") == i, interp)).alias(_q_name(p)) for i, p in enumerate(probs)]
    )
    # groups with no non-NULL value still get a row (NULL quantiles)
    same = [F.col(c).eqNullSafe(F.col(f"_r{c}")) for c in keys]
    out = stats.join(wide.drop("_n").withColumnsRenamed({c: f"_r{c}" for c in keys}), reduce(Column.__and__, same), "left")
    return out.select(*by, F.col("_col").alias("column"), F.col("_n").alias("n"), *[_q_name(p) for p in probs])


def exact_median_row(df: DataFrame, values: Sequence[str]) -> DataFrame:
    """One row with the exact median of each column (NULL when no value)."""
    q = exact_quantiles(df, values, [0.5])
    return q.groupBy().pivot("column", list(values)).agg(F.first(_q_name(0.5)))
