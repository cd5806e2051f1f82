"""Mixing sources to target weights by hash-threshold histograms (operator 13).

A text's size is its number of words ``[^\\x20\\x09-\\x0D]+``.  The sources, by code point
and NULL last, get the weights in turn and share the size of all documents; a target
stops at ``most`` times its source's size, and what is left over goes to the others by
weight until no target is above (``water_level``).

A source whose target is q times its size and a rest takes every document q times, and
some once more.  Which ones is told by a 60-bit hash of id and text: the source's
documents in the order of their hashes are taken until the rest is used up.  The order is
never sorted.  Sizes are summed by source and the first 12 bits of the hash; running
sums over these buckets show the one that holds the budget's end; only its rows
are looked at again, by the next 12 bits, until the bucket is one hash.  What lies below
that hash is taken, a plain filter.  A larger budget takes what a smaller one takes and more.

The hash at the budget's end is taken if this comes nearer to the target: a source misses
its target by half of one document at most.  Rows with one id and one text share a hash; as
many of them as come nearest are taken, counted off partition by partition, so that no task
sees them all.

Defined results: NULL text has size 0, as has a text without a word, and is taken 0 times
its size; a source without words has the target 0; NULL is a source of its own, the last,
and differs from ''; repeated rows count each; a NULL id is hashed as empty; other
columns are ignored; an empty table gives no row.  Nothing depends on the layout of the
table, but for which of equal rows are taken.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskloom.llm.common import exactly, same, store

#: Bits of the hash, and how many of them are read at a time.
HASH_BITS = 60
STEP_BITS = 12
#: Parts that a source is split into where its targets are joined to its documents.
SALTS = 16
WORD = r"[^\x20\x09-\x0D]+"


def order_hash(doc_id: Column, text: Column) -> Column:
    """60 bits of the md5 of id and text, as a long."""
    key = F.concat_ws("\n", F.coalesce(doc_id.cast("string"), F.lit("")), F.coalesce(text, F.lit("")))
    return F.conv(F.substring(F.md5(key), 1, HASH_BITS // 4), 16, 10).cast("long")


def sized(docs: DataFrame) -> DataFrame:
    """doc_id, source, size and hash ``h`` of every row, and the number ``part`` of the
    stored partition that it lies in."""
    rows = exactly(docs, "doc_id", "text", "source")
    size = F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long")
    return rows.select(
        F.col("doc_id").cast("long").alias("doc_id"), "source", size.alias("size"), order_hash(F.col("doc_id"), F.col("text")).alias("h"),
        F.spark_partition_id().alias("part"),
    )


def weighted(rows: DataFrame, weights: Sequence[int]) -> DataFrame:
    """source, source_size and weight of every source.

    Sources are numbered by ranges: each range counts its own on top of the ranges below."""
    sums = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    dealt = store(sums.repartitionByRange(F.col("source").asc_nulls_last()).withColumn("range", F.spark_partition_id()), "op13-sources")
    lower = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)  # over one row of each range
    below = dealt.groupBy("range").agg(F.count(F.lit(1)).alias("n")).select("range", F.coalesce(F.sum("n").over(lower), F.lit(0)).alias("below"))
    inside = dealt.withColumn("i", F.row_number().over(Window.partitionBy("range").orderBy(F.col("source").asc_nulls_last())) - 1)
    turn = F.pmod(F.col("i") + F.col("below"), F.lit(len(weights)))
    weight = F.element_at(F.array(*[F.lit(int(w)) for w in weights]), (turn + 1).cast("int"))
    return inside.join(below, "range").select("source", "source_size", weight.cast("long").alias("weight"))


class Level(NamedTuple):
    """Words for each unit of weight, ``words / units``."""

    words: int
    units: int


def _limited(level: Level, most: int) -> Column:
    """The source's limit lies below its share at this level (exact)."""
    limit = F.col("source_size").cast("decimal(19,0)") * F.lit(most * level.units).cast("decimal(19,0)")
    return limit < F.col("weight").cast("decimal(19,0)") * F.lit(level.words).cast("decimal(19,0)")


def water_level(sources: DataFrame, most: int) -> Level:
    """The level at which sources that stop at their limits and shares of the others make
    up all sizes.  Each round reshares what limited sources leave; two numbers of a
    round reach the driver."""
    got = sources.agg(F.sum("source_size").alias("words"), F.sum("weight").alias("units")).first()
    total = got["words"] or 0
    level = Level(total, got["units"] or 1)
    while True:
        low = _limited(level, most)
        got = sources.agg(
            F.coalesce(F.sum(F.when(low, F.col("source_size") * most)), F.lit(0)).alias("fixed"),
            F.coalesce(F.sum(F.when(~low, F.col("weight"))), F.lit(1)).alias("units"),
        ).first()
        reshared = Level(total - got["fixed"], got["units"])
        if reshared == level:
            return level
        level = reshared


def budgets(sources: DataFrame, most: int) -> DataFrame:
    """source, source_size, target, and its whole number of takes ``whole`` with the words
    ``need`` beyond them."""
    level = water_level(sources, most)
    low = _limited(level, most)
    share = F.col("weight").cast("decimal(19,0)") * F.lit(level.words).cast("decimal(19,0)")
    target = F.when(low, (F.col("source_size") * most).cast("double")).otherwise(share.cast("double") / F.lit(float(level.units)))
    words = F.when(low, F.col("source_size") * most).otherwise(F.round(target).cast("long"))
    words = F.least(words, F.col("source_size") * most)
    out = sources.withColumn("target", target).withColumn("words", words)
    whole = F.when(F.col("source_size") > 0, F.expr("words div source_size")).otherwise(F.lit(0))
    out = out.withColumn("whole", whole.cast("long"))
    return out.select("source", "source_size", "target", "whole", (F.col("words") - F.col("whole") * F.col("source_size")).alias("need"))


def thresholds(rows: DataFrame, targets: DataFrame) -> DataFrame:
    """source, the hash ``cut`` at which its budget ends, the words ``rest`` still needed
    there, and the number ``ties`` and size ``tie_size`` of the rows with this hash."""
    open_ = targets.where("need > 0").select("source", F.col("need").alias("rest"), F.lit(0).cast("long").alias("prefix"))
    inside = rows.where("size > 0").select("source", "size", "h")
    for shift in range(HASH_BITS - STEP_BITS, -1, -STEP_BITS):
        bucket = F.shiftright("h", shift)
        sums = inside.groupBy("source", bucket.alias("bucket")).agg(
            F.sum("size").alias("size"), F.count(F.lit(1)).alias("n"), F.min("size").alias("tie_size")
        )
        open_ = open_.withColumnRenamed("source", "_source")
        held = sums.join(open_, same(F.col("source"), F.col("_source"))).drop("_source")
        order = Window.partitionBy("source").orderBy("bucket")  # at most 2 ** STEP_BITS rows of a source
        held = held.withColumn("run", F.sum("size").over(order.rowsBetween(Window.unboundedPreceding, 0)))
        at_end = (F.col("run") >= F.col("rest")) & (F.col("run") - F.col("size") < F.col("rest"))
        ends = held.where(at_end).select(
            "source", F.col("bucket").alias("prefix"), (F.col("rest") - F.col("run") + F.col("size")).alias("rest"), F.col("n").alias("ties"), "tie_size"
        )
        found = store(ends, "op13-ends")
        open_ = found.select("source", "rest", "prefix")
        if shift:
            edge = found.select(F.col("source").alias("_source"), F.col("prefix").alias("_prefix"))
            inside = store(
                inside.join(edge, same(F.col("source"), F.col("_source")) & (bucket == F.col("_prefix"))).select("source", "size", "h"), "op13-edge"
            )
    return found.select("source", F.col("prefix").alias("cut"), "rest", "ties", "tie_size")


def mix(docs: DataFrame, weights: Sequence[int] = (1, 2, 3), most: int = 3) -> DataFrame:
    """doc_id, size, source_size, target, times (how often the document is taken) and
    taken (its words, repeats counted) of every row.

    ``weights`` are positive integers; ``most`` of at least 1 bounds a target by so many
    times its source's size, and so how often a document is taken."""
    if most < 1 or not weights or min(weights) < 1:
        raise ValueError("weights are positive, and most is at least 1")
    rows = store(sized(docs), "op13-rows")
    targets = store(budgets(weighted(rows, weights), most), "op13-targets")
    cuts = thresholds(rows, targets).withColumnRenamed("source", "_source")
    plan = targets.join(cuts, same(F.col("source"), F.col("_source")), "left").drop("_source").withColumnRenamed("source", "_source")
    plan = plan.withColumn("_salt", F.explode(F.array(*[F.lit(k) for k in range(SALTS)])))
    salted = rows.withColumn("_salt", F.pmod("h", F.lit(SALTS)).cast("int"))
    joined = salted.join(plan, (salted["_salt"] == plan["_salt"]) & same(F.col("source"), F.col("_source"))).drop("_salt", "_source")
    # as many rows of the last hash as come nearest
    joined = joined.withColumn("last", F.coalesce(F.col("h") == F.col("cut"), F.lit(False)))
    few = F.expr("(2 * rest + tie_size) div (2 * tie_size)")
    one = F.col("last") & (F.col("ties") == 1)
    plain = joined.where(~F.col("last") | (F.col("ties") == 1))
    plain = plain.withColumn("extra", F.when(one, few).when(F.col("h") < F.col("cut"), 1).otherwise(0))
    tied = joined.where(F.col("last") & (F.col("ties") > 1))
    counts = tied.groupBy("source", "part").agg(F.count(F.lit(1)).alias("n"))
    lower = Window.partitionBy("source").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.select(F.col("source").alias("_source"), F.col("part").alias("_part"), F.coalesce(F.sum("n").over(lower), F.lit(0)).alias("below"))
    numbered = tied.withColumn("i", F.row_number().over(Window.partitionBy("source", "part").orderBy("doc_id")))
    numbered = numbered.join(counts, same(F.col("source"), F.col("_source")) & (F.col("part") == F.col("_part")))
    numbered = numbered.withColumn("extra", F.when(F.col("i") + F.col("below") <= few, 1).otherwise(0))
    columns = ["doc_id", "size", "source_size", "target", (F.col("whole") + F.col("extra")).alias("times")]
    out = plain.select(*columns).unionByName(numbered.select(*columns))
    return out.withColumn("taken", F.col("times") * F.col("size"))
