"""Connected components of a table of links, by alternating stars.

Each round first links every node's larger neighbours to the smallest node it
knows (large star), then every node and its smaller neighbours to the smallest
of them (small star).  Rounds end when a round changes nothing; the number of
rounds grows with the logarithm of the longest chain.  All steps are grouped
minimums and joins; each round is stored, so lineage stays short.

Defined results: repeated links and links of a node to itself change nothing; a link with a NULL
end is left out; other columns are ignored; a table without links gives no row.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.llm.common import store


def _signature(links: DataFrame) -> tuple:
    r = links.agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("s"),
    ).first()
    return r.n, r.s


def connected_components(links: DataFrame, u: str, v: str) -> DataFrame:
    """(node, root) of every node that has a link to another: ``root`` is the
    smallest node of its component."""
    a, b = F.col(u), F.col(v)
    pairs = links.where(a != b).select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct()
    pairs = store(pairs, "components")
    before = _signature(pairs)
    while before[0]:
        both = pairs.unionByName(pairs.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        smallest = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(smallest, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        pairs = store(small.unionByName(smallest.select("u", F.col("m").alias("v"))).distinct(), "components")
        after = _signature(pairs)
        if after == before:
            break
        before = after
    stars = pairs.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return stars.unionByName(stars.select(F.col("root").alias("node"), "root").distinct())
