"""Exact deduplication by composable polynomial fingerprints (operator 10).

A text is normalised by deleting ASCII white space; what is left is a byte
string b_0 .. b_(n-1).  Its fingerprint is the pair of polynomial values

    H_j(b) = sum (b_i + 1) * BASE_j ** (n - 1 - i)  mod  PRIME_j

with its length.  The fingerprint of a concatenation follows from those of its
parts by a length-shifted sum, ``H(x + y) = H(x) * BASE ** |y| + H(y)``, so the
chunks of one huge document are hashed by different tasks and combined.

Equal fingerprints are candidates only: rows of a fingerprint are brought
together, sorted, and compared chunk by chunk as a stream.  A fingerprint that
holds more than a thousandth of all rows is first dealt out over salts (there
are at most a thousand such fingerprints, whatever the input), each salt
compares its own rows, and one text of each salt is compared in a second step.

Defined results: NULL text counts as empty; all texts without a visible
character are equal; a NULL id loses ties against any id (it sorts last);
repeated rows are separate rows of one group; an empty table gives no row; other
columns of the input are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.llm.common import exactly, partitions, rows_of, same, ship_package, store, whole_rows

# Two primes under 2**31 and a base for each; byte products and
# sums of a chunk then stay under 2**63.
PRIMES = (2147483647, 2147483629)
BASES = (1000003, 998244353)
#: Bytes of a chunk in hashing and comparing.
CHUNK = 1 << 16
#: Characters from which a document is cut and hashed by several tasks.
HUGE_CHARS = 1 << 24
#: Characters of a piece of such a document.
PIECE_CHARS = 1 << 22
#: A fingerprint with more than 1/HEAVY of all rows is salted.
HEAVY = 1000

WHITE = bytes([0x20, *range(0x09, 0x0E)])
SHORT = 64

_powers: dict[int, np.ndarray] = {}


def _power_table(j: int) -> np.ndarray:
    """BASES[j] ** i mod PRIMES[j] for i below CHUNK."""
    if j not in _powers:
        table = np.ones(1, dtype=np.uint64)
        step = BASES[j]
        while len(table) < CHUNK:  # doubling: the second half is the first, shifted
            table = np.concatenate([table, table * np.uint64(step) % np.uint64(PRIMES[j])])
            step = step * step % PRIMES[j]
        _powers[j] = table
    return _powers[j]


def normalise(text: str | None) -> bytes:
    """UTF-8 of the text without ASCII white space."""
    return (text or "").encode("utf-8", "surrogatepass").translate(None, WHITE)


def combine(left: tuple[int, int, int], right: tuple[int, int, int]) -> tuple[int, int, int]:
    """Fingerprint (H_0, H_1, length) of a concatenation."""
    n = right[2]
    return tuple((left[j] * pow(BASES[j], n, PRIMES[j]) + right[j]) % PRIMES[j] for j in (0, 1)) + (left[2] + n,)


def fingerprint(data: bytes) -> tuple[int, int, int]:
    """Fingerprint (H_0, H_1, length), chunk by chunk."""
    out = (0, 0, 0)
    codes = np.frombuffer(data, dtype=np.uint8)
    for at in range(0, len(codes), CHUNK):
        part = codes[at : at + CHUNK].astype(np.uint64) + np.uint64(1)
        # each product is under 2**40 and there are 2**16 of them
        own = tuple(int((part * _power_table(j)[len(part) - 1 :: -1]).sum() % np.uint64(PRIMES[j])) for j in (0, 1))
        out = combine(out, (*own, len(part))) if at else (*own, len(part))
    return out


def _hash_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(doc_id, text) to (doc_id, text, h0, h1, n)."""
    for batch in batches:
        prints = [fingerprint(normalise(t)) for (ts,) in rows_of([batch], "text") for t in ts]
        cols = [pa.array([p[k] for p in prints], pa.int64()) for k in range(3)]
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("text"), *cols], ["doc_id", "text", "h0", "h1", "n"])


def _print_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for (texts,) in rows_of(batches, "text"):
        prints = [fingerprint(normalise(t)) for t in texts]
        yield pa.RecordBatch.from_arrays([pa.array([p[k] for p in prints], pa.int64()) for k in range(3)], ["h0", "h1", "n"])


def _piece_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(row, k, piece) to (row, k, h0, h1, n, shift0, shift1)."""
    for rows, ks, pieces in rows_of(batches, "row", "k", "piece"):
        prints = [fingerprint(normalise(t)) for t in pieces]
        shifts = [[pow(BASES[j], p[2], PRIMES[j]) for p in prints] for j in (0, 1)]
        yield pa.RecordBatch.from_arrays(
            [pa.array(rows, pa.string()), pa.array(ks, pa.int32()), *(pa.array([p[k] for p in prints], pa.int64()) for k in range(3)), *(pa.array(s, pa.int64()) for s in shifts)],
            ["row", "k", "h0", "h1", "n", "shift0", "shift1"],
        )


def huge_fingerprints(docs: DataFrame, huge_chars: int = HUGE_CHARS, piece_chars: int = PIECE_CHARS) -> DataFrame:
    """(doc_id, text, h0, h1, n) of documents longer than ``huge_chars``: their
    pieces are hashed by different tasks and combined in order."""
    huge = docs.where(F.length("text") > huge_chars).withColumn("row", F.sha2("text", 256))
    pieces = huge.select(
        "row", F.explode(F.sequence(F.lit(0), F.floor((F.length("text") - 1) / piece_chars).cast("int"))).alias("k"), "text"
    ).select("row", "k", F.expr(f"substring(text, k * {piece_chars} + 1, {piece_chars})").alias("piece"))
    hashed = pieces.repartition(partitions(docs.sparkSession), "row", "k").mapInArrow(
        _piece_batches, "row string, k int, h0 long, h1 long, n long, shift0 long, shift1 long"
    )
    parts = hashed.dropDuplicates(["row", "k"]).groupBy("row").agg(
        F.sort_array(F.collect_list(F.struct("k", "h0", "h1", "n", "shift0", "shift1"))).alias("p")
    )
    fold = lambda j: F.aggregate(
        "p", F.lit(0).cast("long"), lambda acc, x: (acc * x[f"shift{j}"] + x[f"h{j}"]) % F.lit(PRIMES[j])
    )
    total = F.aggregate("p", F.lit(0).cast("long"), lambda acc, x: acc + x["n"])
    combined = parts.select("row", fold(0).alias("h0"), fold(1).alias("h1"), total.alias("n"))
    return huge.join(combined, "row").select("doc_id", "text", "h0", "h1", "n")


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by (h0, h1, n, salt): number the different texts of each run.

    Only the first text of each class is held; with good fingerprints a run has
    one.  The first row of each class of a salted run carries its text on."""
    key, classes = None, []
    for ids, texts, h0, h1, n, salts, salted in rows_of(batches, "doc_id", "text", "h0", "h1", "n", "salt", "salted"):
        out = {k: [] for k in ("class", "n_chars", "sha", "text")}
        for row in zip(texts, h0, h1, n, salts, salted):
            if row[1:5] != key:
                key, classes = row[1:5], []
            data = normalise(row[0])
            number = next((i for i, (seen, _) in enumerate(classes) if _equal(seen, data)), None)
            new = number is None
            if new:
                number = len(classes)
                classes.append((data, hashlib.sha256(data).hexdigest()))
            out["class"].append(number)
            out["n_chars"].append(len(row[0] or ""))
            out["sha"].append(classes[number][1])
            out["text"].append(row[0] or "" if new and row[5] else None)
        yield pa.RecordBatch.from_arrays(
            [pa.array(ids, pa.int64()), *(pa.array(c, pa.int64()) for c in (h0, h1, n)), pa.array(salts, pa.int32()), pa.array(salted, pa.bool_()), pa.array(out["class"], pa.int32()), pa.array(out["n_chars"], pa.int64()), pa.array(out["sha"], pa.string()), pa.array(out["text"], pa.string())],
            ["doc_id", "h0", "h1", "n", "salt", "salted", "class", "n_chars", "sha", "text"],
        )


def _equal(a: bytes, b: bytes) -> bool:
    """Chunkwise comparison that ends at the first difference."""
    if len(a) != len(b):
        return False
    x, y = memoryview(a), memoryview(b)
    return all(x[i : i + CHUNK] == y[i : i + CHUNK] for i in range(0, len(a), CHUNK))


PRINT = ["h0", "h1", "n"]
CLASSED = "doc_id long, h0 long, h1 long, n long, salt int, salted boolean, class int, n_chars long, sha string, text string"


def exact_classes(docs: DataFrame, huge_chars: int = HUGE_CHARS, piece_chars: int = PIECE_CHARS, heavy: int = HEAVY) -> DataFrame:
    """One row for each row of ``docs``: doc_id, n_chars, sha, and the columns
    h0, h1, n, class which are equal for equal normalised texts only."""
    spark = docs.sparkSession
    ship_package(spark)
    docs = exactly(docs, "doc_id", "text").select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text"))
    small = docs.where(F.col("text").isNull() | (F.length("text") <= huge_chars))
    big = huge_fingerprints(docs, huge_chars, piece_chars)

    # how often each fingerprint occurs: narrow rows, summed before the shuffle
    prints = small.select("text").mapInArrow(_print_batches, "h0 long, h1 long, n long")
    counts = store(prints.unionByName(big.select(*PRINT)).groupBy(*PRINT).agg(F.count(F.lit(1)).alias("size")), "op10-counts")
    total = counts.agg(F.sum("size")).first()[0] or 0
    share = max(1, total // heavy)
    # at most ``heavy`` fingerprints have more than total / heavy rows
    hot = {(r.h0, r.h1, r.n): -(-r.size // share) for r in counts.where(F.col("size") > share).collect()} if total > heavy else {}

    hashed = small.mapInArrow(_hash_batches, "doc_id long, text string, h0 long, h1 long, n long").unionByName(big)
    salts = F.lit(1)
    if hot:
        table = F.create_map(*[x for k, v in hot.items() for x in (F.lit("{}_{}_{}".format(*k)), F.lit(v))])
        salts = F.coalesce(table[F.concat_ws("_", *PRINT)], F.lit(1))
    hashed = hashed.withColumn("salts", salts)
    dealt = hashed.select(
        "doc_id", "text", *PRINT,
        F.pmod(F.xxhash64("doc_id"), F.col("salts")).cast("int").alias("salt"),
        (F.col("salts") > 1).alias("salted"),
    )
    count = partitions(spark)
    classed = store(
        dealt.repartition(count, *PRINT, "salt").sortWithinPartitions(*PRINT, "salt").mapInArrow(_compare, CLASSED), "op10-classes"
    )
    if not hot:
        return classed.drop("text")
    # second step: one text of each salt of the heavy fingerprints (at most twice ``heavy`` rows when nothing collides)
    again = classed.where(F.col("salted") & F.col("text").isNotNull()).select(
        (F.col("salt").cast("long") * (1 << 31) + F.col("class")).alias("doc_id"), "text", *PRINT,
        F.lit(0).alias("salt"), F.lit(False).alias("salted"),
    )
    merged = again.repartition(count, *PRINT).sortWithinPartitions(*PRINT, "doc_id").mapInArrow(_compare, CLASSED).select(
        *PRINT, F.shiftright("doc_id", 31).cast("int").alias("salt"),
        (F.col("doc_id") % (1 << 31)).cast("int").alias("class"), F.col("class").alias("final"), F.lit(True).alias("salted"),
    )
    plain = classed.where(~F.col("salted")).drop("text")
    salted = classed.where("salted").drop("text").join(merged, [*PRINT, "salt", "class", "salted"])
    return plain.unionByName(salted.withColumn("class", F.col("final")).drop("final"))


def exact_dedup(docs: DataFrame, **options) -> DataFrame:
    """One row for each row of ``docs``: doc_id, keep_id, group_size, kept,
    text_sha256 and n_chars.  The row with the most code points stays, then the
    smallest id; rows that repeat it (same id, same length) show ``kept`` too."""
    rows = store(exact_classes(docs, **options), "op10-rows")
    group = [*PRINT, "class"]
    # (most code points, smallest id, NULL ids last)
    rank = F.struct((-F.col("n_chars")).alias("a"), F.col("doc_id").isNull().alias("b"), F.col("doc_id").alias("c"))
    best = rows.groupBy(*group).agg(F.min(rank).alias("best"), F.count(F.lit(1)).alias("group_size"))
    out = rows.join(best, group)
    return out.select(
        "doc_id",
        F.col("best.c").alias("keep_id"),
        "group_size",
        (same(F.col("doc_id"), F.col("best.c")) & (F.col("n_chars") == -F.col("best.a"))).alias("kept"),
        F.col("sha").alias("text_sha256"),
        "n_chars",
    )


@whole_rows
def keep_first(docs: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns.  Of rows that
    share id, normalised text and length one stays."""
    key = lambda doc_id, sha, n: F.concat_ws(" ", F.coalesce(doc_id.cast("string"), F.lit("null")), sha, n)
    rows = store(exact_dedup(docs, **options).where("kept").select("doc_id", "text_sha256", "n_chars"), "op10-kept")
    keep = rows.select(key(F.col("doc_id"), F.col("text_sha256"), F.col("n_chars")).alias("_keep"))
    text = F.coalesce("text", F.lit(""))
    own = docs.withColumn("_keep", key(F.col("doc_id").cast("long"), F.sha2(F.translate(text, WHITE.decode(), ""), 256), F.length(text)))
    return own.join(keep, "_keep", "left_semi").dropDuplicates(["_keep"]).drop("_keep")
