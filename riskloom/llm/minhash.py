"""Document fingerprints by one-permutation MinHash (operator 1).

Every shingle of ``SHINGLE`` words is hashed once.  The high bits of a hash choose
one of ``BINS`` bins, the rest is the value, and a bin keeps its smallest value.  An
empty bin borrows by optimal densification: it walks its own pseudo-random
sequence of bins, the same for all documents, to the first that is not
empty.  Of each bin ``LOW_BITS`` low-order bits are stored, packed to hexadecimal digits.

Two unequal bins agree in their low bits with probability C = 2 ** -LOW_BITS, so the
likeness is estimated as (matches / BINS - C) / (1 - C), within 0 and 1.

Defined results: words are what stands between white space, as written; a text
with fewer words than a shingle is one shingle; NULL text and text without a word have
the empty fingerprint, which is like itself (1) and like nothing else (0);
rows with the same id are ordered by a hash of their text, NULL ids come first; an only row is its own neighbour;
other columns are ignored; an empty table gives no row.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskloom.llm.common import exactly, partitions, rows_of, ship_package, store

SHINGLE = 5
BINS = 512
LOW_BITS = 4
CACHE_ENTRIES = 500_000

# Odd multipliers of the integer mixing steps.
_A, _B, _C = (np.uint64(m) for m in (0xBF58476D1CE4E5B9, 0x94D049BB133111EB, 0x9E3779B97F4A7C15))
_BIN_SHIFT = np.uint64(64 - BINS.bit_length() + 1)
_WALK = 64  # steps of the walks that are looked at together


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _A
    x = (x ^ (x >> np.uint64(27))) * _B
    return x ^ (x >> np.uint64(31))


class _WordHashes(dict):
    def __missing__(self, word: str) -> int:
        if len(self) >= CACHE_ENTRIES:
            self.clear()
        value = self[word] = xxhash.xxh64_intdigest(word.encode("utf-8", "surrogatepass"), 1)
        return value


_hashes = _WordHashes()


def shingle_hashes(text: str | None) -> np.ndarray:
    """Hashes of a text's shingles; none without a word."""
    words = (text or "").split()
    h = np.fromiter(map(_hashes.__getitem__, words), dtype=np.uint64, count=len(words))
    width = min(SHINGLE, len(words))
    if not width:
        return h
    total = np.zeros(len(h) - width + 1, dtype=np.uint64)
    for k in range(width):  # the order of the words counts
        total = total * _C + h[k : k + len(total)]
    return _mix(total)


def sketch(text: str | None) -> np.ndarray | None:
    """Low bits of the densified bins; None for a text without a word."""
    hashes = shingle_hashes(text)
    if not len(hashes):
        return None
    least = np.full(BINS, np.iinfo(np.uint64).max, dtype=np.uint64)
    where = (hashes >> _BIN_SHIFT).astype(np.int64)
    np.minimum.at(least, where, hashes)
    full = np.zeros(BINS, dtype=bool)
    full[where] = True
    source = np.arange(BINS)
    empty = np.flatnonzero(~full)
    if len(empty) == BINS - 1:
        source[:] = where[0]  # every walk ends at the only full bin
        empty = empty[:0]
    step = 0
    while len(empty):
        steps = np.arange(step, step + _WALK, dtype=np.uint64)
        walk = (_mix(empty.astype(np.uint64)[:, None] * _C + steps[None, :] + np.uint64(1)) >> _BIN_SHIFT).astype(np.int64)
        hit = full[walk]
        first = hit.argmax(axis=1)
        found = hit[np.arange(len(empty)), first]
        source[empty[found]] = walk[found, first[found]]
        empty = empty[~found]
        step += _WALK
    # mixed with the bin's own number, so that a value that many bins borrow does not
    # repeat the same chance match in each of them
    low = _mix(least[source] + np.arange(BINS, dtype=np.uint64) * _C)
    return (low & np.uint64((1 << LOW_BITS) - 1)).astype(np.uint8)


def packed(bins: np.ndarray | None) -> bytes:
    """The bins side by side; empty for a text without a word."""
    if bins is None:
        return b""
    bits = np.unpackbits(bins[:, None], axis=1, bitorder="big")[:, 8 - LOW_BITS :]
    return np.packbits(bits.ravel()).tobytes()


def pack(bins: np.ndarray | None) -> str:
    """Hexadecimal fingerprint; empty for a text without a word."""
    return packed(bins).hex()


def unpack(fingerprint: str) -> np.ndarray | None:
    """The bins of a fingerprint."""
    if not fingerprint:
        return None
    bits = np.unpackbits(np.frombuffer(bytes.fromhex(fingerprint), dtype=np.uint8)).reshape(BINS, LOW_BITS)
    return np.packbits(bits, axis=1, bitorder="big")[:, 0] >> np.uint8(8 - LOW_BITS)


def likeness(a: np.ndarray | None, b: np.ndarray | None) -> float:
    """Estimated share of common shingles, corrected for chance matches."""
    if a is None or b is None:
        return float(a is None and b is None)
    chance = 2.0**-LOW_BITS
    return float(min(1.0, max(0.0, (float((a == b).mean()) - chance) / (1.0 - chance))))


def edit(text: str, following: str) -> str:
    """The last half of a text (rounded down) replaced by the first as many code
    points of another, or all of it."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


_COLUMNS = "doc_id long, n_chars long, edited_sha256 string, fingerprint binary, edited_fingerprint binary, near_edited double, near_next double"


def _row(doc_id, text: str, own: np.ndarray | None, following: str, after: np.ndarray | None) -> tuple:
    edited = edit(text, following)
    bins = sketch(edited)
    sha = hashlib.sha256(edited.encode("utf-8", "surrogatepass")).hexdigest()
    return doc_id, len(text), sha, packed(own), packed(bins), likeness(own, bins), likeness(own, after)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)


_RESULT = pa.schema(
    [("doc_id", pa.int64()), ("n_chars", pa.int64()), ("edited_sha256", pa.string()), ("fingerprint", pa.binary()), ("edited_fingerprint", pa.binary()), ("near_edited", pa.float64()), ("near_next", pa.float64())]
)
_ENDS = pa.schema([*_RESULT, ("task", pa.int32()), ("first_text", pa.string()), ("last_text", pa.string())])


def _neighbours(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows in order: each is finished once the next is seen.  A task's last row is
    left open with its text, and its first text is given for the task before."""
    task = TaskContext.get().partitionId()
    held, first = None, None
    for ids, texts in rows_of(batches, "doc_id", "text"):
        out = []
        for doc_id, text in zip(ids, (t or "" for t in texts)):
            own = sketch(text)
            if held is None:
                first = text
            else:
                out.append((*_row(*held, text, own), None, None, None))
            held = (doc_id, text, own)
        if out:
            yield _batch(out, _ENDS)
    if held is not None:
        yield _batch([(held[0], None, None, None, None, None, None, task, first, held[1])], _ENDS)


def _open_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for ids, texts, following in rows_of(batches, "doc_id", "text", "following"):
        yield _batch([_row(i, t, sketch(t), f, sketch(f)) for i, t, f in zip(ids, texts, following)], _RESULT)


def fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id and the fingerprint of every row, without a shuffle."""
    ship_package(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, texts in rows_of(batches, "doc_id", "text"):
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array([pack(sketch(t)) for t in texts])], ["doc_id", "fingerprint"])

    return exactly(docs, "doc_id", "text").select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "doc_id long, fingerprint string")


def compare_with_next(docs: DataFrame) -> DataFrame:
    """Every row with its fingerprint, that of its edited text, and the likeness to
    that and to the next row's, in order of the ids.

    One range shuffle puts neighbours into one task; what meets across tasks is
    one row of each task, joined afterwards."""
    spark = docs.sparkSession
    ship_package(spark)
    # texts are no part of the range keys, of which Spark brings a sample to the driver
    keyed = exactly(docs, "doc_id", "text").select(F.col("doc_id").cast("long"), "text", F.xxhash64("text").alias("text_hash"))
    ordered = keyed.repartitionByRange(partitions(spark), "doc_id", "text_hash").sortWithinPartitions("doc_id", "text_hash", "text")
    ends = ", task int, first_text string, last_text string"
    rows = store(ordered.mapInArrow(_neighbours, _COLUMNS + ends), "op1-rows")
    done = rows.where(F.col("task").isNull()).drop("task", "first_text", "last_text")
    # a row for each task: the number of tasks, not of documents
    open_rows = rows.where(F.col("task").isNotNull()).select("doc_id", "task", "first_text", F.col("last_text").alias("text"))
    after = open_rows.select("task").withColumns(
        {"next_task": F.lead("task").over(Window.orderBy("task")), "first_task": F.min("task").over(Window.partitionBy())}
    ).select("task", F.coalesce("next_task", "first_task").alias("next_task"))
    heads = open_rows.select(F.col("task").alias("next_task"), F.col("first_text").alias("following")).hint("merge")
    joined = open_rows.drop("first_text").join(after, "task").join(heads, "next_task")
    every = done.unionByName(joined.select("doc_id", "text", "following").mapInArrow(_open_rows, _COLUMNS))
    return every.withColumns({c: F.lower(F.hex(c)) for c in ("fingerprint", "edited_fingerprint")})
