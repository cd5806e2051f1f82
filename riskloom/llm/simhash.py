"""SimHash near-duplicates by the generalised pigeonhole principle (operator 4).

A 64-bit fingerprint has a bit set if more than half of the text's shingle
hashes have it set.  Fingerprints link if they differ in at most ``max_bits``
bits.  The bits are grouped into parts, correlated bits together, and part i gets
a threshold t_i, from -1 (not searched) up, with

    sum (t_i + 1) = max_bits + 1:

two fingerprints within ``max_bits`` are then within t_i in some part.  A dynamic
program picks the thresholds with the least estimated work, from the number of
pairs that agree in each part (counted over all fingerprints) and the chance
of a further differing bit.  Each fingerprint is filed under its value in each
searched part and probes the values within t_i bits; what meets is verified on
all 64 bits.

Equal fingerprints are one node.  A value that more than ``BUCKET`` probes share
is not compared pair by pair: its members are filed again under themselves and
every fingerprint within half of ``max_bits`` (rounded up), where no value can have
more than a fixed number of members and every link meets.  Verified links are
reduced to a spanning forest of each group before they leave it; components of
all links are then found by distributed rounds.

Defined results: NULL text counts as empty; without a word the fingerprint is
zero and links like any other; repeated rows and ids share a fingerprint and a
component; a component whose ids are all NULL has the id NULL; other columns are
ignored; an empty table gives no row.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate, combinations
from math import comb
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.llm.common import exactly, partitions, rows_of, same, ship_package, store, whole_rows
from riskloom.llm.graph import connected_components

BITS = 64
SEED = 42
#: Members of a value that are compared pair by pair.
BUCKET = 2048
#: Numbers of parts that are tried.
PARTS = (1, 2, 3, 4)
#: Work of a filed or probing row, in verified pairs.
ROW_WORK = 50.0


def fingerprint(text: str | None, shingle: int) -> int:
    """SimHash of a whole text, unsigned."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = list(accumulate([len(w) + 1 for w in words]))
    starts = [0, *ends[:-1]]
    digest = xxhash.xxh64_intdigest
    if len(words) <= shingle:
        hashes = [digest(joined, SEED)]
    else:
        hashes = [digest(joined[a : b - 1], SEED) for a, b in zip(starts, ends[shingle - 1 :])]
    codes = np.array(hashes, dtype="<u8")
    counts = np.zeros(BITS, dtype=np.int64)
    for at in range(0, len(codes), 4096):
        part = codes[at : at + 4096]
        counts += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > len(codes), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, shingle: int) -> DataFrame:
    """doc_id, text_hash and the signed fingerprint ``fp`` of every row."""
    ship_package(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, texts, hashes in rows_of(batches, "doc_id", "text", "text_hash"):
            fp = np.array([fingerprint(t, shingle) for t in texts], dtype=np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(hashes, pa.int64()), pa.array(fp)], ["doc_id", "text_hash", "fp"])

    rows = exactly(docs, "doc_id", "text").select(F.col("doc_id").cast("long"), "text", F.xxhash64("text").alias("text_hash"))
    return rows.mapInArrow(run, "doc_id long, text_hash long, fp long")


class Plan(NamedTuple):
    """Bits of each part, its threshold, and the estimated work."""

    parts: list[list[int]]
    thresholds: list[int]
    work: float


def bit_statistics(nodes: DataFrame) -> tuple[int, np.ndarray]:
    """How many fingerprints there are, and how many have both bits i and j."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both, n = np.zeros((BITS, BITS)), 0
        for batch in batches:
            codes = batch.column("fp").to_numpy(zero_copy_only=False).astype("<i8")
            for at in range(0, len(codes), 65536):
                part = codes[at : at + 65536]
                ones = np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").astype(np.float32)
                both += ones.T @ ones
                n += len(part)
        flat = np.append(both.ravel(), n).astype(np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(flat)), pa.int32()), pa.array(flat)], ["i", "n"])

    got = nodes.select("fp").mapInArrow(run, "i int, n long").groupBy("i").agg(F.sum("n").alias("n")).toPandas()
    flat = np.zeros(BITS * BITS + 1)
    flat[got["i"]] = got["n"]
    return int(flat[-1]), flat[:-1].reshape(BITS, BITS)


def group_bits(correlation: np.ndarray, parts: int) -> list[list[int]]:
    """Parts of nearly equal width; each grows from its most correlated free pair
    by the bit most correlated with it."""
    free, out = set(range(BITS)), []
    for k in range(parts):
        width = BITS // parts + (k < BITS % parts)
        if width == len(free):
            out.append(sorted(free))
            break
        own = list(max(combinations(sorted(free), 2), key=lambda p: correlation[p])) if width > 1 else [min(free)]
        while len(own) < width:
            rest = sorted(free - set(own))
            own.append(rest[int(np.argmax(correlation[np.ix_(rest, own)].mean(axis=1)))])
        out.append(sorted(own))
        free -= set(own)
    return out


def mask_of(bits: list[int]) -> int:
    """The bits as a signed 64-bit number."""
    value = sum(1 << b for b in bits)
    return value - (1 << 64) if value >> 63 else value


def allocate(work: list[list[float]], max_bits: int) -> tuple[list[int], float]:
    """Thresholds (-1 and up, ``sum (t + 1) = max_bits + 1``) with the least total of
    ``work[part][t + 1]``, by dynamic programming over the parts."""
    best: dict[int, tuple[float, list[int]]] = {0: (0.0, [])}
    for costs in work:
        step: dict[int, tuple[float, list[int]]] = {}
        for spent, (total, chosen) in best.items():
            for units in range(max_bits + 2 - spent):
                found = (total + costs[units], [*chosen, units - 1])
                if spent + units not in step or found[0] < step[spent + units][0]:
                    step[spent + units] = found
        best = step
    total, thresholds = best[max_bits + 1]
    return thresholds, total


def make_plan(nodes: DataFrame, max_bits: int) -> Plan:
    """The parts and thresholds with the least estimated work."""
    n, both = bit_statistics(nodes)
    share = np.diag(both) / max(n, 1)
    spread = np.sqrt(np.maximum(share * (1 - share), 1e-12))
    correlation = np.abs((both / max(n, 1) - np.outer(share, share)) / np.outer(spread, spread))
    differ = 2 * share * (1 - share)  # chance that two fingerprints differ in a bit
    options = {p: group_bits(correlation, p) for p in PARTS}
    masks = {m: None for ps in options.values() for m in map(mask_of, ps)}
    # pairs that agree in a part, counted over all fingerprints
    keyed = nodes.select(F.explode(F.array(*[F.struct(F.lit(m).alias("mask"), F.col("fp").bitwiseAND(F.lit(m)).alias("key")) for m in masks])).alias("k"))
    agree = {
        r["mask"]: r["pairs"]
        for r in keyed.groupBy("k.mask", "k.key").agg(F.count(F.lit(1)).alias("c")).groupBy("mask")
        .agg(F.sum(F.col("c").cast("double") * (F.col("c") - 1) / 2).alias("pairs")).collect()
    }
    plans = []
    for parts in options.values():
        work = []
        for bits in parts:
            chance = np.zeros(max_bits + 2)  # of so many differing bits, if bits were independent
            chance[0] = 1.0
            for b in bits:
                chance[1:] = chance[1:] * (1 - differ[b]) + chance[:-1] * differ[b]
                chance[0] *= 1 - differ[b]
            costs = [0.0]
            for t in range(max_bits + 1):
                probes = sum(comb(len(bits), k) for k in range(t + 1))
                agreed = agree.get(mask_of(bits), 0.0)
                pairs = agreed + n * n / 2 * chance[1 : t + 1].sum()
                costs.append(pairs + ROW_WORK * n * probes)
            work.append(costs)
        thresholds, total = allocate(work, max_bits)
        plans.append(Plan(parts, thresholds, total))
    return min(plans, key=lambda p: p.work)


def flips(bits: list[int], radius: int) -> list[int]:
    """All masks of one to ``radius`` of the bits."""
    return [mask_of(list(c)) for k in range(1, radius + 1) for c in combinations(bits, k)]


def probes(nodes: DataFrame, plan: Plan) -> DataFrame:
    """(part, key, fp, own): every fingerprint filed under its own values (own) and
    under those that it probes."""
    entries = []
    for i, (bits, t) in enumerate(zip(plan.parts, plan.thresholds)):
        if t < 0:
            continue
        key = F.col("fp").bitwiseAND(F.lit(mask_of(bits)))
        for flip in [0, *flips(bits, t)]:
            entries.append(F.struct(F.lit(i).alias("part"), key.bitwiseXOR(F.lit(flip)).alias("key"), F.lit(flip == 0).alias("own")))
    return nodes.select("fp", F.explode(F.array(*entries)).alias("e")).select("e.part", "e.key", "fp", "e.own")


def link_runs(rows: DataFrame, max_bits: int) -> DataFrame:
    """Links (a, b) that span what is within ``max_bits`` in each (part, key)."""

    def links(fps: np.ndarray, own: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Each fingerprint with the first of its component in the group."""
        codes = fps.view(np.uint64)
        near = np.bitwise_count(codes[:, None] ^ codes[None, :]) <= max_bits
        near &= own[:, None] | own[None, :]
        label = np.arange(len(codes))
        while True:
            new = np.where(near, label[None, :], len(codes)).min(axis=1)
            new = np.minimum(new, label)
            new = new[new]
            if (new == label).all():
                break
            label = new
        far = label != np.arange(len(codes))
        return fps[far], fps[label[far]]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] | None = None
        a: list[np.ndarray] = []
        b: list[np.ndarray] = []

        def flush(part, key, fp, own, last: bool) -> list[np.ndarray] | None:
            """Handle whole runs; the last run may go on in the next batch."""
            new = np.flatnonzero((part[1:] != part[:-1]) | (key[1:] != key[:-1])) + 1
            bounds = [0, *new.tolist(), len(part)]
            spans = list(zip(bounds, bounds[1:]))
            rest = None if last else spans.pop()
            for x, y in spans:
                if y - x > 1:
                    p, q = links(fp[x:y], own[x:y])
                    if len(p):
                        a.append(p)
                        b.append(q)
            return None if rest is None else [c[rest[0] :] for c in (part, key, fp, own)]

        for batch in batches:
            if not batch.num_rows:
                continue
            now = [batch.column(c).to_numpy(zero_copy_only=False) for c in ("part", "key", "fp", "own")]
            if held is not None:
                now = [np.concatenate(x) for x in zip(held, now)]
            held = flush(*now, last=False)
            if a:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(a)), pa.array(np.concatenate(b))], ["a", "b"])
                a.clear(), b.clear()
        if held is not None:
            flush(*held, last=True)
            if a:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(a)), pa.array(np.concatenate(b))], ["a", "b"])

    dealt = rows.select("part", "key", "fp", "own").repartition(partitions(rows.sparkSession), "part", "key")
    return dealt.sortWithinPartitions("part", "key").mapInArrow(run, "a long, b long")


def near_links(nodes: DataFrame, max_bits: int, bucket: int = BUCKET) -> DataFrame:
    """Links (a, b) between fingerprints; their components are those of all pairs
    within ``max_bits``."""
    filed = probes(nodes, make_plan(nodes, max_bits))
    sizes = filed.groupBy("part", "key").agg(F.count(F.lit(1)).alias("n"), F.max("own").alias("any_own"))
    meets = store(filed.join(sizes.where("n > 1 and any_own"), ["part", "key"]).drop("any_own"), "op4-meets")
    small = meets.where(F.col("n") <= bucket).drop("n")
    # members of the others meet again where no value can have many members
    crowd = meets.where(F.col("n") > bucket).select("fp").distinct()
    around = [F.col("fp").bitwiseXOR(F.lit(flip)) for flip in [0, *flips(list(range(BITS)), (max_bits + 1) // 2)]]
    again = crowd.select(F.lit(-1).alias("part"), F.explode(F.array(*around)).alias("key"), "fp", F.lit(True).alias("own"))
    return link_runs(small, max_bits).unionByName(link_runs(again, max_bits))


def components(docs: DataFrame, shingle: int, max_bits: int, bucket: int = BUCKET) -> DataFrame:
    """One row for each row of ``docs``: doc_id, text_hash, fp, and the component's
    smallest doc_id ``component_id`` and first text hash under that id."""
    rows = store(fingerprints(docs, shingle), "op4-fingerprints")
    first = F.min(F.when(F.col("doc_id").isNotNull(), F.struct("doc_id", "text_hash")))
    nodes = store(rows.groupBy("fp").agg(first.alias("first")), "op4-nodes")
    roots = connected_components(near_links(nodes.select("fp"), max_bits, bucket), "a", "b")
    of = nodes.join(roots, nodes["fp"] == roots["node"], "left").select("fp", "first", F.coalesce("root", "fp").alias("root"))
    of = store(of, "op4-roots")
    best = of.groupBy("root").agg(F.min("first").alias("best"))
    named = of.join(best, "root").select("fp", F.col("best.doc_id").alias("component_id"), F.col("best.text_hash").alias("component_hash"))
    return rows.join(named, "fp").select("doc_id", "text_hash", "fp", "component_id", "component_hash")


def near_dedup(docs: DataFrame, shingle: int = 3, max_bits: int = 2, bucket: int = BUCKET) -> DataFrame:
    """doc_id, fingerprint (16 hex digits) and component_id of every row."""
    found = components(docs, shingle, max_bits, bucket)
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


@whole_rows
def keep_one(docs: DataFrame, shingle: int = 3, max_bits: int = 2, bucket: int = BUCKET) -> DataFrame:
    """One row of each component, with all columns: that of the smallest id.  Rows
    that all have the id NULL are kept."""
    found = components(docs, shingle, max_bits, bucket)
    keep = found.where(
        F.col("component_id").isNull()
        | (same(F.col("doc_id"), F.col("component_id")) & (F.col("text_hash") == F.col("component_hash")))
    )
    key = lambda text_hash: F.concat_ws(" ", F.coalesce(F.col("doc_id").cast("long").cast("string"), F.lit("null")), text_hash)
    keys = store(keep.select(key(F.col("text_hash")).alias("_keep")).distinct(), "op4-keep")
    own = docs.withColumn("_keep", key(F.xxhash64("text")))
    return own.join(keys, "_keep", "left_semi").dropDuplicates(["_keep"]).drop("_keep")
