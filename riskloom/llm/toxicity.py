"""Toxicity by FTRL-proximal logistic regression (operator 3).

Features are the distinct hashes of a text's words, word bigrams and skip-grams
(pairs with one word between), lower case, in ``2 ** HASH_BITS`` slots, and a bias.
FTRL-proximal keeps two numbers for each slot, z and n; a slot's learning rate
falls with its own gradients, and L1 holds weights at exactly zero until the
evidence passes a threshold, so the scoring weights are a short list.

Learning takes up to ``SAMPLE_ROWS`` labelled rows (the smallest hashes of their
ids).  They are dealt to ``SHARDS`` groups; in each of ``ROUNDS`` rounds every group
runs over its own rows from the shared state, and Spark averages the states by
slot.  After a round only the bias and the slots whose z is beyond a quarter of L1 are handed on; a
slot below has weight zero and starts anew, which bounds the states.  Every text is scored, whole.

Defined results: NULL text counts as empty and is scored from the bias alone;
NULL or repeated labels: a row with a label other than 0 and 1 is not learned
from, and of several labels of an id the largest counts; without any learning row
every score is 0.5 from no evidence, reported as 0 (``predicted`` 0); repeated rows
are scored each, and learned from once; other columns are ignored; an empty table gives no row.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from riskloom.llm.common import exactly, held_out, rows_of, ship_package, store, worker_state

HASH_BITS = 20
#: Labelled rows that are learned from; bounds the model's cost, not what is scored.
SAMPLE_ROWS = 24_000
SHARDS = 4
ROUNDS = 5
ALPHA, BETA, L1, L2 = 1.0, 1.0, 2.0, 0.1
CACHE_ENTRIES = 500_000

WORD = re.compile(r"\w+")
SLOTS = 1 << HASH_BITS
BIAS = SLOTS  # the slot after the hashed ones

# Odd multipliers that mix two word hashes.
_MIX = tuple(np.uint64(m) for m in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9))
_SHIFT = np.uint64(64 - HASH_BITS)


class _WordHashes(dict):
    """64-bit hashes of words, computed once while they are kept."""

    def __missing__(self, word: str) -> int:
        if len(self) >= CACHE_ENTRIES:
            self.clear()
        value = self[word] = xxhash.xxh64_intdigest(word.encode("utf-8", "surrogatepass"), 7)
        return value


_hashes = _WordHashes()


def slots_of(text: str | None) -> np.ndarray:
    """Slots of a text's features, repeats included, without the bias."""
    words = WORD.findall((text or "").lower())
    h = np.fromiter(map(_hashes.__getitem__, words), dtype=np.uint64, count=len(words))
    a = h * _MIX[0]
    mixed = [a, a[:-1] + h[1:] * _MIX[1], a[:-2] + h[2:] * _MIX[2]]
    return np.concatenate([((m ^ (m >> np.uint64(29))) * _MIX[0]) >> _SHIFT for m in mixed]).astype(np.int64)


class Ftrl:
    """FTRL-proximal state of the slots that were touched."""

    def __init__(self, z: np.ndarray, n: np.ndarray):
        self.z, self.n = z, n

    def weights(self, slots: np.ndarray) -> np.ndarray:
        z, n = self.z[slots], self.n[slots]
        free = np.abs(z) - L1
        return np.where(free > 0, -np.sign(z) * free / ((BETA + np.sqrt(n)) / ALPHA + L2), 0.0)

    def learn(self, slots: np.ndarray, label: float, weight: float = 1.0) -> None:
        w = self.weights(slots)
        p = 1.0 / (1.0 + np.exp(-np.clip(w.sum(), -35, 35)))
        g = (p - label) * weight
        n = self.n[slots]
        grown = n + g * g
        self.z[slots] += g - (np.sqrt(grown) - np.sqrt(n)) / ALPHA * w
        self.n[slots] = grown


class Weights(NamedTuple):
    """Slots with a weight other than zero, the bias last if it has one."""

    slots: np.ndarray
    values: np.ndarray


def learning_rows(docs: DataFrame, labels: DataFrame, column: str, sample_rows: int) -> DataFrame:
    """(doc_id, text, label) of the labelled rows that are learned from: at most ``sample_rows``,
    one for each text of an id, however often ids and rows repeat."""
    known = labels.select(F.col("doc_id").cast("long"), F.col(column).cast("int").alias("label")).where(
        ~held_out(F.col("doc_id"), 5, 0) & F.col("label").isin(0, 1)
    )
    one = known.groupBy("doc_id").agg(F.max("label").alias("label"))
    chosen = one.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample_rows)
    # at most ``sample_rows`` rows of numbers are broadcast, here and below
    rows = exactly(docs, "doc_id", "text").select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.xxhash64("text").alias("_text"))
    own = rows.join(F.broadcast(chosen), "doc_id")
    kept = own.select("doc_id", "_text").distinct().orderBy(F.xxhash64("doc_id"), "doc_id", "_text").limit(sample_rows)
    return own.join(F.broadcast(kept), ["doc_id", "_text"]).dropDuplicates(["doc_id", "_text"]).drop("_text")


def _round(shared):
    """One run over a shard's rows from the shared state."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        touched, z0, n0 = shared.value
        z, n = np.zeros(SLOTS + 1), np.zeros(SLOTS + 1)
        z[touched], n[touched] = z0, n0
        state = Ftrl(z, n)
        pdf = pdf.sort_values("doc_id")
        for slots, label in zip(pdf["slots"], pdf["label"]):
            state.learn(np.append(np.frombuffer(slots, dtype=np.int32), BIAS), float(label))
        # a slot whose z is far under L1 has weight zero and little evidence: it starts anew
        own = np.append(np.flatnonzero(np.abs(z[:BIAS]) > L1 / 4), BIAS)
        return pd.DataFrame({"slot": own.astype(np.int32), "z": z[own].astype(np.float32), "n": n[own].astype(np.float32)})

    return run


def learn(docs: DataFrame, labels: DataFrame, column: str = "toxic", sample_rows: int = SAMPLE_ROWS, rounds: int = ROUNDS) -> Weights:
    """Weights learned from the labelled rows; what reaches the driver is the state
    of the slots, at most ``2 ** HASH_BITS`` of them."""
    spark = docs.sparkSession
    ship_package(spark)
    rows = learning_rows(docs, labels, column, sample_rows)

    def featurise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, texts, ys in rows_of(batches, "doc_id", "text", "label"):
            slots = [np.unique(slots_of(t)).astype(np.int32) for t in texts]
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array([s.tobytes() for s in slots], pa.binary()), pa.array(ys, pa.int32())], ["doc_id", "slots", "label"]
            )

    stored = store(rows.mapInArrow(featurise, "doc_id long, slots binary, label int"), "op3-rows")
    z, n = np.zeros(SLOTS + 1), np.zeros(SLOTS + 1)
    for _ in range(rounds):
        touched = np.flatnonzero(n)
        shared = spark.sparkContext.broadcast((touched, z[touched], n[touched]))

        groups = stored.groupBy(F.pmod(F.xxhash64("doc_id", F.lit(1)), F.lit(SHARDS)).alias("shard"))
        states = groups.applyInPandas(_round(shared), "slot int, z float, n float")
        merged = states.groupBy("slot").agg(F.sum("z").alias("z"), F.sum("n").alias("n"))
        live = store(merged, "op3-state").toPandas()
        z, n = np.zeros(SLOTS + 1), np.zeros(SLOTS + 1)
        # a slot that a shard did not touch counts as unchanged at zero there
        z[live["slot"]], n[live["slot"]] = live["z"] / SHARDS, live["n"] / SHARDS
    every = np.arange(SLOTS + 1)
    w = Ftrl(z, n).weights(every)
    keep = np.flatnonzero(w)
    return Weights(keep, w[keep])


class Scorer:
    def __init__(self, weights: Weights):
        self.dense = np.zeros(SLOTS + 1, dtype=np.float32)
        self.dense[weights.slots] = weights.values
        self.known = len(weights.slots) > 0

    def score(self, text: str | None) -> float:
        if not self.known:
            return 0.0
        slots = slots_of(text)
        w = self.dense[slots]
        live = np.unique(slots[w != 0])
        total = float(self.dense[live].sum() + self.dense[BIAS])
        return float(1.0 / (1.0 + np.exp(-np.clip(total, -35, 35))))


def score(spark: SparkSession, weights: Weights, text: Column) -> Column:
    """Probability that a text is toxic."""
    shared = spark.sparkContext.broadcast(weights)
    number = shared._jbroadcast.id()

    @pandas_udf("double")
    def run(texts: pd.Series) -> pd.Series:
        scorer = worker_state(("toxicity", number), lambda: Scorer(shared.value))
        return pd.Series([scorer.score(t) for t in texts], dtype="float64")

    return run(text)


def toxicity(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """doc_id, held_out, score and predicted (score of 0.5 or more) of every row."""
    weights = learn(docs, labels, "toxic", sample_rows)
    scored = exactly(docs, "doc_id", "text").select(F.col("doc_id").cast("long"), score(docs.sparkSession, weights, F.col("text")).alias("score"))
    return scored.select("doc_id", held_out(F.col("doc_id"), 5, 0).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
