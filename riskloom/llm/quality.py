"""Quality by nearest-neighbour voting in a latent-semantic space (operator 8).

A text is a bag of terms: lower-case words, runs of punctuation and the shapes of
its tokens (capitals, title case, digits, a repeated token and so on), hashed to ``SLOTS`` columns with
weight ``log(1 + count) * idf``, scaled so that words and shapes have fixed parts in
its length of one.  The inverse document
frequencies count every document.  A truncated singular value decomposition of up
to ``SAMPLE_ROWS`` labelled rows (the smallest hashes of their ids) gives the latent
directions; their labelled vectors, ``SAMPLE_ROWS x DIMENSIONS`` numbers, are
broadcast.  Each text is projected, its cosines with every labelled vector are
computed in blocks, and its ``NEIGHBOURS`` nearest vote with their similarities.

Defined results: NULL text counts as empty; a text without a term has no direction
and gets the share of label 1 among the learned rows; without learned rows every score is 0;
of several labels of an id the largest counts; labels other than 0 and 1 are
not learned from; repeated rows are scored each, and learned from once; other columns
are ignored; an empty table gives no row.
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

from riskloom.llm.common import exactly, held_out, rows_of, ship_package
from riskloom.llm.toxicity import learning_rows

#: Columns of hashed words, then of hashed shapes.
WORD_SLOTS, SHAPE_SLOTS = 3072, 1024
SLOTS = WORD_SLOTS + SHAPE_SLOTS
#: Part of a text's squared length that its shapes make up.
SHAPE_PART = 0.6
#: Labelled rows that are learned from; bounds the model's cost, not what is scored.
SAMPLE_ROWS = 4000
DIMENSIONS = 48
NEIGHBOURS = 15
#: Similarities are raised to this power before they vote.
SHARPNESS = 4
BLOCK = 256
CACHE_ENTRIES = 600_000

#: Slot of a token that repeats the one before it.
REPEATED = WORD_SLOTS
TOKEN = re.compile(r"\w+|[^\w\s]+")


def shape(token: str) -> str:
    """What a token looks like: its case or digits, or its first punctuation marks."""
    if not (token[0].isalnum() or token[0] == "_"):
        return token[:3]
    for name, test in (("digits", str.isdigit), ("capitals", str.isupper), ("lower", str.islower), ("title", str.istitle)):
        if test(token):
            return f"<{name}{' short' if len(token) < 3 else ''}>"
    return "<mixed>"


class _TermSlots(dict):
    """The two slots of a token, as one number; computed once while kept."""

    def __missing__(self, token: str) -> int:
        if len(self) >= CACHE_ENTRIES:
            self.clear()
        slot = lambda s, n: xxhash.xxh64_intdigest(s.encode("utf-8", "surrogatepass"), 11) % n
        value = self[token] = slot(token.lower(), WORD_SLOTS) * SLOTS + WORD_SLOTS + 1 + slot(shape(token), SHAPE_SLOTS - 1)
        return value


_slots = _TermSlots()


def bag(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Slots of a text's terms and their counts."""
    tokens = TOKEN.findall(text or "")
    both = np.fromiter(map(_slots.__getitem__, tokens), dtype=np.int64, count=len(tokens))
    counts = np.bincount(both // SLOTS, minlength=SLOTS) + np.bincount(both % SLOTS, minlength=SLOTS)
    counts[REPEATED] += int((both[1:] == both[:-1]).sum())
    slots = np.flatnonzero(counts)
    return slots, counts[slots]


def weigh(text: str | None, idf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Slots and weights of a text, of length one."""
    slots, counts = bag(text)
    w = np.log1p(counts) * idf[slots]
    cut = np.searchsorted(slots, WORD_SLOTS)
    for part, size in ((w[:cut], 1 - SHAPE_PART), (w[cut:], SHAPE_PART)):
        part *= np.sqrt(size) / (np.linalg.norm(part) or 1.0)
    return slots, w.astype(np.float32)


def document_frequencies(docs: DataFrame) -> tuple[int, np.ndarray]:
    """Documents, and those that have each slot, over the whole table."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(SLOTS + 1, dtype=np.int64)
        for (texts,) in rows_of(batches, "text"):
            for t in texts:
                counts[bag(t)[0]] += 1
            counts[SLOTS] += len(texts)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(SLOTS + 1), pa.int32()), pa.array(counts)], ["slot", "n"])

    got = exactly(docs, "text").mapInArrow(run, "slot int, n long").groupBy("slot").agg(F.sum("n").alias("n")).toPandas()
    counts = np.zeros(SLOTS + 1)
    counts[got["slot"]] = got["n"]
    return int(counts[SLOTS]), counts[:SLOTS]


class Model(NamedTuple):
    idf: np.ndarray
    directions: np.ndarray  # slots x dimensions
    vectors: np.ndarray  # learned rows x dimensions, of length one
    labels: np.ndarray


def latent_directions(rows: np.ndarray, dimensions: int) -> np.ndarray:
    """The leading right singular vectors, by subspace iteration from a fixed start."""
    width = min(dimensions + 8, *rows.shape)
    basis = np.random.default_rng(1).standard_normal((rows.shape[1], width)).astype(np.float32)
    for _ in range(6):
        basis, _ = np.linalg.qr(rows.T @ (rows @ basis))
    _, _, turn = np.linalg.svd(rows @ basis, full_matrices=False)
    return (basis @ turn.T)[:, :dimensions].astype(np.float32)


def _unit(vectors: np.ndarray) -> np.ndarray:
    norms = np.linalg.norm(vectors, axis=1, keepdims=True)
    return vectors / np.where(norms > 0, norms, 1)


def learn(docs: DataFrame, labels: DataFrame, column: str = "quality", sample_rows: int = SAMPLE_ROWS) -> Model:
    """The latent space and its labelled vectors; at most ``sample_rows`` bags of
    at most ``SLOTS`` numbers reach the driver."""
    ship_package(docs.sparkSession)
    n, counts = document_frequencies(docs)
    idf = np.log((n + 1) / (counts + 1)) + 0.1
    rows = learning_rows(docs, labels, column, sample_rows)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, texts, ys in rows_of(batches, "doc_id", "text", "label"):
            bags = [weigh(t, idf) for t in texts]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(ids, pa.int64()),
                    pa.array([s.astype(np.int16).tobytes() for s, _ in bags], pa.binary()),
                    pa.array([w.astype(np.float16).tobytes() for _, w in bags], pa.binary()),
                    pa.array(ys, pa.int32()),
                ],
                ["doc_id", "slots", "weights", "label"],
            )

    got = rows.mapInArrow(run, "doc_id long, slots binary, weights binary, label int").toPandas()
    got = got.sort_values(["doc_id", "slots"])
    table = np.zeros((len(got), SLOTS), dtype=np.float32)
    for i, (slots, weights) in enumerate(zip(got["slots"], got["weights"])):
        table[i, np.frombuffer(slots, dtype=np.int16)] = np.frombuffer(weights, dtype=np.float16)
    if not len(got):
        return Model(idf, np.zeros((SLOTS, 1), np.float32), np.zeros((0, 1), np.float32), np.zeros(0, np.float32))
    directions = latent_directions(table, DIMENSIONS)
    return Model(idf, directions, _unit(table @ directions), got["label"].to_numpy(dtype=np.float32))


def votes(model: Model, texts: list[str | None]) -> np.ndarray:
    """Scores of texts: cosines with every labelled vector, block by block."""
    out = np.zeros(len(texts))
    if not len(model.labels):
        return out
    k = min(NEIGHBOURS, len(model.labels))
    for at in range(0, len(texts), BLOCK):
        block = np.zeros((min(BLOCK, len(texts) - at), model.directions.shape[1]), dtype=np.float32)
        for i, text in enumerate(texts[at : at + BLOCK]):
            slots, weights = weigh(text, model.idf)
            block[i] = weights @ model.directions[slots]
        cosines = _unit(block) @ model.vectors.T
        near = np.argpartition(-cosines, k - 1, axis=1)[:, :k]
        weight = np.maximum(np.take_along_axis(cosines, near, axis=1), 0) ** SHARPNESS
        total = weight.sum(axis=1)
        vote = (weight * model.labels[near]).sum(axis=1) / np.where(total > 0, total, 1)
        out[at : at + BLOCK] = np.where(total > 0, vote, model.labels.mean())
    return np.clip(out, 0.0, 1.0)


def score(spark: SparkSession, model: Model, text: Column) -> Column:
    """Share of the neighbours' votes for label 1."""
    shared = spark.sparkContext.broadcast(model)

    @pandas_udf("double")
    def run(texts: pd.Series) -> pd.Series:
        return pd.Series(votes(shared.value, list(texts)), dtype="float64")

    return run(text)


def quality(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS, least: float = 0.3) -> DataFrame:
    """doc_id, held_out, score and predicted (score of ``least`` or more) of every row."""
    model = learn(docs, labels, "quality", sample_rows)
    scored = exactly(docs, "doc_id", "text").select(F.col("doc_id").cast("long"), score(docs.sparkSession, model, F.col("text")).alias("score"))
    return scored.select("doc_id", held_out(F.col("doc_id"), 5, 0).alias("held_out"), "score", (F.col("score") >= least).cast("int").alias("predicted"))
