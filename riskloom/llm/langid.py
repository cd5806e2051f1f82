"""Language identification by segmentation-marginalised unigrams (operator 6).

Each language has a probability for every piece of a fixed public vocabulary.
The likelihood of a word is the sum, over all ways to cut it into pieces, of the
products of the piece probabilities; a forward pass over the word adds them up
without listing them.  A text is the product of its words (runs of letters,
lower case, each opened by the vocabulary's word mark), and the languages'
likelihoods give a posterior with equal priors.  A character without a piece of
its own is spelled by the vocabulary's byte pieces.

The probabilities are learned by expectation maximisation: forward and backward
passes give the expected number of uses of each piece, summed by Spark over the
distinct words of the learning texts.  Learning takes up to ``SAMPLE_DOCS``
documents of each of up to ``max_languages`` languages, the most frequent ones (the
documents of the smallest hashes of their ids, in expectation); every text is scored, whole.

A posterior tells the languages apart but not text from junk.  ``accepted`` compares the best
language's likelihood with that of the same letters drawn one by one, at the
frequencies that they have in all learning texts: a text that the letters without an
order explain better, by ``JUNK_MARGIN`` or more in logarithms, is rejected.

Defined results: NULL text and text without a letter give ``und`` with score 0,
as does a table from which no language can be learned (``accepted`` keeps all its
rows, for nothing speaks against them); ties go to the language that sorts first; repeated
rows are scored each; rows with a NULL or empty language are never learned from; other
columns are ignored, or kept as they are by ``accepted``; an empty table gives no row.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from itertools import chain
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from riskloom.llm.common import SLICE_ROWS, exactly, held_out, partitions, rows_of, ship_package, store, whole_rows, worker_state

#: Learning documents of a language; bounds the model's cost, not what is scored.
SAMPLE_DOCS = 2000
#: The most frequent languages are learned; bounds the size of the model, which is broadcast.
MAX_LANGUAGES = 200
#: How much better, in logarithms, letters without an order must explain a text that is junk.
JUNK_MARGIN = 12.0
ROUNDS = 2
SMOOTHING = 0.1
UNDETERMINED = "und"
CACHE_ENTRIES = 500_000
#: Words whose forward passes are made together.
WORDS_TOGETHER = 4096

LETTERS = re.compile(r"[^\W\d_]+")
MARK = "▁"
#: Longest piece of the vocabulary that is looked up, in characters.
MAX_PIECE = 16
_TINY = 1e-120


class Model(NamedTuple):
    languages: list[str]
    pieces: dict[str, int]  # piece -> row of ``probabilities``
    byte_rows: list[int]  # rows of the 256 byte pieces
    probabilities: np.ndarray  # pieces x languages
    letters: dict[str, float]  # logarithm of each letter's frequency; MARK stands for a word's start


def read_pieces(path: str) -> tuple[dict[str, int], list[int]]:
    """Rows of the text pieces and of the byte pieces of a vocabulary file."""
    import sentencepiece

    vocab = sentencepiece.SentencePieceProcessor(model_file=path)
    n = vocab.get_piece_size()
    plain = [i for i in range(n) if not (vocab.is_control(i) or vocab.is_unknown(i) or vocab.is_byte(i))]
    byte_rows = [vocab.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
    return {p: i for i in plain if len(p := vocab.id_to_piece(i)) <= MAX_PIECE}, byte_rows


def words_of(text: str | None) -> list[str]:
    """Lower-case runs of letters; none if the text has no letter."""
    words = LETTERS.findall((text or "").lower())
    return words if any(c.isalpha() for w in words for c in w) else []


def edges(word: str, pieces: dict[str, int], byte_rows: list[int]) -> list[list[tuple[int, tuple[int, ...]]]]:
    """For each end position the pieces that end there: (start, rows).  A character
    without a piece has one edge, the rows of its bytes."""
    text = MARK + word
    out: list[list[tuple[int, tuple[int, ...]]]] = [[]]
    for end in range(1, len(text) + 1):
        here = []
        for start in range(max(0, end - MAX_PIECE), end):
            row = pieces.get(text[start:end])
            if row is not None:
                here.append((start, (row,)))
        if text[end - 1] not in pieces:
            here.append((end - 1, tuple(byte_rows[b] for b in text[end - 1].encode("utf-8", "surrogatepass"))))
        out.append(here)
    return out


def log_likelihood(word: str, rows: dict[str, list[float]], byte_rows: list[list[float]], languages: int) -> list[float]:
    """Logarithm of the sum over all segmentations, for each language.  ``rows``
    and ``byte_rows`` hold the probabilities by language."""
    text = MARK + word
    n = len(text)
    every = range(languages)
    alpha: list[list[float]] = [[1.0] * languages]
    scale = [0.0] * languages
    get = rows.get
    for end in range(1, n + 1):
        total = [0.0] * languages
        for start in range(end - MAX_PIECE if end > MAX_PIECE else 0, end):
            p = get(text[start:end])
            if p is not None:
                a = alpha[start]
                for k in every:
                    total[k] += a[k] * p[k]
        if text[end - 1] not in rows:
            p = [1.0] * languages
            for b in text[end - 1].encode("utf-8", "surrogatepass"):
                p = [x * y for x, y in zip(p, byte_rows[b])]
            for k in every:
                total[k] += alpha[end - 1][k] * p[k]
        alpha.append(total)
        for k in every:
            if total[k] < _TINY:  # keep the numbers of a long word in range
                up = 1.0 / (total[k] or 1e-300)
                scale[k] -= math.log(up)
                for a in alpha[-MAX_PIECE:]:
                    a[k] *= up
    return [math.log(alpha[n][k]) + scale[k] for k in every]


def beginnings(pieces: dict[str, int]) -> dict[str, int]:
    """Everything that a piece begins with: the row of a piece, -1 for what is none itself."""
    out = {piece[:k]: -1 for piece in pieces for k in range(1, len(piece))}
    return out | pieces


def log_likelihoods(words: list[str], begun: dict[str, int], byte_rows: list[int], p: np.ndarray) -> np.ndarray:
    """``log_likelihood`` of many words, a row for each: the forward step to a position is
    taken for all words together.  ``begun`` are the ``beginnings`` of the pieces."""
    # the pieces that end at each position, each one number: word, length and row
    ends: list[list[int]] = [[] for _ in range(max(map(len, words), default=0) + 2)]
    get = begun.get
    others: dict[str, int] = {}  # a character without a piece has a row of its own
    for i, word in enumerate(words):
        text = MARK + word
        n = len(text)
        for start in range(n):
            code = (i << 40) + row if (row := get(text[start], -1)) >= 0 else (i << 40) + others.setdefault(text[start], len(p) + len(others))
            end = start + 1
            ends[end].append(code + (1 << 32))
            row = get(text[start : end + 1]) if end < n else None
            while row is not None:
                end += 1
                if row >= 0:
                    ends[end].append((i << 40) + (end - start << 32) + row)
                row = get(text[start : end + 1]) if end < n else None
    if others:
        p = np.concatenate([p, [np.prod(p[[byte_rows[b] for b in c.encode("utf-8", "surrogatepass")]], axis=0) for c in others]])
    n, languages = len(words), p.shape[1]
    sizes = np.fromiter(map(len, words), dtype=np.int64, count=n) + 1
    scale = np.zeros((n, languages))
    ring = np.zeros((MAX_PIECE + 1, n, languages))  # forward values of the last positions
    ring[0] = 1.0
    out = np.zeros((n, languages))
    for end in range(1, len(ends)):
        now = ring[end % (MAX_PIECE + 1)]
        now[:] = 0.0
        if not ends[end]:
            break
        codes = np.array(ends[end], dtype=np.int64)  # in the order of the words
        i, start, row = codes >> 40, end - (codes >> 32 & 0xFF), codes & 0xFFFF_FFFF
        first = np.flatnonzero(np.concatenate([[True], i[1:] != i[:-1]]))
        own = i[first]
        now[own] = np.add.reduceat(ring[start % (MAX_PIECE + 1), i] * p[row], first, axis=0)
        low = np.zeros_like(now, dtype=bool)
        low[own] = now[own] < _TINY  # keep the numbers of a long word in range
        if low.any():
            up = 1.0 / np.where(low, np.where(now > 0, now, 1e-300), 1.0)
            scale -= np.log(up)
            ring *= up
        done = own[sizes[own] == end]
        out[done] = np.log(now[done]) + scale[done]
    return out


def _sum_of_logs(values: list[float]) -> float:
    top = max(values, default=-math.inf)
    return top if top == -math.inf else top + math.log(math.fsum(math.exp(v - top) for v in values))


def _expected_uses_by_logs(grid: list, p: np.ndarray, into: dict[int, float], weight: float) -> None:
    """``expected_uses`` of a word whose forward values leave the range of plain numbers."""
    n = len(grid) - 1
    values = [[math.fsum(math.log(p[r]) for r in rows) for _, rows in here] for here in grid]
    forward = [0.0]
    for end in range(1, n + 1):
        forward.append(_sum_of_logs([forward[start] + v for (start, _), v in zip(grid[end], values[end])]))
    ways: list[list[float]] = [[] for _ in range(n)] + [[0.0]]
    for end in range(n, 0, -1):
        back = _sum_of_logs(ways[end])
        for (start, rows), v in zip(grid[end], values[end]):
            ways[start].append(back + v)
            uses = weight * math.exp(forward[start] + v + back - forward[n])
            for r in rows:
                into[r] = into.get(r, 0.0) + uses


def expected_uses(word: str, pieces: dict[str, int], byte_rows: list[int], p: np.ndarray, into: dict[int, float], weight: float) -> None:
    """Add ``weight`` times the expected uses of each piece in ``word``."""
    grid = edges(word, pieces, byte_rows)
    n = len(grid) - 1
    forward = [1.0] + [0.0] * n
    values = []
    for end in range(1, n + 1):
        here = []
        for start, rows in grid[end]:
            value = 1.0
            for r in rows:
                value *= p[r]
            here.append(value)
            forward[end] += forward[start] * value
        values.append(here)
    if forward[n] < 1e-280:  # too long for plain numbers
        return _expected_uses_by_logs(grid, p, into, weight)
    backward = [0.0] * n + [1.0]
    for end in range(n, 0, -1):
        for (start, _), value in zip(grid[end], values[end - 1]):
            backward[start] += backward[end] * value
    unit = weight / forward[n]
    for end in range(1, n + 1):
        for (start, rows), value in zip(grid[end], values[end - 1]):
            uses = unit * forward[start] * value * backward[end]
            for r in rows:
                into[r] = into.get(r, 0.0) + uses


def learning_words(docs: DataFrame, sample_docs: int = SAMPLE_DOCS, max_languages: int = MAX_LANGUAGES) -> DataFrame:
    """(lang, word, n) of the learning documents."""
    usable = exactly(docs, "doc_id", "text", "lang").select("doc_id", "text", F.col("lang").cast("string").alias("lang")).where(
        ~held_out(F.col("doc_id"), 4, 2) & F.col("text").isNotNull() & (F.length("lang") > 0)
    )
    sizes = usable.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "lang").limit(max_languages).collect()
    share = F.lit(0.0)
    for r in sizes:
        share = F.when(F.col("lang") == r.lang, F.lit(min(1.0, sample_docs / r.n))).otherwise(share)
    chosen = usable.where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20)) < share * (1 << 20))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for langs, texts in rows_of(batches, "lang", "text"):
            seen: dict[tuple[str, str], int] = {}
            for lang, text in zip(langs, texts):
                for w in words_of(text):
                    seen[lang, w] = seen.get((lang, w), 0) + 1
            yield pa.RecordBatch.from_arrays(
                [pa.array([k[0] for k in seen], pa.string()), pa.array([k[1] for k in seen], pa.string()), pa.array(seen.values(), pa.int64())],
                ["lang", "word", "n"],
            )

    counted = chosen.mapInArrow(count, "lang string, word string, n long")
    return counted.groupBy("lang", "word").agg(F.sum("n").alias("n"))


def letter_frequencies(words: DataFrame) -> dict[str, float]:
    """Logarithms of the letters' shares in all learning words, each with its start; a number for each
    character of Unicode at most."""
    letters = words.select(F.explode(F.array_distinct(F.split("word", ""))).alias("c"), "word", "n").where("c <> ''")
    times = F.length("word") - F.length(F.replace("word", F.col("c")))
    counts = {r.c: r.n for r in letters.groupBy("c").agg(F.sum(F.col("n") * times).alias("n")).collect()}
    counts[MARK] = words.agg(F.sum("n")).first()[0] or 0
    total = sum(counts.values()) + SMOOTHING
    return {c: math.log(n / total) for c, n in counts.items() if n}


def learn(docs: DataFrame, vocabulary: str, sample_docs: int = SAMPLE_DOCS, rounds: int = ROUNDS, max_languages: int = MAX_LANGUAGES) -> Model:
    """Piece probabilities of every language; what reaches the driver is a number
    for each language and piece."""
    spark = docs.sparkSession
    ship_package(spark)
    pieces, byte_rows = read_pieces(vocabulary)
    size = 1 + max([*pieces.values(), *byte_rows])
    words = store(learning_words(docs, sample_docs, max_languages), "op6-words")
    languages = [r.lang for r in words.select("lang").distinct().orderBy("lang").collect()]
    column = {lang: k for k, lang in enumerate(languages)}
    p = np.full((size, len(languages)), 1.0 / size)
    for _ in range(rounds if languages else 0):
        shared = spark.sparkContext.broadcast((pieces, byte_rows, column, p))

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            pieces, byte_rows, column, p = shared.value
            columns = [list(map(float, c)) for c in p.T]
            totals: list[dict[int, float]] = [{} for _ in columns]
            for langs, words, ns in rows_of(batches, "lang", "word", "n"):
                for lang, word, n in zip(langs, words, ns):
                    k = column[lang]
                    expected_uses(word, pieces, byte_rows, columns[k], totals[k], float(n))
            for k, found in enumerate(totals):
                yield pa.RecordBatch.from_arrays(
                    [pa.array([k] * len(found), pa.int32()), pa.array(found.keys(), pa.int32()), pa.array(found.values(), pa.float64())],
                    ["k", "row", "uses"],
                )

        spread = words.repartition(partitions(spark), "word")
        uses = spread.mapInArrow(run, "k int, row int, uses double").groupBy("k", "row").agg(F.sum("uses").alias("uses")).toPandas()
        counts = np.full(p.shape, SMOOTHING)
        counts[uses["row"], uses["k"]] += uses["uses"]
        p = counts / counts.sum(axis=0)
    return Model(languages, pieces, byte_rows, p, letter_frequencies(words))


class Scorer:
    """Posteriors of whole texts; word scores met lately are looked up."""

    def __init__(self, model: Model):
        self.model = model
        self.languages = model.languages
        self.begun = beginnings(model.pieces)
        self.unseen = min(model.letters.values(), default=0.0)
        self._forget()

    def _forget(self) -> None:
        self.known: dict[str, int] = {}
        # of each word: the logarithms for each language, and for letters without an order
        self.scores = np.zeros((1024, len(self.languages) + 1))

    def _learn(self, words: list[str]) -> None:
        at, letters = len(self.known), self.model.letters
        while at + len(words) > len(self.scores):
            self.scores = np.concatenate([self.scores, np.zeros_like(self.scores)])
        rows = self.scores[at : at + len(words)]
        rows[:, :-1] = log_likelihoods(words, self.begun, self.model.byte_rows, self.model.probabilities)
        start = letters.get(MARK, self.unseen)
        rows[:, -1] = [start + sum([letters.get(c, self.unseen) for c in w]) for w in words]
        self.known.update(zip(words, range(at, at + len(words))))

    def learn(self, texts: list[list[str]]) -> None:
        """Keep the scores of all words of some texts."""
        if len(self.known) > CACHE_ENTRIES:
            self._forget()
        missing = list(set(chain.from_iterable(texts)).difference(self.known)) if self.languages else []
        # words of like length together
        missing.sort(key=len)
        for k in range(0, len(missing), WORDS_TOGETHER):
            self._learn(missing[k : k + WORDS_TOGETHER])

    def predict_all(self, texts: list[str | None]) -> list[tuple[str, float, float]]:
        """Of each text the language, its posterior, and how much better the language explains it
        than letters without an order."""
        words = [words_of(t) for t in texts]
        self.learn(words)
        return [self._predict(w) for w in words]

    def _predict(self, words: list[str]) -> tuple[str, float, float]:
        if not words or not self.languages:
            return UNDETERMINED, 0.0, 0.0
        total = self.scores[np.fromiter(map(self.known.__getitem__, words), dtype=np.int64, count=len(words))].sum(axis=0)
        total, unordered = total[:-1], total[-1]
        best = int(np.argmax(total))
        return self.languages[best], float(1.0 / np.exp(total - total[best]).sum()), float(total[best] - unordered)


def prediction(spark: SparkSession, model: Model, text: Column) -> Column:
    """A struct (lang_pred, score, evidence) for a column of texts."""
    shared = spark.sparkContext.broadcast(model)
    number = shared._jbroadcast.id() if shared._jbroadcast else id(shared)

    @pandas_udf("lang_pred string, score double, evidence double")
    def predict(texts: pd.Series) -> pd.DataFrame:
        scorer = worker_state(("langid", number), lambda: Scorer(shared.value))
        out = []
        for at in range(0, len(texts), SLICE_ROWS):
            out += scorer.predict_all(texts.iloc[at : at + SLICE_ROWS].tolist())
        return pd.DataFrame(out, columns=["lang_pred", "score", "evidence"])

    return predict(text)


def identify(docs: DataFrame, vocabulary: str, sample_docs: int = SAMPLE_DOCS, max_languages: int = MAX_LANGUAGES) -> DataFrame:
    """doc_id, held_out, lang_pred and score of every row."""
    model = learn(docs, vocabulary, sample_docs, max_languages=max_languages)
    scored = exactly(docs, "doc_id", "text").select(F.col("doc_id").cast("long"), prediction(docs.sparkSession, model, F.col("text")).alias("p"))
    return scored.select("doc_id", held_out(F.col("doc_id"), 4, 2).alias("held_out"), "p.lang_pred", "p.score")


@whole_rows
def accepted(docs: DataFrame, vocabulary: str, margin: float = JUNK_MARGIN, sample_docs: int = SAMPLE_DOCS, max_languages: int = MAX_LANGUAGES) -> DataFrame:
    """The rows whose language can be told and that are better explained by it than by letters
    without an order, with all their columns."""
    model = learn(docs, vocabulary, sample_docs, max_languages=max_languages)
    if not model.languages:
        return docs
    p = F.col("_prediction")
    scored = docs.withColumn("_prediction", prediction(docs.sparkSession, model, F.col("text")))
    return scored.where((p["lang_pred"] != UNDETERMINED) & (p["evidence"] > -margin)).drop("_prediction")
