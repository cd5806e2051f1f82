"""Source divergence audit by length-bucketed term packing (operator 12).

Terms are the runs of letters and of characters beyond ASCII, only A-Z lower-cased.  Each
language keeps the terms that at least ``least_docs`` of its documents hold.  A group is a
(language, source), or a language as a whole; it gives a kept term the share

    p = 1 + floor(10^9 * (count + 2) / (N + 2 * V)),

N its occurrences of kept terms and V their number.  Two groups differ in a term by
f = floor((p - q)^2 / (p + q)), and in all by the sum of f over the kept terms.

Counting.  The bytes of many texts lie in one array; a table lower-cases and classifies
them, and each term is a start and a length.  A term of at most 8 bytes is one unsigned
64-bit word, one of at most 16 bytes two, read straight from the array; they are sorted by
16 bits at a time (numpy sorts 16-bit numbers by radix) and runs of equal words counted.
Longer terms fall into one bucket for each length and are sorted there as byte strings.
The texts lie in the order of their groups, and the sorts are stable, so that inside a run
of one word the documents and groups are runs too.  Spark adds up what the tasks count.

Sums over terms.  The rows of a language's kept terms are dealt into buckets of bounded
size by term.  A bucket lays the shares of its terms out in a matrix, a column for each
source, and adds up its f for every pair of columns; Spark adds up the buckets.  A term that a
source lacks has the share of count 0 there, so no pair of rows is ever made.

All arithmetic is exact: 64-bit integers, and decimals where products grow beyond them.

Defined results: NULL text, lang and source are ''; a text without a term still makes its
(lang, source) a group; repeated rows and ids count each; V = 0 gives pairs of value 0 and no
terms; a language with one source has no pair; other columns are ignored; an empty table
gives no row.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskloom.llm.common import exactly, ship_package, store

#: Bytes of text that are counted together in a task.
CHUNK_BYTES = 1 << 24
#: Rows (term, source) of a bucket, about; shares in a matrix; sources whose pairs are summed together.
BUCKET_ROWS = 200_000
MATRIX_CELLS = 1 << 20
SOURCE_BLOCK = 256

SCALE = 1_000_000_000


def _tables() -> tuple[np.ndarray, np.ndarray]:
    lower = np.arange(256, dtype=np.uint8)
    lower[ord("A") : ord("Z") + 1] += 32
    letter = np.zeros(256, dtype=bool)
    letter[ord("a") : ord("z") + 1] = True
    letter[128:] = True
    return lower, letter


LOWER, LETTER = _tables()


def radix_order(words: np.ndarray) -> np.ndarray:
    """The stable order of unsigned 64-bit words, 16 bits at a time."""
    order = np.arange(len(words))
    for shift in (0, 16, 32, 48):
        digit = (words >> np.uint64(shift)).astype(np.uint16)
        if digit.any():  # else this step changes nothing
            order = order[np.argsort(digit[order], kind="stable")]
    return order


def find_terms(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, length and text number of every term in lower-cased bytes; text k is
    ``data[bounds[k]:bounds[k + 1]]``."""
    inside = np.zeros(len(data) + 1, dtype=bool)
    inside[:-1] = LETTER[data]
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    cuts = bounds[(bounds > 0) & (bounds < len(data))]
    begins[cuts] = inside[cuts]  # a term ends with its text
    starts = np.flatnonzero(begins)
    ends = inside[:-1] & (~inside[1:] | begins[1:])
    lengths = np.flatnonzero(ends) + 1 - starts
    return starts, lengths, np.searchsorted(bounds, starts, side="right") - 1


def run_counts(changes: list[np.ndarray], text: np.ndarray, group: np.ndarray) -> tuple[np.ndarray, ...]:
    """First place, group, occurrences and documents of every run of one (term, group).
    ``changes`` are sorted columns that together make the term."""
    n = len(text)
    new_text = np.ones(n, dtype=bool)
    new_group = np.ones(n, dtype=bool)
    same_term = np.ones(n - 1, dtype=bool)
    for c in changes:
        same_term &= c[1:] == c[:-1]
    new_group[1:] = ~(same_term & (group[1:] == group[:-1]))
    new_text[1:] = ~(same_term & (text[1:] == text[:-1]))
    first = np.flatnonzero(new_group)
    return first, group[first], np.diff(np.append(first, n)), np.add.reduceat(new_text.astype(np.int64), first)


def count_terms(data: np.ndarray, bounds: np.ndarray, groups: np.ndarray) -> Iterator[tuple[list[bytes], np.ndarray, np.ndarray, np.ndarray]]:
    """Terms, and for each its group, occurrences and documents; texts lie in the order
    of ``groups``, which has one number for each text."""
    starts, lengths, text = find_terms(data, bounds)
    padded = np.zeros(len(data) + 16, dtype=np.uint8)
    padded[: len(data)] = data
    eight = np.ndarray((len(data) + 8,), dtype="<u8", buffer=padded, strides=(1,))  # the 8 bytes from each place on
    mask = np.array([(1 << (8 * k)) - 1 for k in range(9)], dtype=np.uint64)

    raw = data.tobytes()

    def of(chosen: np.ndarray, sort: list[np.ndarray]) -> tuple[list[bytes], np.ndarray, np.ndarray, np.ndarray]:
        """Counts of the terms ``chosen``, given in the order of their ``sort`` columns."""
        first, group, n, docs = run_counts(sort, text[chosen], groups[text[chosen]])
        at, size = starts[chosen[first]], lengths[chosen[first]]
        return [raw[a : a + k] for a, k in zip(at.tolist(), size.tolist())], group, n, docs

    short = np.flatnonzero(lengths <= 8)
    if len(short):
        words = eight[starts[short]] & mask[lengths[short]]
        order = radix_order(words)
        yield of(short[order], [words[order]])
    middle = np.flatnonzero((lengths > 8) & (lengths <= 16))
    if len(middle):
        head, tail = eight[starts[middle]], eight[starts[middle] + 8] & mask[lengths[middle] - 8]
        order = radix_order(tail)
        order = order[radix_order(head[order])]
        yield of(middle[order], [head[order], tail[order]])
    long = np.flatnonzero(lengths > 16)
    for size in np.unique(lengths[long]).tolist():
        bucket = long[lengths[long] == size]
        at = starts[bucket]
        codes = data[at[:, None] + np.arange(size)].view(f"S{size}").ravel() if size * len(bucket) <= CHUNK_BYTES // 8 else None
        if codes is None:  # places of so many bytes would be a table of their own
            codes = np.array([data[a : a + size].tobytes() for a in at.tolist()], dtype=object)
        order = np.argsort(codes, kind="stable")
        yield of(bucket[order], [codes[order]])


def counted(docs: DataFrame) -> DataFrame:
    """(lang, source, term, n, docs): occurrences and documents of every term."""
    ship_package(docs.sparkSession)
    schema = pa.schema([("lang", pa.string()), ("source", pa.string()), ("term", pa.string()), ("n", pa.int64()), ("docs", pa.int64())])

    def count(tables: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pa.Table.from_batches(tables).sort_by([("lang", "ascending"), ("source", "ascending")])
        lang, source = (table.column(c).combine_chunks() for c in ("lang", "source"))
        n = table.num_rows
        changed = np.zeros(n, dtype=bool)
        for c in (lang, source):
            codes = c.dictionary_encode().indices.to_numpy(zero_copy_only=False)
            changed[1:] |= codes[1:] != codes[:-1]
        groups = np.cumsum(changed)
        heads = np.append(0, np.flatnonzero(changed))  # first text of each group
        texts = table.column("text").cast(pa.large_binary()).combine_chunks()
        if isinstance(texts, pa.ChunkedArray):
            texts = texts.chunk(0)
        bounds = np.frombuffer(texts.buffers()[1], dtype=np.int64)[texts.offset : texts.offset + n + 1]
        data = LOWER[np.frombuffer(texts.buffers()[2] or b"", dtype=np.uint8)[bounds[0] : bounds[-1]]]
        for terms, group, times, held in count_terms(data, bounds - bounds[0], groups):
            place = pa.array(heads[group])
            columns = [lang.take(place), source.take(place), pa.array(terms, pa.binary()).cast(pa.string()), pa.array(times, pa.int64()), pa.array(held, pa.int64())]
            for at in range(0, len(terms), 65536):
                yield pa.RecordBatch.from_arrays([c.slice(at, 65536) for c in columns], schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        size = 0
        for batch in batches:
            for at in range(0, batch.num_rows, 64):
                part = batch.slice(at, 64)
                held.append(part)
                size += part.nbytes
                if size >= CHUNK_BYTES:
                    yield from count(held)
                    held, size = [], 0
        if held:
            yield from count(held)

    return docs.mapInArrow(run, "lang string, source string, term string, n long, docs long")


def share(count: str, total: str = "total", terms: str = "terms") -> Column:
    """p of a count: exact, by decimals."""
    return F.expr(f"((cast({count} as decimal(19,0)) + 2) * {SCALE}) div cast({total} + 2 * {terms} as decimal(19,0)) + 1")


def squared(p: str, q: str) -> Column:
    """f of two shares."""
    return F.expr(f"(({p} - {q}) * ({p} - {q})) div ({p} + {q})")


def kept_terms(docs: DataFrame, least_docs: int) -> DataFrame:
    """(lang, source, term, n, lang_n) of every kept term in the sources that have it."""
    sums = counted(docs).groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    of_term = Window.partitionBy("lang", "term")
    sums = sums.withColumn("lang_n", F.sum("n").over(of_term)).withColumn("lang_docs", F.sum("docs").over(of_term))
    return sums.where(F.col("lang_docs") >= least_docs).drop("docs", "lang_docs")


def pair_sums(kept: DataFrame, groups: DataFrame) -> DataFrame:
    """(lang, source, item, value): the summed f of every ordered pair of sources."""
    ship_package(kept.sparkSession)
    buckets = F.greatest(F.lit(1), F.ceil(F.col("rows") / BUCKET_ROWS)).cast("int")
    blocks = F.ceil(F.col("sources") / SOURCE_BLOCK).cast("int")
    spread = groups.withColumn("bucket", F.explode(F.sequence(F.lit(0), buckets - 1))).withColumn("block", F.explode(F.sequence(F.lit(0), blocks - 1)))
    zero = F.when(F.col("terms") > 0, share("0")).otherwise(0).cast("long")
    # the names are given anew, so that both sides of the cogroup are told apart
    zeros = spread.select(*[F.col(c).alias(c) for c in ("lang", "bucket", "block", "source", "number")], zero.alias("p"))
    dealt = kept.withColumn("bucket", F.pmod(F.xxhash64("term"), buckets).cast("int")).withColumn("block", F.explode(F.sequence(F.lit(0), blocks - 1)))
    dealt = dealt.select("lang", "bucket", "block", "number", "term", "p")

    def sums(rows: pd.DataFrame, sources: pd.DataFrame) -> pd.DataFrame:
        sources = sources.sort_values("number", ignore_index=True)
        n, base = len(sources), sources["p"].to_numpy(np.int64)
        block = int(sources["block"].iloc[0])
        own = np.arange(block * SOURCE_BLOCK, min(n, (block + 1) * SOURCE_BLOCK))
        out = np.zeros((len(own), n), dtype=np.int64)
        term, _ = pd.factorize(rows["term"])
        at, column, p = term.astype(np.int64), rows["number"].to_numpy(np.int64), rows["p"].to_numpy(np.int64)
        order = np.argsort(at, kind="stable")
        at, column, p = at[order], column[order], p[order]
        count = int(at[-1]) + 1 if len(at) else 0
        step = max(1, MATRIX_CELLS // n)
        for low in range(0, count, step):
            a, b = np.searchsorted(at, [low, low + step])
            matrix = np.tile(base, (min(step, count - low), 1))
            matrix[at[a:b] - low, column[a:b]] = p[a:b]
            for k, s in enumerate(own):
                mine = matrix[:, s : s + 1]
                apart = matrix - mine
                out[k] += (apart * apart // (matrix + mine)).sum(axis=0)
        names = sources["source"].to_numpy(object)
        left, right = np.repeat(own, n), np.tile(np.arange(n), len(own))
        other = left != right
        return pd.DataFrame(
            {"lang": sources["lang"].iloc[0], "source": names[left[other]], "item": names[right[other]], "value": out.ravel()[other]}
        )

    keys = ["lang", "bucket", "block"]
    parts = dealt.groupBy(*keys).cogroup(zeros.groupBy(*keys)).applyInPandas(sums, "lang string, source string, item string, value long")
    return parts.groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))


def audit(docs: DataFrame, least_docs: int = 10, top_terms: int = 10) -> DataFrame:
    """lang, source, part, item, value and rank: how far each source is from the others of
    its language (part ``pair``) and the terms that it has more of than its
    language (part ``term``, the first ``top_terms``)."""
    rows = exactly(docs, "text", "lang", "source")
    rows = rows.select(*[F.coalesce(F.col(c), F.lit("")).alias(c) for c in rows.columns])
    kept = store(kept_terms(rows, least_docs), "op12-kept")
    # numbers of each group and of its language
    totals = kept.groupBy("lang", "source").agg(F.sum("n").alias("total"), F.count(F.lit(1)).alias("rows"))
    langs = kept.groupBy("lang", "term").agg(F.max("lang_n").alias("n")).groupBy("lang").agg(F.sum("n").alias("lang_total"), F.count(F.lit(1)).alias("terms"))
    found = rows.groupBy("lang", "source").agg(F.lit(True).alias("found")).drop("found")
    of_lang = Window.partitionBy("lang")
    groups = found.join(totals, ["lang", "source"], "left").join(langs, "lang", "left").select(
        "lang", "source", *[F.coalesce(c, F.lit(0)).alias(c) for c in ("total", "lang_total", "terms")],
        F.sum(F.coalesce("rows", F.lit(0))).over(of_lang).alias("rows"), F.count(F.lit(1)).over(of_lang).alias("sources"),
        (F.row_number().over(of_lang.orderBy("source")) - 1).alias("number"),
    )
    groups = store(groups, "op12-groups")
    shares = kept.join(groups, ["lang", "source"]).withColumn("p", share("n")).withColumn("q", share("lang_n", "lang_total"))

    pairs = pair_sums(shares, groups)
    by_value = Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), "item")
    pairs = pairs.select("lang", "source", F.lit("pair").alias("part"), "item", "value", F.row_number().over(by_value).alias("rank"))
    terms = shares.where("p > q").select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), squared("p", "q").alias("value"))
    terms = terms.withColumn("rank", F.row_number().over(by_value)).where(F.col("rank") <= top_terms)
    return pairs.unionByName(terms)
