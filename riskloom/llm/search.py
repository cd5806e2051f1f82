"""Ranked lexical search by branch and bound over document FP-trees (operator 11).

Terms are the runs of ASCII letters and digits and of characters beyond ASCII, only A-Z
lower-cased.  A term of an item scores w * ((10^9 * tf) div (1000 * tf + 20 * m)) in a document,
with w its rarity and m the document's length against the mean; a document's score
sums over the item's terms (see ``weight`` and ``length_share``).

One pass over the texts keeps, of each document, its number of terms and its term
vector restricted to the terms of the items.  A second one reads these vectors, some
documents at a time, with the terms numbered by falling document frequency:

1. Sorted by their term numbers, documents with the same first terms are neighbours.
   These shared paths make a trie: a node is an interval of documents whose vectors
   begin alike, chains without a branch being one step.  Intervals of under ``LEAF``
   documents are no nodes; their documents hang on the node above.
2. A node holds, for every term, the largest tf of its documents, and their fewest
   terms, hence the smallest m, and smallest id.  The score of these is a bound: the
   score grows with tf and falls with m.
3. Each item walks the tree depth first, the child with the highest bound first, and
   leaves out the nodes whose bound cannot enter the item's best so far, which are
   kept from tree to tree.

What each task found best is ranked by Spark.

The items are taken in blocks of at most ``BLOCK_TERMS`` terms, an item of more alone; each block
reads the documents once.

Defined results: NULL and empty texts have no term and are never found, and no item
without a term finds any; repeated rows of the items count once, an item_id with several texts
ranks for each of them; repeated documents are ranked each; NULL ids come last among equal
scores; fewer than ``top`` rows where fewer documents score above 0; other columns are
ignored; empty tables give no row.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from riskloom.llm.common import exactly, rows_of, ship_package, store

#: Terms of the items that are searched together, and tf values of a tree's table.
BLOCK_TERMS = 65_536
TABLE_CELLS = 1 << 22
#: Documents of a node at least, and of a tree at most.
LEAF = 16
TREE_DOCS = 4096
#: Parts in which an item's rows are ranked before they meet.
SALTS = 32
NO_ID = 1 << 63

_SEPARATORS = bytes(k for k in range(128) if not (48 <= k <= 57 or 65 <= k <= 90 or 97 <= k <= 122))
_FOLD = bytes.maketrans(_SEPARATORS + bytes(range(65, 91)), b" " * len(_SEPARATORS) + bytes(range(97, 123)))


def terms_of(text: bytes | None) -> list[bytes]:
    """Terms of a text in UTF-8, in order, repeats included."""
    return (text or b"").translate(_FOLD).split()


def weight(documents: int, df: int) -> int:
    """w of a term that ``df`` of so many documents hold."""
    return math.floor(1000 * math.log((2 * documents + 2) / (2 * df + 1)))


def length_share(n: np.ndarray, documents: int, terms: int) -> np.ndarray:
    """m of documents with ``n`` terms, where all documents together have ``terms``."""
    return 50 + 50 * n * documents // max(terms, 1)


def scores(tf: np.ndarray, m: np.ndarray, w: np.ndarray) -> np.ndarray:
    """Score of every row of ``tf`` (a column for each term of the item)."""
    tf = tf.astype(np.int64)
    return (w * ((1_000_000_000 * tf) // (1000 * tf + 20 * m[:, None]))).sum(axis=1)


class Block(NamedTuple):
    """Items that are searched together: (item_id, term numbers), and all their terms."""

    items: list[tuple[int | None, list[int]]]
    terms: dict[bytes, int]


def blocks(items: DataFrame, block_terms: int) -> Iterator[Block]:
    """The items, block by block; one block is in the driver's memory at a time."""
    rows = exactly(items, "item_id", "text").select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("binary").alias("text"))
    block = Block([], {})
    for row in rows.distinct().orderBy("item_id", "text").toLocalIterator():
        own = dict.fromkeys(terms_of(row["text"]))
        if not own:
            continue
        if block.items and len(block.terms) + sum(t not in block.terms for t in own) > block_terms:
            yield block
            block = Block([], {})
        block.items.append((row["item_id"], [block.terms.setdefault(t, len(block.terms)) for t in own]))
    if block.items:
        yield block


def restricted(docs: DataFrame, terms: dict[bytes, int]) -> DataFrame:
    """doc_id, number of terms ``n``, and the numbers and tf of the block's terms of every
    document that has a term at all."""
    ship_package(docs.sparkSession)
    known = docs.sparkSession.sparkContext.broadcast(terms)  # at most BLOCK_TERMS terms, or one item's

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = known.value.get
        for ids, texts in rows_of(batches, "doc_id", "text"):
            out: list[tuple] = []
            for doc_id, text in zip(ids, texts):
                words = terms_of(text)
                if not words:
                    continue
                tf: dict[int | None, int] = {}
                for k in map(number, words):
                    tf[k] = tf.get(k, 0) + 1
                tf.pop(None, None)
                out.append((doc_id, len(words), list(tf), list(tf.values())))
            columns = list(zip(*out)) or [(), (), (), ()]
            types = (pa.int64(), pa.int64(), pa.list_(pa.int32()), pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], ["doc_id", "n", "terms", "tf"])

    rows = exactly(docs, "doc_id", "text").select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text"))
    return rows.mapInArrow(run, "doc_id long, n long, terms array<int>, tf array<int>")


def frequencies(vectors: DataFrame, size: int) -> tuple[np.ndarray, int, int]:
    """Document frequency of every term of the block, and the numbers of documents and terms."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size + 2, dtype=np.int64)
        for batch in batches:
            total[:size] += np.bincount(batch.column("terms").flatten().to_numpy(zero_copy_only=False), minlength=size)
            n = batch.column("n").to_numpy(zero_copy_only=False)
            total[size:] += [len(n), int(n.sum())]
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some, pa.int64()), pa.array(total[some])], ["k", "c"])

    got = vectors.select("n", "terms").mapInArrow(run, "k long, c long").groupBy("k").agg(F.sum("c").alias("c")).toPandas()
    total = np.zeros(size + 2, dtype=np.int64)
    total[got["k"].to_numpy(np.int64)] = got["c"]
    return total[:size], int(total[size]), int(total[size + 1])


class Tree:
    """The FP-tree of some documents, sorted by their frequency-ordered term numbers.

    ``tf`` has a row for each document and below these one for each node; ``m`` and ``ids``
    likewise (of a node: the largest tf, the smallest m and id).  ``below`` lists, for each
    node, the rows of its child nodes and of the documents that hang on it."""

    def __init__(self, ids: np.ndarray, m: np.ndarray, paths: list[np.ndarray], tf: np.ndarray):
        keys = [p.astype(">u4").tobytes() for p in paths]
        order = sorted(range(len(keys)), key=keys.__getitem__)
        ids, m, tf, paths = ids[order], m[order], tf[order], [paths[k] for k in order]
        count = self.count = len(order)
        shared = [0] * (count + 1)  # terms that a document's path shares with the one before
        for k in range(1, count):
            a, b = paths[k - 1], paths[k]
            short = min(len(a), len(b))
            differ = np.flatnonzero(a[:short] != b[:short])
            shared[k] = int(differ[0]) if len(differ) else short
        self.below: list[np.ndarray] = []
        tops: list[np.ndarray] = []  # of each node: largest tf, smallest m and id
        least: list[tuple[int, int]] = []

        def close(children: list[int], own: list[int]) -> int:
            """The row of a finished node."""
            nodes = [k - count for k in children]
            largest = [tops[k] for k in nodes] + ([tf[own].max(axis=0)] if own else [])
            bounds = [least[k] for k in nodes] + ([(int(m[own].min()), min(ids[own]))] if own else [])
            tops.append(np.maximum.reduce(largest))
            least.append((min(x for x, _ in bounds), min(x for _, x in bounds)))
            self.below.append(np.array(children + own, dtype=np.int64))
            return count + len(tops) - 1

        # open intervals from the root down: depth, first document, child nodes, documents that hang on it
        stack: list[tuple[int, int, list[int], list[int]]] = [(0, 0, [], [])]
        for k in range(count):
            depth, start = shared[k + 1], k
            nodes, hanging = [], [k]
            while stack[-1][0] > depth:  # intervals that end with document k
                _, start, children, own = stack.pop()
                nodes, hanging = children + nodes, own + hanging
                if k + 1 - start >= LEAF:
                    nodes, hanging = [close(nodes, hanging)], []
            if stack[-1][0] < depth:
                stack.append((depth, start, [], []))
            stack[-1][2].extend(nodes), stack[-1][3].extend(hanging)
        self.root = close(stack[0][2], stack[0][3])
        self.tf = np.concatenate([tf, np.array(tops, dtype=tf.dtype)])
        self.m = np.concatenate([m, np.array([x for x, _ in least], dtype=np.int64)])
        self.ids = np.concatenate([ids, np.array([x for _, x in least], dtype=object)])

    def search(self, terms: np.ndarray, w: np.ndarray, best: list[tuple[int, int]], top: int) -> int:
        """Enter the item's best documents into the heap ``best`` of (score, -id); the
        number of nodes visited."""
        stack = [(None, self.root)]
        visited = 0
        tf = self.tf[:, terms]
        while stack:
            bound, node = stack.pop()
            if bound is not None and len(best) == top and bound <= best[0]:
                continue
            visited += 1
            rows = self.below[node - self.count]
            found = scores(tf[rows], self.m[rows], w)
            some = np.flatnonzero(found >= (max(1, best[0][0]) if len(best) == top else 1))
            children = []
            for k in some[np.argsort(-found[some], kind="stable")].tolist():
                entry = (int(found[k]), -int(self.ids[rows[k]]))
                if rows[k] >= self.count:
                    children.append((entry, int(rows[k])))
                elif len(best) < top:
                    heapq.heappush(best, entry)
                elif entry > best[0]:
                    heapq.heapreplace(best, entry)
            stack.extend(reversed(children))  # the highest bound is on top
        return visited


def best_of_tasks(vectors: DataFrame, block: Block, df: np.ndarray, documents: int, terms: int, top: int) -> DataFrame:
    """(item, item_id, doc_id, score): the best documents of each item in each task."""
    order = np.argsort(-df, kind="stable")  # the most frequent term has number 0
    number = np.empty(len(df), dtype=np.int64)
    number[order] = np.arange(len(df))
    items = []
    for item_id, own in block.items:
        there = [k for k in own if df[k]]
        w = np.array([weight(documents, int(df[k])) for k in there], dtype=np.int64)
        items.append((item_id, number[there], w))
    known = vectors.sparkSession.sparkContext.broadcast((number, items))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, items = known.value
        best: list[list[tuple[int, int]]] = [[] for _ in items]
        per_tree = max(1, min(TREE_DOCS, TABLE_CELLS // max(1, len(number))))
        for batch in batches:
            for at in range(0, batch.num_rows, per_tree):
                part = batch.slice(at, per_tree)
                lists, counts = part.column("terms"), part.column("tf")
                sizes = lists.value_lengths().to_numpy(zero_copy_only=False)
                flat, values = number[lists.flatten().to_numpy(zero_copy_only=False)], counts.flatten().to_numpy(zero_copy_only=False)
                ends = np.cumsum(sizes)
                some = np.flatnonzero(sizes)  # the others score 0
                if not len(some):
                    continue
                tf = np.zeros((len(sizes), len(number)), dtype=np.int32)
                tf[np.repeat(np.arange(len(sizes)), sizes), flat] = values
                paths = [np.sort(flat[ends[k] - sizes[k] : ends[k]]) for k in some.tolist()]
                ids = np.array([NO_ID if x is None else x for x in part.column("doc_id").to_pylist()], dtype=object)
                m = length_share(part.column("n").to_numpy(zero_copy_only=False), documents, terms)
                tree = Tree(ids[some], m[some], paths, tf[some])
                for heap, (_, own, w) in zip(best, items):
                    if len(own):
                        tree.search(own, w, heap, top)
        out = [(k, items[k][0], None if -i == NO_ID else -i, s) for k, heap in enumerate(best) for s, i in heap]
        columns = list(zip(*out)) or [(), (), (), ()]
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["item", "item_id", "doc_id", "score"])

    return vectors.mapInArrow(run, "item long, item_id long, doc_id long, score long")


def search(docs: DataFrame, items: DataFrame, top: int = 50, block_terms: int = BLOCK_TERMS) -> DataFrame:
    """item_id, rank, doc_id and score of the ``top`` documents of every item."""
    spark: SparkSession = docs.sparkSession
    out = spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    first = [F.col("score").desc(), F.col("doc_id").asc_nulls_last()]
    for block in blocks(items, block_terms):
        vectors = store(restricted(docs, block.terms), "op11-vectors")
        df, documents, terms = frequencies(vectors, len(block.terms))
        found = best_of_tasks(vectors, block, df, documents, terms, top).withColumn("salt", F.pmod(F.xxhash64("doc_id"), F.lit(SALTS)))
        # an item's rows of all tasks are ranked in parts before they meet
        for keys in (["item", "salt"], ["item"]):
            found = found.withColumn("rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*first))).where(F.col("rank") <= top)
        out = out.unionByName(store(found.select("item_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score"), "op11-found"))
    return out
