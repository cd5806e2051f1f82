"""Byte-level BPE encoding and decoding (operator 2).

A pre-token is a doubly linked list of symbols.  A priority queue holds the
merge rank of each adjacent pair that has one; the lowest rank (leftmost on a
tie) is popped and merged, its neighbours get new entries, and entries whose
symbols have changed since are skipped.  Decoding concatenates the vocabulary
strings of the ids.

Encoding is row-local: no shuffle, and the vocabulary file (read on the driver,
under 2 MB) travels with the task.  Workers keep the ids of the
text chunks they met lately, so a frequent word is merged once.

Defined results: NULL text counts as empty and has no ids; special tokens of the
vocabulary that occur in a text get their own id, as the tokenizers library does
by default; repeated rows and ids are encoded each; other columns are ignored; an
empty table gives no row.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import re
from collections.abc import Iterator
from itertools import chain
from pathlib import Path

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.llm.common import exactly, rows_of, ship_package, worker_state

#: Chunks of a generation whose ids a worker keeps; it holds two generations.
CACHE_ENTRIES = 500_000

# Fixed value: the pattern that splits text before byte-level merges.  White space is spelled out
# because libraries differ on U+001C to U+001F.
_WS = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
PRE_TOKEN = regex.compile(
    rf"'s|'t|'re|'ve|'m|'ll|'d| ?\p{{L}}+| ?\p{{N}}+| ?[^{_WS}\p{{L}}\p{{N}}]+|[{_WS}]+(?![^{_WS}])|[{_WS}]+"
)
#: Pre-tokens never cross the start of these chunks, in texts that are ``even``.
CHUNK = re.compile(r" ?[^ \n]+|\n")
#: White space other than blanks and line breaks, as any of the libraries understands it.
ODD_SPACE = frozenset(c for c in map(chr, range(0x3001)) if (c.isspace() or re.match(rf"[{_WS}]", c)) and c not in " \n")


def even(text: str) -> bool:
    """White space is single blanks and line breaks, and ends no text."""
    return (
        "  " not in text and "\n\n" not in text and " \n" not in text and "\n " not in text
        and not text.endswith((" ", "\n")) and ODD_SPACE.isdisjoint(text)
    )


def byte_alphabet() -> list[str]:
    """The printable character that stands for each byte in a byte-level vocabulary."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    spare = iter(range(0x100, 0x200))
    return [chr(b) if b in set(printable) else chr(next(spare)) for b in range(256)]


class ByteBpe:
    """A byte-level BPE tokenizer from the JSON of a vocabulary file."""

    def __init__(self, content: str):
        data = json.loads(content)
        self.vocab: dict[str, int] = data["model"]["vocab"]
        merges = [m if isinstance(m, list) else m.split(" ") for m in data["model"]["merges"]]
        # by rank: the two symbols of a merge and what they become
        self.left = [self.vocab[a] for a, _ in merges]
        self.right = [self.vocab[b] for _, b in merges]
        self.merged = [self.vocab[a + b] for a, b in merges]
        self.ranks = {a << 32 | b: rank for rank, (a, b) in enumerate(zip(self.left, self.right))}
        alphabet = byte_alphabet()
        self.byte_ids = [self.vocab[c] for c in alphabet]
        to_byte = {c: b for b, c in enumerate(alphabet)}
        special = {t["content"]: t["id"] for t in data["added_tokens"]}
        self.strings: dict[int, bytes] = {i: bytes(to_byte[c] for c in s) for s, i in self.vocab.items()}
        self.strings.update({i: s.encode() for s, i in special.items()})
        self.special = special
        self.split_special = re.compile("(" + "|".join(map(re.escape, sorted(special, key=len, reverse=True))) + ")") if special else None
        # chunks met lately and, when those are many, the generation before
        self.chunks: dict[str, list[int]] = {}
        self.older: dict[str, list[int]] = {}

    def merge(self, token: str) -> list[int]:
        """Ids of one pre-token."""
        symbols = list(map(self.byte_ids.__getitem__, token.encode("utf-8", "surrogatepass")))
        n = len(symbols)
        rank_of = self.ranks.get
        # an entry is a rank and the position of its left symbol, in one number
        queue = [
            rank << 32 | i
            for i, pair in enumerate(zip(symbols, symbols[1:]))
            if (rank := rank_of(pair[0] << 32 | pair[1])) is not None
        ]
        if not queue:
            return symbols
        heapq.heapify(queue)
        pop, push = heapq.heappop, heapq.heappush
        left, right, merged = self.left, self.right, self.merged
        after = list(range(1, n + 1))
        before = list(range(-1, n - 1))
        symbols.append(-1)  # what stands after the last
        while queue:
            entry = pop(queue)
            rank, i = entry >> 32, entry & 0xFFFFFFFF
            j = after[i]
            if symbols[i] != left[rank] or symbols[j] != right[rank]:
                continue  # stale: one of the two has been merged since
            new = symbols[i] = merged[rank]
            symbols[j] = -1
            k = after[i] = after[j]
            if k < n:
                before[k] = i
                rank = rank_of(new << 32 | symbols[k])
                if rank is not None:
                    push(queue, rank << 32 | i)
            h = before[i]
            if h >= 0:
                rank = rank_of(symbols[h] << 32 | new)
                if rank is not None:
                    push(queue, rank << 32 | h)
        return [s for s in symbols if s >= 0]

    def _chunk(self, chunk: str) -> list[int]:
        ids = self.older.get(chunk)
        if ids is None:
            ids = [i for token in PRE_TOKEN.findall(chunk) for i in self.merge(token)]
        if len(chunk) <= 64:
            if len(self.chunks) >= CACHE_ENTRIES:
                self.older, self.chunks = self.chunks, {}
            self.chunks[chunk] = ids
        return ids

    def _plain(self, text: str) -> list[int]:
        pieces = CHUNK.findall(text) if even(text) else PRE_TOKEN.findall(text)
        found = list(map(self.chunks.get, pieces))
        if None in found:
            found = [ids or self.chunks.get(piece) or self._chunk(piece) for ids, piece in zip(found, pieces)]
        return list(chain.from_iterable(found))

    def encode(self, text: str) -> list[int]:
        """Ids of a whole text."""
        if not self.special or not self.split_special.search(text):
            return self._plain(text)
        return [
            i
            for part in self.split_special.split(text)
            if part
            for i in ([self.special[part]] if part in self.special else self._plain(part))
        ]

    def decode(self, ids: list[int]) -> str:
        """Text of a list of ids, special tokens included."""
        return b"".join(map(self.strings.__getitem__, ids)).decode("utf-8", "replace")


def load(content: str) -> ByteBpe:
    """The tokenizer of a vocabulary, built once in each worker."""
    return worker_state(("bpe", hashlib.md5(content.encode()).hexdigest()), lambda: ByteBpe(content))


def tokenize(docs: DataFrame, vocabulary: str) -> DataFrame:
    """doc_id and the list ``ids`` of every text."""
    ship_package(docs.sparkSession)
    content = Path(vocabulary).read_text(encoding="utf-8")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = load(content)
        for keys, texts in rows_of(batches, "doc_id", "text"):
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys, pa.int64()), pa.array([bpe.encode(t or "") for t in texts], pa.list_(pa.int32()))], ["doc_id", "ids"]
            )

    return exactly(docs, "doc_id", "text").select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "doc_id long, ids array<int>")


def detokenize(tokens: DataFrame, vocabulary: str) -> DataFrame:
    """doc_id and the ``text`` of every list ``ids`` (NULL: empty)."""
    ship_package(tokens.sparkSession)
    content = Path(vocabulary).read_text(encoding="utf-8")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = load(content)
        for keys, ids in rows_of(batches, "doc_id", "ids"):
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys, pa.int64()), pa.array([bpe.decode(i or []) for i in ids], pa.string())], ["doc_id", "text"]
            )

    return tokens.select(F.col("doc_id").cast("long"), "ids").mapInArrow(run, "doc_id long, text string")


def round_trip(docs: DataFrame, vocabulary: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256 and decoded_sha256 of every text: encoded,
    then decoded from the ids, in one pass."""
    ship_package(docs.sparkSession)
    content = Path(vocabulary).read_text(encoding="utf-8")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = load(content)
        for keys, texts in rows_of(batches, "doc_id", "text"):
            counts, ids_sha, text_sha = [], [], []
            for t in texts:
                ids = bpe.encode(t or "")
                counts.append(len(ids))
                ids_sha.append(hashlib.sha256(str(ids)[1:-1].replace(" ", "").encode()).hexdigest())
                text_sha.append(hashlib.sha256(bpe.decode(ids).encode()).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys, pa.int64()), pa.array(counts, pa.int64()), pa.array(ids_sha), pa.array(text_sha)],
                ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    return exactly(docs, "doc_id", "text").select(F.col("doc_id").cast("long"), "text").mapInArrow(
        run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    )
