"""Packing token sequences by minimum bin slack (operator 5).

Every document becomes token ids with an end id and is cut into windows of the
capacity and a remainder.  What is planned is only the multiset of remainder
lengths (at most ``capacity`` numbers, whatever the input):

* the longest length left opens a window; a subset-sum dynamic program over a
  bitset of reachable sums picks, from the lengths left, the multiset that comes
  closest to the rest of the window, and the counts are backtracked through the
  bitsets of the lengths passed;
* if a window still has slack, the head of one more piece fills it and the tail
  goes back as a new length, so only the last window of all can be short;
* a pattern is applied as often as its scarcest length allows.

The plan says for each length which ranks go to which window and offset.  Ranks
are numbered without a global sort: each tokenizing task numbers its own pieces
of a length, and the sums of the tasks before it are added.  Token ids are made
once and stored, then cut to the plan.

Defined results: NULL and empty text have one token, the end id; repeated rows
and ids are packed each; other columns are ignored; an empty table gives no row.
"""

from __future__ import annotations

import json
import os
import re
import zlib
from bisect import bisect_right
from collections.abc import Iterator
from itertools import chain
from pathlib import Path
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskloom.llm.common import exactly, rows_of, ship_package, store, worker_state

CAPACITY = 2048
END_ID = 1
#: Pieces of a generation whose ids a worker keeps; it holds two generations.  Longer ones are not kept.
CACHE_ENTRIES = 250_000
CACHE_CHARS = 64
#: Bytes of text whose words are looked up together.
GROUP_BYTES = 1 << 20

#: Latin letters whose lower case has one code point for each.
_LETTERS = "".join(c for c in map(chr, range(0x250)) if c.isalpha() and c != "\u0130")
_WORD = re.compile(f"[{_LETTERS}]+")
#: Marks that a splitter parts from letters; none begins a special token or an ending such as 's.
MARKS = "!#$%&()*+,-./:;=?@[]^_`{}~"
#: Marks between letters and white space: there a text may be cut.
_BESIDE = rf"[\s{_LETTERS}]"
_CUT = rf"(^|{_BESIDE})([{re.escape(MARKS)}]+)({_BESIDE}|$)"
#: Texts with these are cut at white space only: their lower case may differ from the file's rule.
_OTHER = r"[^\x00-\x{24f}]|\x{130}"
#: White space to Arrow only: such a text is not cut at all.
_SPLIT_ONLY = r"[\x1c-\x1f]"


class Use(NamedTuple):
    """Pieces of one length, ranks ``rank`` to ``rank + items - 1``: ``per_window``
    of them go to each window from ``window`` on, the first at ``offset``.  Only the
    first ``used`` ids of a piece go there; the tail is a piece of length
    ``length - used`` with ranks from ``tail_rank`` on."""

    rank: int
    items: int
    window: int
    per_window: int
    offset: int
    used: int
    tail_rank: int


def best_fill(room: int, counts: dict[int, int]) -> dict[int, int]:
    """The sub-multiset of ``counts`` (length: how many) with the largest sum of
    at most ``room``."""
    mask = (1 << (room + 1)) - 1
    reach, passed = 1, []
    for length in sorted(counts, reverse=True):
        if length > room:
            continue
        passed.append((length, reach))
        for _ in range(min(counts[length], room // length)):
            more = reach | (reach << length) & mask
            if more == reach:
                break
            reach = more
        if reach >> room:
            break  # the window can be filled
    total = reach.bit_length() - 1
    chosen = {}
    for length, before in reversed(passed):
        n = 0
        while not before >> total & 1:
            total -= length
            n += 1
        if n:
            chosen[length] = n
    return chosen


def plan_windows(histogram: dict[int, int], capacity: int = CAPACITY) -> tuple[dict[int, list[Use]], int]:
    """The uses of each length, and the number of windows."""
    left = {k: n for k, n in histogram.items() if n > 0}
    ranks = dict.fromkeys(left, 0)  # next rank to be placed
    supply = dict(left)  # ranks handed out so far
    uses: dict[int, list[Use]] = {}
    windows = 0
    while left:
        longest = max(left)
        rest = dict(left)
        rest[longest] -= 1
        rest = {k: n for k, n in rest.items() if n}
        pattern = best_fill(capacity - longest, rest)
        pattern[longest] = pattern.get(longest, 0) + 1
        slack = capacity - sum(k * n for k, n in pattern.items())
        cut = 0
        if slack:
            spare = {k: n - pattern.get(k, 0) for k, n in left.items()}
            cut = max((k for k, n in spare.items() if n > 0 and k > slack), default=0)
        need = dict(pattern)
        if cut:
            need[cut] = need.get(cut, 0) + 1
        times = min(left[k] // n for k, n in need.items())
        offset = 0
        for k, n in sorted(pattern.items(), reverse=True):
            uses.setdefault(k, []).append(Use(ranks[k], n * times, windows, n, offset, k, 0))
            ranks[k] += n * times
            left[k] -= n * times
            offset += n * k
        if cut:
            tail = cut - slack
            uses.setdefault(cut, []).append(Use(ranks[cut], times, windows, 1, offset, slack, supply.get(tail, 0)))
            ranks[cut] += times
            left[cut] -= times
            left[tail] = left.get(tail, 0) + times
            supply[tail] = supply.get(tail, 0) + times
            ranks.setdefault(tail, 0)
        windows += times
        left = {k: n for k, n in left.items() if n}
    return uses, windows


def place(length: int, rank: int, uses: dict[int, list[Use]], starts: dict[int, list[int]]) -> Iterator[tuple[int, int, int, int]]:
    """(first id, number of ids, window, offset) of each part of a piece."""
    first = 0
    while length:
        use = uses[length][bisect_right(starts[length], rank) - 1]
        index, slot = divmod(rank - use.rank, use.per_window)
        yield first, use.used, use.window + index, use.offset + slot * use.used
        first += use.used
        length, rank = length - use.used, use.tail_rank + (rank - use.rank)


def packed(ids: list[int]) -> bytes:
    """Ids as little-endian unsigned 32-bit numbers."""
    return np.array(ids, dtype="<u4").tobytes()


class WordIds:
    """Ids of a tokenizers file that lower-cases, never joins characters across white space and
    parts letters from marks.  Pieces met lately are looked up."""

    def __init__(self, content: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(content)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        suffix = json.loads(content)["model"].get("end_of_word_suffix")
        self.ends = np.zeros(self.tokenizer.get_vocab_size(True) + 1, dtype=bool)
        self.ends[[i for t, i in self.tokenizer.get_vocab(False).items() if suffix and t.endswith(suffix)]] = True
        # ids of each, as little-endian 32-bit numbers
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        self.cuts = self._parts_letters_from_marks()

    def _parts_letters_from_marks(self) -> bool:
        """Whether cut and lower-cased pieces have the ids of the whole text."""
        probe = 'It\'s "A-b" (C.d), e!! f_G ÀÉ-x... 3.5 h/2 I\'ll\tMe&you @k\n#l [m] n;o  p: q'
        return b"".join(self._whole(self._spaced(pa.array([probe]))[0].as_py().split())) == self._whole([probe])[0]

    def _whole(self, texts: list[str]) -> list[bytes]:
        return [packed(e.ids) for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    @staticmethod
    def _spaced(texts: pa.Array) -> pa.Array:
        """The texts with white space at every place where they may be cut.  A mark that stands
        beside a letter that the mark before has used up is met the second time."""
        cut = pc.utf8_lower(texts)
        for _ in range(2):
            cut = pc.replace_substring_regex(cut, pattern=_CUT, replacement=r"\1 \2 \3")
        return pc.if_else(pc.match_substring_regex(texts, pattern=_OTHER), texts, cut)

    def _learn(self, pieces: set[str]) -> None:
        older, known, words, others = self.older, self.known, [], []
        word = _WORD.fullmatch
        for w in pieces:
            ids = older.get(w)
            if ids is not None:
                known[w] = ids
            else:
                (words if word(w) else others).append(w)
        known.update(zip(others, self._whole(others)))
        # words of letters, many in one call: a word ends at an id that the vocabulary marks as a word's end
        blocks = [words[i : i + 128] for i in range(0, len(words), 128)]
        for block, e in zip(blocks, self.tokenizer.encode_batch_fast([" ".join(b) for b in blocks], add_special_tokens=False)):
            ids = np.array(e.ids, dtype="<u4")
            ends = np.flatnonzero(self.ends[ids]) + 1
            if len(ends) == len(block) and ends[-1] == len(ids):
                raw, bounds = ids.tobytes(), (4 * ends).tolist()
                known.update(zip(block, map(raw.__getitem__, map(slice, [0, *bounds], bounds))))
            else:  # a vocabulary without such marks
                known.update(zip(block, self._whole(block)))

    def _ids(self, pieces: list[str]) -> list[bytes]:
        """Ids of different pieces, looked up or learned."""
        if len(self.known) > CACHE_ENTRIES:
            self.older, self.known = self.known, {}
        missing = set(pieces).difference(self.known)
        if missing:
            self._learn(missing)
        out = list(map(self.known.__getitem__, pieces))
        for w in missing:
            if len(w) > CACHE_CHARS:
                del self.known[w]
        return out

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts one after the other, and where each begins and ends.  Each
        different piece is looked up once, its occurrences are filled in by number."""
        odd = pc.match_substring_regex(texts, pattern=_SPLIT_ONLY).to_numpy(zero_copy_only=False) | (not self.cuts)
        split = pc.utf8_split_whitespace(pc.if_else(pa.array(odd), "", self._spaced(texts)) if odd.any() else self._spaced(texts))
        words = split.flatten()
        bounds = np.concatenate([[0], np.cumsum(pc.list_value_length(split).to_numpy(zero_copy_only=False), dtype=np.int64)])
        some = np.flatnonzero(pc.binary_length(words).to_numpy(zero_copy_only=False))  # at its ends a split leaves empty ones
        bounds = np.searchsorted(some, bounds)
        coded = words.take(pa.array(some)).dictionary_encode()
        blobs = self._ids(coded.dictionary.to_numpy(zero_copy_only=False).tolist())
        at = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        if odd.any():
            whole = np.flatnonzero(odd)
            at = np.insert(at, bounds[whole], len(blobs) + np.arange(len(whole)))
            blobs += self._whole(texts.take(pa.array(whole)).to_pylist())
            bounds = bounds + np.concatenate([[0], np.cumsum(odd)])
        lengths = np.fromiter(map(len, blobs), dtype=np.int64, count=len(blobs)) // 4
        starts = np.cumsum(lengths) - lengths
        ids = np.frombuffer(b"".join(blobs), dtype="<u4")
        n = lengths[at]
        ends = np.concatenate([[0], np.cumsum(n)])
        return ids[np.repeat(starts[at] - ends[:-1], n) + np.arange(ends[-1])], ends[bounds]


def in_groups(batch: pa.RecordBatch, size: int) -> Iterator[pa.RecordBatch]:
    """Slices of a batch of about ``size`` bytes of text, one row at least."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column("text")), 0).to_numpy(zero_copy_only=False), dtype=np.int64)
    at = 0
    while at < batch.num_rows:
        done = ends[at - 1] if at else 0
        to = max(at + 1, int(np.searchsorted(ends, done + size, side="right")))
        yield batch.slice(at, to - at)
        at = to


def load(content: str) -> WordIds:
    """The tokenizer of a file, built once in each worker."""
    return worker_state(("packing", hash(content)), lambda: WordIds(content))


PIECES = "task int, rank long, doc_id long, start long, length int, doc_tokens long, ids binary"


def pieces(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """Windows and remainders of the token ids of every text (little-endian
    unsigned 32 bits), numbered by task and length."""
    ship_package(docs.sparkSession)
    content = Path(tokenizer).read_text(encoding="utf-8")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, task, seen, end = load(content), TaskContext.get().partitionId(), {}, packed([end_id])
        kinds = [pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.binary()]
        for group in (g for batch in batches for g in in_groups(batch, GROUP_BYTES)):
            out: list[tuple] = []
            every, bounds = words.encode(pc.fill_null(group.column("text"), ""))
            for key, a, b in zip(group.column("doc_id").to_pylist(), bounds.tolist(), bounds[1:].tolist()):
                ids = every[a:b].tobytes() + end
                total = b - a + 1
                for at in range(0, total, capacity):
                    size = min(capacity, total - at)
                    rank = seen.get(size, 0)
                    seen[size] = rank + 1
                    out.append((task, rank, key, at, size, total, ids[4 * at : 4 * (at + size)]))
            for at in range(0, len(out), 1024):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, k) for c, k in zip(zip(*out[at : at + 1024]), kinds)], ["task", "rank", "doc_id", "start", "length", "doc_tokens", "ids"]
                )

    return exactly(docs, "doc_id", "text").select(F.col("doc_id").cast("long"), "text").mapInArrow(run, PIECES)


def pack(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """One row for each piece: doc_id, start, length, ids (binary), doc_tokens,
    sequence_id and offset."""
    cut = store(pieces(docs, tokenizer, capacity, end_id), "op5-pieces")
    per_task = cut.groupBy("length", "task").agg(F.count(F.lit(1)).alias("n"))
    per_task = store(per_task, "op5-lengths")
    # at most ``capacity`` rows come to the driver
    histogram = {r.length: r.n for r in per_task.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    uses, _ = plan_windows(histogram, capacity)
    starts = {k: [u.rank for u in us] for k, us in uses.items()}
    before = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    bases = per_task.select("length", "task", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in rows_of(batches, "doc_id", "start", "length", "doc_tokens", "ids", "rank", "base"):
            out: list[tuple] = []
            for doc_id, start, length, total, ids, rank, base in zip(*rows):
                for first, n, window, offset in place(length, base + rank, uses, starts):
                    own = ids[4 * first : 4 * (first + n)]
                    out.append((doc_id, start + first, n, own, total, window, offset))
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(zip(*out), kinds)],
                ["doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"],
            )

    return cut.join(bases, ["length", "task"]).mapInArrow(
        run, "doc_id long, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long"
    )


def crc_of_ids(packed: DataFrame) -> DataFrame:
    """The columns of ``pack`` with the checksum of the ids in place of the ids."""
    return packed.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def checksum(ids: list[int]) -> int:
    """crc32 of ids as little-endian unsigned 32-bit numbers."""
    return zlib.crc32(packed(ids))
