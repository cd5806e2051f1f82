"""Removal of repeated passages by suffix sorting with a difference cover (operator 9).

A byte goes if a string of ``WINDOW`` bytes that covers it also starts in a document with a
smaller id.  To find these, suffixes are sorted far enough to tell their first ``WINDOW`` bytes.

Where suffixes are sorted together: a window is represented by its smallest hashed
``GRAM``-byte string, the first one of several (its anchor), which depends on the window's bytes
only, so equal windows have equal anchors.  Neighbouring windows with one anchor are a run; its
surroundings are the bytes that they cover.  Anchors that occur in one text only cannot belong to a
repeated window and are left out.  To tell which these are, tasks pack the anchors of many texts
into arrays by hash; an anchor that a task meets in two texts is known to be shared there, the
others meet in Spark, an array of each task for each bucket of hashes.  The surroundings of every
shared anchor are brought together by anchor, equal ones once with their smallest id.

How they are sorted: the surroundings of whole anchors are joined to one string, whose suffix
array is built by the difference-cover algorithm (mod 3): suffixes at positions 1 and 2 mod 3
are sorted by their triples and named, the string of names is sorted recursively where names
repeat, the remaining suffixes are sorted by their first byte and the rank behind it, and the
two orders are merged by binary search.  Neighbours in the suffix array whose first ``WINDOW``
bytes are equal form a class, which gets its smallest document id.  An anchor with more than
``GROUP`` different surroundings would not fit one string: its windows are grouped one by
one by Spark instead.

Exact copies of a text are settled first (all but the smallest id lose every byte if they
have ``WINDOW`` of them), so they add no suffixes.  Long texts are worked on in pieces of
``PIECE`` windows.

Defined results: NULL text counts as empty; texts shorter than ``WINDOW`` bytes stay;
rows with the same id do not remove from each other; a NULL id counts as larger than all
others; other columns are ignored; an empty table gives no row.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.llm.common import discard, exactly, partitions, rows_of, ship_package, store

WINDOW = 50
GRAM = 20
#: Anchor positions of a window.
CHOICES = WINDOW - GRAM + 1
#: Different surroundings of an anchor that are sorted as one string.
GROUP = 4096
#: Surroundings that are joined to one string, as far as whole anchors allow.
TOGETHER = 8192
#: Bytes that are hashed at a time; a place among them fits the low bits of a hash.
BLOCK = 1 << 18
LOW = np.uint64((1 << 19) - 1)
#: Windows of a piece of a text, anchors that a task packs at a time, and buckets of a shuffle partition.
PIECE = 1 << 20
PACKED = 1 << 18
BUCKETS = 4
NO_ID = 2**63 - 1

# Odd multipliers of the rolling combination.
_M = tuple(np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F))
_BYTE = (np.arange(1, 257, dtype=np.uint64) * _M[3]) ^ ((np.arange(1, 257, dtype=np.uint64) * _M[4]) >> np.uint64(23))


def gram_hashes(codes: np.ndarray) -> np.ndarray:
    """Hashes of all strings of ``GRAM`` (20) bytes, by doubling their length."""
    h = _BYTE[codes]
    two = h[:-1] * _M[0] + h[1:]
    four = two[:-2] * _M[1] + two[2:]
    eight = four[:-4] * _M[2] + four[4:]
    sixteen = eight[:-8] * _M[3] + eight[8:]
    twenty = sixteen[:-4] * _M[4] + four[16:]
    twenty ^= twenty >> np.uint64(29)
    twenty *= _M[0]
    twenty ^= twenty >> np.uint64(32)
    return twenty


def _sliding(values: np.ndarray, width: int, pick) -> np.ndarray:
    """``pick`` (minimum or maximum) over every run of ``width`` values."""
    size, out = 1, values
    while size * 2 <= width:
        out = pick(out[:-size], out[size:])
        size *= 2
    rest = width - size
    return pick(out[: len(out) - rest], out[rest:]) if rest else out


def anchors(data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Runs of windows with one anchor: the first window, the number of windows, the bytes from
    the first window to the anchor, and the anchor's hash."""
    parts = []
    for at in range(0, len(data) - WINDOW + 1, BLOCK):
        h = gram_hashes(np.frombuffer(data, dtype=np.uint8, offset=at, count=min(BLOCK + WINDOW - 1, len(data) - at)))
        ordered = (h & ~LOW) | np.arange(len(h), dtype=np.uint64)  # equal hashes in the order of their places
        place = (_sliding(ordered, CHOICES, np.minimum) & LOW).astype(np.int64)  # of each window's anchor
        first = np.flatnonzero(np.concatenate([[True], place[1:] != place[:-1]]))
        parts.append((first + at, np.diff(np.append(first, len(place))), place[first] - first, h[place[first]].view(np.int64)))
    if not parts:
        return tuple(np.zeros(0, dtype=np.int64) for _ in range(4))
    return tuple(np.concatenate(c) for c in zip(*parts))


def suffix_array(s: np.ndarray) -> np.ndarray:
    """Order of all suffixes of ``s`` (numbers from 1 up), by the difference cover
    {1, 2} mod 3.  Lengths up to 2 ** 21."""
    n = len(s)
    if n < 3:
        return np.array(sorted(range(n), key=lambda i: s[i:].tolist()), dtype=np.int64)
    text = np.concatenate([s.astype(np.uint64), np.zeros(3, dtype=np.uint64)])
    bits = np.uint64(int(text.max()).bit_length())
    one, two = np.arange(1, n + (n % 3 == 1), 3), np.arange(2, n, 3)
    sample = np.concatenate([one, two])
    triples = (text[sample] << bits << bits) | (text[sample + 1] << bits) | text[np.minimum(sample + 2, n + 2)]
    order = np.argsort(triples)
    ordered = triples[order]
    new = np.concatenate([[True], ordered[1:] != ordered[:-1]])
    names = np.empty(len(sample), dtype=np.int64)
    names[order] = np.cumsum(new)
    if not new.all():  # names repeat: sort the string of names
        order = suffix_array(names)
    rank = np.zeros(n + 4, dtype=np.uint64)
    rank[sample[order]] = np.arange(1, len(sample) + 1, dtype=np.uint64)
    sampled = sample[order]
    sampled = sampled[sampled < n]
    wide = np.uint64((len(sample) + 1).bit_length())
    zero = np.arange(0, n, 3)
    by_one = (text[zero] << wide) | rank[zero + 1]
    zero = zero[np.argsort(by_one)]
    # places of the remaining suffixes among those at 1 and at 2 mod 3
    at_one, at_two = sampled[sampled % 3 == 1], sampled[sampled % 3 == 2]
    behind = np.searchsorted((text[at_one] << wide) | rank[at_one + 1], (text[zero] << wide) | rank[zero + 1])
    pair = lambda i: (text[i] << bits << wide) | (text[i + 1] << wide) | rank[i + 2]
    behind = behind + np.searchsorted(pair(at_two), pair(zero))
    out = np.empty(n, dtype=np.int64)
    place = behind + np.arange(len(zero))
    out[place] = zero
    free = np.ones(n, dtype=bool)
    free[place] = False
    out[free] = sampled
    return out


def smallest_ids(contexts: list[bytes], windows: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """For each window of each context (``windows`` of them, from its start), in order, the
    smallest of the ids of the contexts that have an equal window."""
    lengths = np.array([len(c) for c in contexts], dtype=np.int64)
    starts = np.concatenate([[0], np.cumsum(lengths + 1)])[:-1]  # a separator behind each
    joined = np.frombuffer(b"\x00".join(contexts) + b"\x00", dtype=np.uint8)
    s = joined.astype(np.int64) + 2
    s[starts + lengths] = 1
    owner = np.repeat(np.arange(len(contexts)), windows)
    first = np.concatenate([[0], np.cumsum(windows)])
    where = starts[owner] + np.arange(len(owner)) - first[owner]
    number = np.full(len(s), -1, dtype=np.int64)
    number[where] = np.arange(len(where))
    ranked = number[suffix_array(s)]
    ranked = ranked[ranked >= 0]  # windows in the order of their suffixes
    bytes_of = np.lib.stride_tricks.sliding_window_view(joined, WINDOW)[where[ranked]]
    new = np.concatenate([[True], (bytes_of[1:] != bytes_of[:-1]).any(axis=1)])
    least = np.minimum.reduceat(ids[owner[ranked]], np.flatnonzero(new))
    out = np.empty(len(owner), dtype=np.int64)
    out[ranked] = least[np.cumsum(new) - 1]
    return out


def _data(text: str | None) -> bytes:
    return (text or "").encode("utf-8", "surrogatepass")


def _rows(docs: DataFrame) -> DataFrame:
    """doc_id (NULL: the largest number), text, and a hash ``content`` of the text."""
    text = F.coalesce("text", F.lit(""))
    return exactly(docs, "doc_id", "text").select(F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("doc_id"), text.alias("text"), F.xxhash64(text).alias("content"))


_PACKED = "bucket int, sure boolean, first long, anchors binary, texts binary, begins binary, shapes binary"


def _pack_anchors(buckets: int):
    """Anchors of the texts of a task, packed by bucket of their hash.  Texts are numbered on from
    ``first``.  Rows that are ``sure`` hold anchors that several of these texts have; for
    other tasks one of them is also among the bucket's, with the text number -1."""
    kinds = [pa.int32(), pa.bool_(), pa.int64(), pa.binary(), pa.binary(), pa.binary(), pa.binary()]
    names = ["bucket", "sure", "first", "anchors", "texts", "begins", "shapes"]

    def pack(first: int, found: list[tuple]) -> Iterator[pa.RecordBatch]:
        sizes = [len(f[0]) for f in found]
        begin, windows, left, anchor = (np.concatenate(c) for c in zip(*found))
        if not len(anchor):
            return
        text = np.repeat(np.arange(len(found)), sizes)
        shape = left * 64 + windows
        order = np.argsort(anchor, kind="stable")  # of one anchor in the order of the texts
        ordered, owner = anchor[order], text[order]
        heads = np.flatnonzero(np.concatenate([[True], ordered[1:] != ordered[:-1]]))
        several = owner[heads] != owner[np.append(heads[1:], len(owner)) - 1]
        sure = np.empty(len(anchor), dtype=bool)
        sure[order] = np.repeat(several, np.diff(np.append(heads, len(ordered))))
        known = ordered[heads[several]]
        rest = np.flatnonzero(~sure)
        columns = [
            np.concatenate([anchor[rest], known]), np.concatenate([text[rest], np.full(len(known), -1)]).astype("<i4"),
            np.concatenate([begin[rest], np.zeros(len(known), dtype=np.int64)]).astype("<u4"), np.concatenate([shape[rest], np.zeros(len(known), dtype=np.int64)]).astype("<u2"),
        ]
        bucket = ((columns[0].view(np.uint64) >> np.uint64(33)) * np.uint64(buckets) >> np.uint64(31)).astype(np.int64)
        order = np.argsort(bucket, kind="stable")
        columns = [c[order] for c in columns]
        bounds = np.searchsorted(bucket[order], np.arange(buckets + 1))
        rows = [(k, False, first, *[c[a:b].tobytes() for c in columns]) for k, (a, b) in enumerate(zip(bounds.tolist(), bounds[1:].tolist())) if b > a]
        here = np.flatnonzero(sure)
        for at in range(0, len(here), 65536):
            some = here[at : at + 65536]
            rows.append((
                (first + at // 65536) % buckets, True, first, anchor[some].tobytes(), text[some].astype("<i4").tobytes(),
                begin[some].astype("<u4").tobytes(), shape[some].astype("<u2").tobytes(),
            ))
        for at in range(0, len(rows), 64):
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows[at : at + 64]), kinds)], names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first, held, size = 0, [], 0
        for numbers, pieces in rows_of(batches, "t", "data"):
            for t, data in zip(numbers, pieces):
                if held and (size >= PACKED or t != first + len(held)):
                    yield from pack(first, held)
                    held, size = [], 0
                if not held:
                    first = t
                held.append(anchors(data))
                size += len(held[-1][0])
        if held:
            yield from pack(first, held)

    return run


def _shared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows in order of their buckets: the places of the anchors that several texts have."""

    def places(anchor, t, begin, shape) -> Iterator[pa.RecordBatch]:
        for at in range(0, len(anchor), 65536):
            part = slice(at, at + 65536)
            yield pa.RecordBatch.from_arrays(
                [pa.array(t[part]), pa.array(begin[part].astype(np.int64)), pa.array(shape[part].astype(np.int32)), pa.array(anchor[part])],
                ["t", "begin", "shape", "anchor"],
            )

    def arrays(rows: list[tuple]) -> tuple[np.ndarray, ...]:
        unpack = lambda k, kind: np.concatenate([np.frombuffer(r[k], dtype=kind) for r in rows])
        text = unpack(2, "<i4")
        t = np.repeat(np.array([r[0] for r in rows], dtype=np.int64), [len(r[2]) // 4 for r in rows]) + text
        return unpack(1, "<i8"), np.where(text < 0, -1, t), unpack(3, "<u4"), unpack(4, "<u2")

    def done(rows: list[tuple]) -> Iterator[pa.RecordBatch]:
        anchor, t, begin, shape = arrays(rows)
        order = np.lexsort((t, anchor))  # -1, shared in another task, comes first
        anchor, t, begin, shape = anchor[order], t[order], begin[order], shape[order]
        heads = np.flatnonzero(np.concatenate([[True], anchor[1:] != anchor[:-1]]))
        sizes = np.diff(np.append(heads, len(anchor)))
        shared = (t[heads] != t[heads + sizes - 1]) & (t[heads + sizes - 1] >= 0)
        chosen = np.repeat(shared, sizes) & (t >= 0)
        yield from places(anchor[chosen], t[chosen], begin[chosen], shape[chosen])

    held: list[tuple] = []
    now = None
    for batch in batches:
        for k in range(batch.num_rows):  # one row at a time: a row holds many anchors
            bucket, sure, *row = (batch.column(c)[k].as_py() for c in range(7))
            if sure:
                yield from places(*arrays([row]))
                continue
            if held and bucket != now:
                yield from done(held)
                held = []
            now = bucket
            held.append(row)
    if held:
        yield from done(held)


_CONTEXT = "anchor long, key long, doc_id long, content long, begin long, windows int, context binary"


def _contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The surroundings of each run of windows."""
    for whole in batches:
        for at in range(0, whole.num_rows, 256):
            batch = whole.slice(at, 256)
            marks = batch.column("marks")
            sizes = pc.list_value_length(marks).to_numpy(zero_copy_only=False)
            begin, shape, anchor = (marks.flatten().field(k).to_numpy(zero_copy_only=False) for k in range(3))
            left, windows = shape >> 6, shape & 63
            around: list[bytes] = []
            first = 0
            for data, n in zip(batch.column("data").to_pylist(), sizes.tolist()):
                here = slice(first, first + n)
                around += [data[b:e] for b, e in zip(begin[here].tolist(), (begin[here] + windows[here] + WINDOW - 1).tolist())]
                first += n
            # with the anchor, 128 bits that stand for surroundings and the anchor's place in them
            keys = np.array([xxhash.xxh3_64_intdigest(c, seed=k) for c, k in zip(around, left.tolist())], dtype=np.uint64).view(np.int64)
            ids = [np.repeat(batch.column(c).to_numpy(zero_copy_only=False), sizes) for c in ("doc_id", "content", "offset")]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(anchor), pa.array(keys), pa.array(ids[0]), pa.array(ids[1]), pa.array(ids[2] + begin),
                    pa.array(windows.astype(np.int32)), pa.array(around, pa.binary()),
                ],
                ["anchor", "key", "doc_id", "content", "begin", "windows", "context"],
            )


def _sort_groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows in order of their anchors: whole anchors are sorted together.  The list of a row
    has the smallest id of each of its windows, or one that holds for all."""
    held: pa.Table | None = None

    def batch(keys: pa.Table, values: np.ndarray, sizes: np.ndarray) -> pa.RecordBatch:
        offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
        least = pa.ListArray.from_arrays(pa.array(offsets), pa.array(values))
        columns = [keys.column(c).combine_chunks() for c in ("anchor", "key")]
        return pa.RecordBatch.from_arrays([*columns, least], ["anchor", "key", "least"])

    def done(rows: pa.Table) -> Iterator[pa.RecordBatch]:
        anchor = rows.column("anchor").to_numpy()
        starts = np.flatnonzero(np.concatenate([[True], anchor[1:] != anchor[:-1]]))
        alone = np.repeat(np.diff(np.append(starts, len(anchor))) == 1, np.diff(np.append(starts, len(anchor))))
        # the only surroundings of an anchor: no other text has a window of them
        single = rows.filter(pa.array(alone))
        if single.num_rows:
            yield batch(single, single.column("first_id").to_numpy(), np.ones(single.num_rows, dtype=np.int64))
        several = rows.filter(pa.array(~alone))
        if several.num_rows:
            windows = several.column("windows").to_numpy().astype(np.int64)
            yield batch(several, smallest_ids(several.column("context").to_pylist(), windows, several.column("first_id").to_numpy()), windows)

    for b in batches:
        held = pa.Table.from_batches([b]) if held is None else pa.concat_tables([held, pa.Table.from_batches([b])])
        if held.num_rows < TOGETHER:
            continue
        anchor = held.column("anchor").to_numpy()
        cut = int(np.searchsorted(anchor, anchor[-1]))  # the last anchor may go on
        yield from done(held.slice(0, cut)) if cut else ()
        held = held.slice(cut)
    if held is not None and held.num_rows:
        yield from done(held)


def _spans(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Runs of bytes to remove, as far as one anchor shows them: its windows overlap, so what
    they cover is one run."""
    for batch in batches:
        if not batch.num_rows:
            continue
        doc_id, content, begin, windows = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("doc_id", "content", "begin", "windows"))
        sizes = pc.list_value_length(batch.column("least")).to_numpy(zero_copy_only=False).astype(np.int64)
        starts = np.cumsum(sizes) - sizes
        gone = batch.column("least").flatten().to_numpy(zero_copy_only=False) < np.repeat(doc_id, sizes)
        place = np.arange(len(gone)) - np.repeat(starts, sizes)
        first = np.minimum.reduceat(np.where(gone, place, WINDOW), starts)
        last = np.maximum.reduceat(np.where(gone, place, -1), starts)
        found = last >= 0
        last = np.where(sizes == 1, windows - 1, last)  # one id for all windows
        yield pa.RecordBatch.from_arrays(
            [pa.array(c[found]) for c in (doc_id, content, begin + first, begin + last + WINDOW)], ["doc_id", "content", "begin", "end"]
        )


def merge_spans(begin: np.ndarray, end: np.ndarray) -> list[tuple[int, int]]:
    """Maximal runs of overlapping or touching spans."""
    if not len(begin):
        return []
    order = np.argsort(begin)
    begin, end = begin[order], np.maximum.accumulate(end[order])
    new = np.flatnonzero(begin[1:] > end[:-1]) + 1
    return list(zip(begin[np.append(0, new)].tolist(), end[np.append(new - 1, len(end) - 1)].tolist()))


def pieces(rows: DataFrame, firsts: DataFrame) -> DataFrame:
    """The first row of each text, cut into pieces that overlap by what a window needs, numbered
    ``t`` within the stored partitions."""
    once = rows.join(firsts.select("content", "doc_id"), ["content", "doc_id"], "left_semi").withColumn("data", F.col("text").cast("binary")).drop("text")
    once = once.where(F.length("data") >= WINDOW)
    parts = F.expr(f"sequence(0L, (length(data) - {WINDOW}) div {PIECE})")
    cut = once.withColumn("_k", F.explode(parts)).select(
        "doc_id", "content", (F.col("_k") * PIECE).alias("offset"), F.expr(f"substring(data, int(_k * {PIECE} + 1), {PIECE + WINDOW - 1})").alias("data")
    )
    return store(cut.withColumn("t", F.monotonically_increasing_id()), "op9-pieces", "zstd")


def contexts_of_repeats(rows: DataFrame, firsts: DataFrame) -> DataFrame:
    """The surroundings of every anchor that occurs in two different texts, in the first row of each text."""
    texts = pieces(rows, firsts)
    count = partitions(rows.sparkSession)
    packed = texts.select("t", "data").mapInArrow(_pack_anchors(BUCKETS * count), _PACKED)
    places = packed.repartition(count, "bucket").sortWithinPartitions("bucket").mapInArrow(_shared, "t long, begin long, shape int, anchor long")
    kept = store(places, "op9-places", "zstd")
    marks = kept.groupBy("t").agg(F.collect_list(F.struct("begin", "shape", "anchor")).alias("marks"))
    out = store(texts.join(marks, "t").select("doc_id", "content", "offset", "data", "marks").mapInArrow(_contexts, _CONTEXT), "op9-contexts", "zstd")
    discard(texts, kept)
    return out


def repeated_spans(contexts: DataFrame, group: int = GROUP) -> DataFrame:
    """(doc_id, content, begin, end) of bytes that also stand in a document with a smaller id."""
    count = partitions(contexts.sparkSession)
    different = contexts.groupBy("anchor", "key").agg(F.min("doc_id").alias("first_id"), F.first("windows").alias("windows"), F.first("context").alias("context"))
    different = store(different, "op9-different", "zstd")
    crowded = different.groupBy("anchor").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > group).select("anchor")
    crowded = store(crowded, "op9-crowded")  # its size is known then, so that Spark need not move the other side
    few = different.join(crowded, "anchor", "left_anti")
    sorted_ = few.repartition(count, "anchor").sortWithinPartitions("anchor").mapInArrow(_sort_groups, "anchor long, key long, least array<bigint>")
    # too many surroundings for one string: window by window
    windows = different.join(crowded, "anchor", "left_semi").select(
        "anchor", "key", "first_id", "context", F.explode(F.expr("sequence(0, windows - 1)")).alias("start")
    ).select("anchor", "key", "first_id", "start", F.expr(f"substring(context, start + 1, {WINDOW})").alias("window"))
    smallest = windows.groupBy("window").agg(F.min("first_id").alias("smallest"))
    singly = windows.join(smallest, "window").groupBy("anchor", "key").agg(
        F.transform(F.sort_array(F.collect_list(F.struct("start", "smallest"))), lambda x: x["smallest"]).alias("least")
    )
    least = store(sorted_.unionByName(singly), "op9-least", "zstd")
    discard(different)
    placed = contexts.select("anchor", "key", "doc_id", "content", "begin", "windows").join(least, ["anchor", "key"])
    return placed.mapInArrow(_spans, "doc_id long, content long, begin long, end long")


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.list_(pa.struct([("begin", pa.int64()), ("end", pa.int64())]))]
    names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "removed"]
    for batch in (whole.slice(at, 256) for whole in batches for at in range(0, whole.num_rows, 256)):
        spans = batch.column("spans")
        sizes = pc.fill_null(pc.list_value_length(spans), 0).to_numpy(zero_copy_only=False)
        begins, ends = (spans.flatten().field(k).to_numpy(zero_copy_only=False) for k in range(2))
        out, first = [], 0
        for doc_id, text, copy, n in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "text", "copy")), sizes.tolist()):
            data = _data(text)
            if copy:
                gone = [(0, len(data))] if len(data) >= WINDOW else []
            else:
                gone = merge_spans(begins[first : first + n], ends[first : first + n])
            first += n
            at, kept = 0, hashlib.sha256()
            for begin, end in gone:
                kept.update(data[at:begin])
                at = end
            kept.update(data[at:])
            out.append((None if doc_id == NO_ID else doc_id, len(data), sum(e - b for b, e in gone), len(gone), kept.hexdigest(), [{"begin": b, "end": e} for b, e in gone]))
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names)


def suffix_dedup(docs: DataFrame, group: int = GROUP) -> DataFrame:
    """One row for each row of ``docs``: doc_id, n_bytes, n_removed, n_spans, kept_sha256, and the runs
    ``removed`` (begin, end in bytes)."""
    ship_package(docs.sparkSession)
    rows = _rows(docs)
    # the smallest id of each text; other ids of it are copies
    ids = store(rows.select("doc_id", "content", F.sha2("text", 256).alias("sha")), "op9-ids")
    firsts = store(ids.groupBy("sha").agg(F.min("doc_id").alias("doc_id"), F.first("content").alias("content")), "op9-firsts")
    copies = ids.join(firsts.select("sha", F.col("doc_id").alias("first_id")), "sha").where("doc_id > first_id")
    contexts = contexts_of_repeats(rows, firsts)
    spans = store(repeated_spans(contexts, group), "op9-spans", "zstd")
    discard(contexts)
    removed = spans.groupBy("doc_id", "content").agg(F.collect_list(F.struct("begin", "end")).alias("spans")).withColumn("copy", F.lit(False))
    gone = copies.select("doc_id", "content", F.lit(None).cast("array<struct<begin:bigint,end:bigint>>").alias("spans"), F.lit(True).alias("copy")).dropDuplicates(["doc_id", "content"])
    marks = store(removed.unionByName(gone), "op9-marks")
    return rows.join(marks, ["doc_id", "content"], "left").select("doc_id", "text", "copy", "spans").mapInArrow(
        _cut, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, removed array<struct<begin:bigint,end:bigint>>"
    )
