"""Operators 4, 9 and 10 against brute force."""

from __future__ import annotations

import hashlib
import random
import re

import numpy as np
import pytest
import xxhash

from riskloom.llm import exact_dedup, graph, simhash, suffix_dedup
from riskloom.llm.common import documents

from .conftest import EDGES, SF


# ------------------------------------------------------------------ exact dedup
def brute_exact(rows):
    norm = [re.sub(r"[\x20\x09-\x0D]", "", t or "") for _, t in rows]
    out = []
    for (i, t), n in zip(rows, norm):
        group = [(-len(u or ""), j is None, j or 0, j) for (j, u), m in zip(rows, norm) if m == n]
        best = min(group)
        out.append((i, best[3], len(group), i == best[3] and len(t or "") == -best[0], hashlib.sha256(n.encode()).hexdigest()))
    return sorted(out, key=str)


def got_exact(df):
    return sorted(((r.doc_id, r.keep_id, r.group_size, r.kept, r.text_sha256) for r in df.collect()), key=str)


@pytest.mark.parametrize("options", [{}, {"heavy": 3}, {"huge_chars": 1000, "piece_chars": 64}])
def test_exact_edges(make, options):
    rows = EDGES + [(100 + k, "a hot text") for k in range(40)]
    assert got_exact(exact_dedup.exact_dedup(make(rows), **options)) == brute_exact(rows)


def test_exact_empty_and_given(spark, make, given):
    assert exact_dedup.exact_dedup(make([])).count() == 0
    assert got_exact(exact_dedup.exact_dedup(documents(spark, SF))) == brute_exact(given)


def test_fingerprints_compose():
    rng = random.Random(1)
    for _ in range(50):
        data = bytes(rng.randrange(256) for _ in range(rng.randrange(0, 300)))
        cut = rng.randrange(0, len(data) + 1)
        assert exact_dedup.combine(exact_dedup.fingerprint(data[:cut]), exact_dedup.fingerprint(data[cut:])) == exact_dedup.fingerprint(data)


def test_equal_fingerprints_are_compared(make, monkeypatch):
    # every text has the fingerprint of its length only: the comparison must tell them apart
    rows = [(k, f"text {k % 3}") for k in range(9)]
    classes = list(exact_dedup._compare(iter([_batch(rows)])))
    labels = [x for b in classes for x in b.column("class").to_pylist()]
    assert [labels[k] == labels[0] for k in range(9)] == [k % 3 == 0 for k in range(9)]


def _batch(rows):
    import pyarrow as pa

    n = len(rows)
    return pa.RecordBatch.from_pydict(
        {"doc_id": [r[0] for r in rows], "text": [r[1] for r in rows], "h0": [0] * n, "h1": [0] * n, "n": [5] * n, "salt": [0] * n, "salted": [False] * n}
    )


def test_keep_first(make):
    rows = EDGES + [(20, "kept  text"), (21, "kept text")]
    kept = exact_dedup.keep_first(make(rows))
    assert kept.columns == ["doc_id", "text", "lang", "source", "n_chars", "score"]
    ids = [r.doc_id for r in kept.collect()]
    assert len(ids) == len(set(ids)) and 20 in ids and 21 not in ids and 9 in ids and 10 not in ids


# ------------------------------------------------------------------ SimHash
def brute_fingerprint(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", low)
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(codes, max_bits):
    codes = [int(c) for c in codes]
    root = list(range(len(codes)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(codes)):
        for j in range(i):
            if (codes[i] ^ codes[j]).bit_count() <= max_bits:
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(codes))]


def brute_simhash(rows):
    codes = [brute_fingerprint(t) for _, t in rows]
    roots = brute_components(codes, 2)
    least = {}
    for (i, _), r in zip(rows, roots):
        if i is not None:
            least[r] = min(least.get(r, i), i)
    return sorted(((i, f"{c:016x}", least.get(r)) for (i, _), c, r in zip(rows, codes, roots)), key=str)


def test_simhash_edges_and_given(spark, make, given):
    got = lambda df: sorted(((r.doc_id, r.fingerprint, r.component_id) for r in df.collect()), key=str)
    assert got(simhash.near_dedup(make(EDGES))) == brute_simhash(EDGES)
    assert got(simhash.near_dedup(documents(spark, SF))) == brute_simhash(given)
    assert simhash.near_dedup(make([])).count() == 0


@pytest.mark.parametrize("bucket", [2048, 4])
@pytest.mark.parametrize("max_bits", [1, 2, 3])
def test_near_links_lose_no_component(spark, bucket, max_bits):
    rng = random.Random(max_bits)
    centres = [rng.getrandbits(64) for _ in range(12)]
    codes = {c for c in centres}
    for c in centres[:4]:  # crowds: chains of fingerprints a few bits apart
        x = c
        for _ in range(40):
            for b in rng.sample(range(64), rng.randrange(1, 4)):
                x ^= 1 << b
            codes.add(x)
            x = rng.choice([x, c])
    codes = sorted(codes)
    signed = np.array(codes, dtype=np.uint64).view(np.int64).tolist()
    nodes = spark.createDataFrame([(c,) for c in signed], "fp long")
    found = {r.node: r.root for r in graph.connected_components(simhash.near_links(nodes, max_bits, bucket), "a", "b").collect()}
    roots = brute_components(codes, max_bits)
    groups = {}
    for c, r in zip(signed, roots):
        groups.setdefault(r, set()).add(c)
    for members in groups.values():
        assert {found.get(c, c) for c in members} == {min(members)}


def test_thresholds_spend_the_budget():
    work = [[0.0, 5.0, 50.0, 500.0], [0.0, 1.0, 2.0, 3.0], [0.0, 9.0, 90.0, 900.0]]
    assert simhash.allocate(work, 2) == ([-1, 2, -1], 3.0)
    correlation = np.eye(64)
    parts = simhash.group_bits(correlation, 3)
    assert sorted(b for p in parts for b in p) == list(range(64)) and sorted(map(len, parts)) == [21, 21, 22]


def test_keep_one(make):
    kept = simhash.keep_one(make(EDGES))
    rows = kept.collect()
    assert kept.columns == ["doc_id", "text", "lang", "source", "n_chars", "score"]
    wanted = {c for _, _, c in brute_simhash(EDGES)}
    assert sorted(r.doc_id for r in rows) == sorted(wanted)


# ------------------------------------------------------------------ suffix dedup
def brute_suffix(rows, w=50):
    top = 2**63 - 1
    first = {}
    for i, t in rows:
        data = (t or "").encode()
        for k in range(len(data) - w + 1):
            s = data[k : k + w]
            first[s] = min(first.get(s, top), top if i is None else i)
    out = []
    for i, t in rows:
        data = (t or "").encode()
        gone = bytearray(len(data))
        for k in range(len(data) - w + 1):
            if first[data[k : k + w]] < (top if i is None else i):
                gone[k : k + w] = b"\1" * w
        runs = sum(1 for k in range(len(gone)) if gone[k] and not (k and gone[k - 1]))
        out.append((i, len(data), sum(gone), runs, hashlib.sha256(bytes(c for c, g in zip(data, gone) if not g)).hexdigest()))
    return sorted(out, key=str)


def passages():
    rng = random.Random(5)
    words = ["alpha", "beta", "gamma", "dé", "ß", "omega", "of", "the"]
    text = lambda n: " ".join(rng.choice(words) for _ in range(n))
    shared = [text(30) for _ in range(4)]
    rows = [(k, " ".join([text(8), *rng.sample(shared, 2), text(8)])) for k in range(30)]
    return rows + [(50 + k, "ab" * rng.randrange(10, 60)) for k in range(6)] + [(60, shared[0]), (61, shared[0][:49]), (3, shared[1])]


def got_suffix(df):
    return sorted(((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in df.collect()), key=str)


@pytest.mark.parametrize("group,piece", [(suffix_dedup.GROUP, suffix_dedup.PIECE), (2, 64)])
def test_suffix_dedup(make, monkeypatch, group, piece):
    monkeypatch.setattr(suffix_dedup, "PIECE", piece)
    rows = EDGES + passages() + [(70, "y" * 3000), (71, "y" * 200)]
    if piece == 64:  # hundreds of pieces of each long row are enough
        rows = [(i, t[:20_000] if t else t) for i, t in rows]
    assert got_suffix(suffix_dedup.suffix_dedup(make(rows), group)) == brute_suffix(rows)


def test_suffix_dedup_of_a_hot_passage(make):
    # a passage of a third of all rows, whole copies, and rows that repeat an id
    rng = random.Random(8)
    words = [f"w{k}" for k in range(400)]
    text = lambda n: " ".join(rng.choice(words) for _ in range(n))
    hot = text(25)
    rows = [(k, f"{text(12)} {hot} {text(12)}" if k % 3 == 0 else text(40)) for k in range(240)]
    rows += [(300 + k, rows[1][1]) for k in range(20)] + [(5, rows[5][1]), (6, rows[9][1]), (400, hot), (None, rows[2][1])]
    assert got_suffix(suffix_dedup.suffix_dedup(make(rows))) == brute_suffix(rows)


def test_suffix_dedup_given_and_empty(spark, make, given):
    assert got_suffix(suffix_dedup.suffix_dedup(documents(spark, SF))) == brute_suffix(given)
    assert suffix_dedup.suffix_dedup(make([])).count() == 0


def test_suffix_array():
    rng = random.Random(2)
    for _ in range(300):
        s = np.array([rng.randrange(1, 4) for _ in range(rng.randrange(1, 80))])
        assert suffix_dedup.suffix_array(s).tolist() == sorted(range(len(s)), key=lambda i: s[i:].tolist())


def windows_of(data):
    """(window, place of its anchor, its hash) of every window."""
    begin, windows, left, anchor = suffix_dedup.anchors(data)
    return [(b + k, b + at, h) for b, n, at, h in zip(begin.tolist(), windows.tolist(), left.tolist(), anchor.tolist()) for k in range(n)]


def test_anchors_do_not_depend_on_blocks(monkeypatch):
    rng = random.Random(3)
    data = bytes(rng.choice(b"abc ") for _ in range(3000))
    whole = windows_of(data)
    assert [w for w, _, _ in whole] == list(range(len(data) - 49))
    monkeypatch.setattr(suffix_dedup, "BLOCK", 64)
    assert windows_of(data) == whole
    # equal windows have equal anchors at the same place
    again = windows_of(b"xyz" + data[100:700])
    assert [(a - 3 + 100, h) for w, a, h in again if w >= 3] == [(a, h) for w, a, h in whole if 100 <= w <= 700 - 50]
    assert windows_of(b"x" * 49) == []
