"""Operators 1, 2 and 5."""

from __future__ import annotations

import hashlib
import random
import zlib
from pathlib import Path

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from riskloom.llm import bpe, minhash, packing

from .conftest import EDGES

BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")
WORD_BPE = public_tokenizers.path("word_bpe_49k.json")
ALPHABET = [*"ab cdé'sTll  \n\t\r\x1c\x1f\xa0  1259½²漢字😀!?.,$%`~_ßΣσİıÀ́ 　", "<|endoftext|>", " the", " And", "'re", "***", "!!", "  "]


def random_texts(n, seed):
    rng = random.Random(seed)
    return ["".join(rng.choice(ALPHABET) for _ in range(rng.randrange(0, 50))) for _ in range(n)]


#: Marks beside letters, digits, quotes, endings and white space of every kind.
MARKED = ["it's-a", "a-'s b", 'x"-y', "3.5-z", "(a)(b)", "a...b", "... a", "A-B.C", "-", "a -", "- a", "l'été-là", "İ-x", "x-İ", "Σας-Σ", "a\u0301-b", "a-\u0301",
          "ﬁ-x", "a\x1c-b", "a\u3000-b", "\xa0-a", "a_b__c", "1-a-2", "a@b.c", "<|endoftext|>-a", "a-<|endoftext|>", "ß-ẞ", "ŉ-x", "ǅ-x", "x" * 70 + "-y"]


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


# ------------------------------------------------------------------ BPE
def test_bpe_equals_the_library(given):
    own, library = bpe.ByteBpe(open(BYTE_BPE).read()), Tokenizer.from_file(BYTE_BPE)
    for text in random_texts(4000, 1) + [t for _, t in given][:60] + [t or "" for _, t in EDGES]:
        ids = library.encode(text, add_special_tokens=False).ids
        assert own.encode(text) == ids, repr(text)
        assert own.decode(ids) == library.decode(ids, skip_special_tokens=False)


def test_bpe_generations_of_the_cache(monkeypatch):
    monkeypatch.setattr(bpe, "CACHE_ENTRIES", 3)
    own, library = bpe.ByteBpe(open(BYTE_BPE).read()), Tokenizer.from_file(BYTE_BPE)
    for text in random_texts(200, 2):
        assert own.encode(text) == library.encode(text, add_special_tokens=False).ids


def test_bpe_query(make):
    library = Tokenizer.from_file(BYTE_BPE)
    want = []
    for i, t in EDGES:
        ids = library.encode(t or "", add_special_tokens=False).ids
        want.append((i, len(ids), sha(",".join(map(str, ids))), sha(library.decode(ids, skip_special_tokens=False))))
    got = [tuple(r) for r in bpe.round_trip(make(EDGES), BYTE_BPE).collect()]
    assert sorted(got, key=str) == sorted(want, key=str)
    tokens = bpe.tokenize(make(EDGES[:6]), BYTE_BPE)
    assert sorted(r.text for r in bpe.detokenize(tokens, BYTE_BPE).collect()) == sorted(t or "" for _, t in EDGES[:6])
    assert bpe.round_trip(make([]), BYTE_BPE).count() == 0


# ------------------------------------------------------------------ packing
def test_word_ids_equal_the_library(monkeypatch):
    monkeypatch.setattr(packing, "CACHE_ENTRIES", 50)
    own, library = packing.WordIds(open(WORD_BPE).read()), Tokenizer.from_file(WORD_BPE)
    texts = random_texts(4000, 3)
    for at in range(0, len(texts), 100):
        ids, bounds = own.encode(pa.array(texts[at : at + 100]))
        for text, a, b in zip(texts[at : at + 100], bounds, bounds[1:]):
            assert ids[a:b].tolist() == library.encode(text, add_special_tokens=False).ids, repr(text)


@pytest.mark.parametrize("name", sorted(f.name for f in Path(WORD_BPE).parent.glob("*.json")))
def test_word_ids_equal_the_library_for_every_file(name, given):
    path = public_tokenizers.path(name)
    own, library = packing.WordIds(open(path).read()), Tokenizer.from_file(path)
    texts = random_texts(500, 9) + [t or "" for _, t in given][:60] + [t or "" for _, t in EDGES] + MARKED
    ids, bounds = own.encode(pa.array(texts))
    for text, a, b in zip(texts, bounds, bounds[1:]):
        assert ids[a:b].tolist() == library.encode(text, add_special_tokens=False).ids, repr(text)
    assert own.encode(pa.array([], pa.string()))[0].tolist() == [] and own.encode(pa.array([""]))[1].tolist() == [0, 0]


def test_best_fill_is_the_closest():
    rng = random.Random(4)
    for _ in range(200):
        counts = {rng.randrange(1, 40): rng.randrange(1, 4) for _ in range(rng.randrange(1, 6))}
        room = rng.randrange(1, 80)
        sums = {0}
        for k, n in counts.items():
            sums = {s + k * i for s in sums for i in range(n + 1)}
        chosen = packing.best_fill(room, counts)
        assert sum(k * n for k, n in chosen.items()) == max(s for s in sums if s <= room)
        assert all(n <= counts[k] for k, n in chosen.items())


@pytest.mark.parametrize("histogram", [{700: 1000}, {5: 3, 7: 9, 64: 2}, {63: 1}, {k: k % 7 for k in range(1, 65)}, {64: 10**9, 33: 10**9, 3: 2}])
def test_plan_places_every_rank_once(histogram):
    capacity = 64 if max(histogram) <= 64 else 2048
    uses, windows = packing.plan_windows(histogram, capacity)
    total = sum(k * n for k, n in histogram.items())
    assert windows == -(-total // capacity)  # only the last window can be short
    if sum(histogram.values()) > 10_000:
        return
    starts = {k: [u.rank for u in us] for k, us in uses.items()}
    filled = {}
    for k, n in histogram.items():
        for rank in range(n):
            at = 0
            for first, used, window, offset in packing.place(k, rank, uses, starts):
                assert first == at and used > 0
                at += used
                filled.setdefault(window, []).append((offset, used))
            assert at == k
    assert sorted(filled) == list(range(windows))
    for window, parts in filled.items():
        at = 0
        for offset, used in sorted(parts):
            assert offset == at
            at += used
        assert at == capacity or window == windows - 1


def test_packing_query(make):
    library = Tokenizer.from_file(WORD_BPE)
    rows = EDGES + [(100 + k, "the same text again and again") for k in range(500)]
    got = packing.crc_of_ids(packing.pack(make(rows), WORD_BPE)).toPandas()
    ids = {i: library.encode(t or "", add_special_tokens=False).ids + [1] for i, t in rows}
    assert got["length"].sum() == sum(len(ids[i]) for i, _ in rows)
    for r in got.dropna(subset=["doc_id"]).itertuples():
        own = ids[int(r.doc_id)]
        assert r.doc_tokens == len(own)
        assert r.ids_crc32 == zlib.crc32(np.asarray(own[r.start : r.start + r.length], dtype="<u4").tobytes())
    for _, window in got.sort_values("offset").groupby("sequence_id"):
        assert (window["length"].cumsum() - window["length"] == window["offset"]).all() and window["length"].sum() <= 2048
    sizes = got.groupby("sequence_id")["length"].sum()
    assert sorted(sizes.index) == list(range(len(sizes))) and (sizes < 2048).sum() <= 1
    assert packing.pack(make([]), WORD_BPE).count() == 0


# ------------------------------------------------------------------ MinHash
def shingles(text):
    words = (text or "").split()
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def jaccard(a, b):
    return len(a & b) / len(a | b) if a | b else 1.0


def test_minhash_query(make, given):
    rows = sorted([r for r in EDGES if r[0] is not None and r[0] != 5] + [(1000 + i, t) for i, t in given])
    got = {r.doc_id: r for r in minhash.compare_with_next(make(rows)).collect()}
    assert len(got) == len(rows)
    errors = []
    for k, (i, t) in enumerate(rows):
        t, following = t or "", rows[(k + 1) % len(rows)][1] or ""
        edited = t[: len(t) - len(t) // 2] + following[: len(t) // 2]
        r = got[i]
        assert (r.n_chars, r.edited_sha256) == (len(t), sha(edited))
        assert r.edited_fingerprint == minhash.pack(minhash.sketch(edited))
        errors += [r.near_edited - jaccard(shingles(t), shingles(edited)), r.near_next - jaccard(shingles(t), shingles(following))]
    errors = np.array(errors)
    assert np.sqrt((errors**2).mean()) < 0.03 and abs(errors.mean()) < 0.01
    assert got[9].fingerprint == got[10].fingerprint and got[9].near_next == 1.0
    assert got[1].fingerprint == "" and got[1].near_next == 1.0 and got[3].near_next == 0.0


def test_minhash_small_tables(make):
    assert minhash.compare_with_next(make([])).count() == 0
    only = minhash.compare_with_next(make([(1, "a b c d e f")])).collect()
    assert len(only) == 1 and only[0].near_next == 1.0
    assert minhash.compare_with_next(make(EDGES)).count() == len(EDGES)


def test_packed_bins_round_trip():
    bins = minhash.sketch("some words that make a few shingles of five words each")
    assert (minhash.unpack(minhash.pack(bins)) == bins).all() and len(minhash.pack(bins)) == minhash.BINS * minhash.LOW_BITS // 4


def test_likeness_is_unbiased_where_bins_are_empty():
    rng = random.Random(6)
    errors = []
    for _ in range(150):
        words = [str(rng.getrandbits(30)) for _ in range(60)]
        cut = rng.randrange(5, 55)
        a, b = " ".join(words), " ".join(words[:cut] + [str(rng.getrandbits(30)) for _ in range(60 - cut)])
        errors.append(minhash.likeness(minhash.sketch(a), minhash.sketch(b)) - jaccard(shingles(a), shingles(b)))
    assert abs(np.mean(errors)) < 0.02
