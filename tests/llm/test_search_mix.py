"""Operators 11, 12 and 13 against brute force."""

from __future__ import annotations

import hashlib
import math
import random
import re
from collections import Counter, defaultdict
from fractions import Fraction

import numpy as np
import pytest

from riskloom.llm import divergence, mixing, queries, search

from .conftest import EDGES, SF

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, TEXT string, term string, rank string"


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


@pytest.fixture(scope="module")
def table(spark):
    """A documents table from (doc_id, text, lang, source) rows, with clashing columns."""

    def run(rows):
        spark.conf.set("spark.sql.caseSensitive", "true")  # only a case-sensitive session can make such a table
        try:
            return spark.createDataFrame([(i, t, g, s, len(t or ""), "other", "x", "y") for i, t, g, s in rows], SCHEMA)
        finally:
            spark.conf.set("spark.sql.caseSensitive", "false")

    return run


def rows_from(seed, n, words="the cat sat on a mat and Dog élan 漢字 x1 7 zzz-qq".split()):
    rng = random.Random(seed)
    out = []
    for k in range(n):
        text = None if rng.random() < 0.03 else " ".join(rng.choice(words[: rng.randrange(1, len(words) + 1)]) for _ in range(rng.randrange(0, 30)))
        out.append((k, text, rng.choice(["en", "de", None]), rng.choice(["a", "b", "B", "é", "", None])))
    return out


EDGE_ROWS = [(i, t, "en", "src0") for i, t in EDGES]


# ------------------------------------------------------------------ search
def terms11(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", lower(text))


def brute_search(rows, items, top):
    docs = [(i, Counter(terms11(t))) for i, t, *_ in rows]
    docs = [(i, c) for i, c in docs if c]
    n_docs, total = len(docs), sum(sum(c.values()) for _, c in docs)
    df = Counter(t for _, c in docs for t in c)
    out = []
    for item_id, text in {(i, t) for i, t in items}:
        own = set(terms11(text)) & set(df)
        w = {t: math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) for t in own}
        found = []
        for i, c in docs:
            m = 100 - 50 + (50 * sum(c.values()) * n_docs) // total
            s = sum(w[t] * ((1000000000 * c[t]) // (1000 * c[t] + 20 * m)) for t in own if c[t])
            if s > 0:
                found.append((-s, i is None, i or 0, i))
        out += [(item_id, k + 1, f[3], -f[0]) for k, f in enumerate(sorted(found)[:top])]
    return sorted(out, key=str)


def got_search(df):
    return sorted(((r.item_id, r["rank"], r.doc_id, r.score) for r in df.collect()), key=str)


def items_of(spark, rows):
    return spark.createDataFrame([(*r, "x") for r in rows], "item_id long, text string, doc_id string")


@pytest.mark.parametrize("top,block_terms", [(5, 65_536), (50, 4)])
def test_search_equals_brute_force(spark, table, top, block_terms):
    # ties: many equal texts; a third of the rows is one text
    rows = EDGE_ROWS + rows_from(1, 300) + [(1000 + k, "The cat sat; the mat", "en", "a") for k in range(150)]
    items = [(1, "the cat"), (1, "the cat"), (1, "mat 漢字 x1"), (2, None), (3, "-- !"), (None, "Dog"), (4, "absent words"), (5, "cat cat zzz"), (6, "")]
    want = brute_search(rows, items, top)
    assert got_search(search.search(table(rows), items_of(spark, items), top, block_terms)) == want


def test_search_empty_tables(spark, table):
    assert search.search(table([]), items_of(spark, [(1, "a")])).count() == 0
    assert search.search(table(EDGE_ROWS), items_of(spark, [])).count() == 0
    assert search.search(table(EDGE_ROWS), items_of(spark, [])).columns == ["item_id", "rank", "doc_id", "score"]


def tree_of(vectors, ns):
    width = 1 + max(max(v) for v in vectors)
    tf = np.zeros((len(vectors), width), dtype=np.int32)
    for k, v in enumerate(vectors):
        for t, c in v.items():
            tf[k, t] = c
    paths = [np.array(sorted(v), dtype=np.int64) for v in vectors]
    m = search.length_share(np.array(ns), len(vectors), sum(ns))
    return search.Tree(np.arange(len(vectors)).astype(object), m, paths, tf), tf, m


def test_tree_bounds_and_prunes(monkeypatch):
    monkeypatch.setattr(search, "LEAF", 3)
    rng = random.Random(3)
    vectors = [{0: 1, **{rng.randrange(12): rng.randrange(1, 4) for _ in range(rng.randrange(1, 7))}} for _ in range(400)]
    vectors += [{0: 1, 5: 9, 13: 2}] * 50  # equal vectors
    ns = [sum(v.values()) + rng.randrange(20) for v in vectors]
    tree, tf, m = tree_of(vectors, ns)
    # every document hangs on one node, and a node's row bounds what lies below it
    hung = sorted(k for below in tree.below for k in below.tolist() if k < tree.count)
    assert hung == list(range(len(vectors)))
    for node, below in enumerate(tree.below):
        assert (tree.tf[below] <= tree.tf[tree.count + node]).all() and (tree.m[below] >= tree.m[tree.count + node]).all()
    terms, w = np.array([2, 5, 13]), np.array([300, 900, 4000])
    for top in (1, 7, 60):
        best = []
        visited = tree.search(terms, w, best, top)
        all_ = search.scores(tf[:, terms], m, w)
        want = sorted([(int(s), -k) for k, s in enumerate(all_) if s > 0], reverse=True)[:top]
        assert sorted(best, reverse=True) == want
        assert visited < len(tree.below)  # some nodes are left out


def test_search_of_given_tables(spark, given):
    got = queries.q_search(spark, SF)
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    assert got_search(got) == brute_search(given, items, 50)


# ------------------------------------------------------------------ divergence
def terms12(text):
    return re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", lower(text))


def brute_audit(rows, least, top):
    count, df, langs = defaultdict(Counter), defaultdict(Counter), defaultdict(set)
    for _, t, lang, source in rows:
        lang, source, terms = lang or "", source or "", terms12(t)
        langs[lang].add(source)
        count[lang, source].update(terms)
        df[lang].update(set(terms))
    out = []
    for lang, sources in langs.items():
        kept = [t for t, n in df[lang].items() if n >= least]

        def shares(n):
            size = sum(n[t] for t in kept) + 2 * len(kept)
            return {t: 1 + 1000000000 * (n[t] + 2) // size for t in kept}

        p = {s: shares(count[lang, s]) for s in sources}
        q = shares(sum((count[lang, s] for s in sources), Counter()))
        f = lambda a, b: (a - b) ** 2 // (a + b)
        for s in sources:
            pairs = [(-sum(f(p[s][t], p[o][t]) for t in kept), o.encode(), o) for o in sources if o != s]
            terms = [(-f(p[s][t], q[t]), t.encode(), t) for t in kept if count[lang, s][t] and p[s][t] > q[t]]
            out += [(lang, s, "pair", x[2], -x[0], k + 1) for k, x in enumerate(sorted(pairs))]
            out += [(lang, s, "term", x[2], -x[0], k + 1) for k, x in enumerate(sorted(terms)[:top])]
    return sorted(out)


def got_audit(df):
    return sorted((r.lang, r.source, r["part"], r["item"], r.value, r["rank"]) for r in df.collect())


def test_audit_equals_brute_force(table):
    words = "the Cat élan 漢字 abcdefgh abcdefghi abcdefghijklmnop abcdefghijklmnopq ABCDEFGHIJKLMNOPQ ünïcödewörter a-b x1y".split() + ["w" * 50, "w" * 51]
    rows = rows_from(2, 400, words) + [(k, "hot text of one Source", "en", "a") for k in range(200)] + [(1, None, "fr", "a"), (2, "", "fr", "b"), (3, "solo", "it", "a")]
    assert got_audit(divergence.audit(table(rows), 10, 4)) == brute_audit(rows, 10, 4)
    assert got_audit(divergence.audit(table(EDGE_ROWS), 1, 100)) == brute_audit(EDGE_ROWS, 1, 100)


def test_audit_empty_table(table):
    got = divergence.audit(table([]))
    assert got.count() == 0 and got.columns == ["lang", "source", "part", "item", "value", "rank"]


def test_pair_sums_in_small_blocks(spark, table, monkeypatch):
    # buckets and blocks are made by the driver's plan, matrices by the workers
    rows = rows_from(4, 300)
    monkeypatch.setattr(divergence, "BUCKET_ROWS", 5)
    assert got_audit(divergence.audit(table(rows), 3, 10)) == brute_audit(rows, 3, 10)


def test_counts_are_exact_beyond_64_bits(spark):
    df = spark.createDataFrame([(9_000_000_000_000_000_000, 9_100_000_000_000_000_000, 7)], "n long, total long, terms long")
    got = df.select(divergence.share("n").alias("p")).first().p
    assert got == 1 + 1000000000 * (9_000_000_000_000_000_000 + 2) // (9_100_000_000_000_000_000 + 14)


def test_radix_order_is_stable():
    rng = np.random.default_rng(5)
    words = rng.integers(0, 2**64, 1000, dtype=np.uint64)[rng.integers(0, 300, 5000)] & np.uint64(0xFFFF00000000FFFF)
    assert (divergence.radix_order(words) == np.argsort(words, kind="stable")).all()


def test_terms_end_with_their_text():
    raw = [b"ab", b"", b"cd ef", b" x", b"y"]
    bounds = np.cumsum([0] + [len(r) for r in raw])
    starts, lengths, text = divergence.find_terms(np.frombuffer(b"".join(raw), dtype=np.uint8), bounds)
    assert list(zip(starts.tolist(), lengths.tolist(), text.tolist())) == [(0, 2, 0), (2, 2, 2), (5, 2, 2), (8, 1, 3), (9, 1, 4)]


# ------------------------------------------------------------------ mixing
def brute_targets(sizes, weights, most):
    """Exact targets: share, cap, reshare the excess until none is above."""
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    w = {s: weights[k % len(weights)] for k, s in enumerate(names)}
    total = sum(sizes.values())
    fixed: dict = {}
    while True:
        free = [s for s in names if s not in fixed]
        level = Fraction(total - sum(fixed.values()), sum(w[s] for s in free) or 1)
        above = [s for s in free if w[s] * level > most * sizes[s]]
        if not above:
            return {s: Fraction(fixed[s]) if s in fixed else w[s] * level for s in names}
        fixed |= {s: most * sizes[s] for s in above}


def check_mix(rows, got, weights=(1, 2, 3), most=3):
    size_of = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    text = defaultdict(list)
    for i, t, _, s in rows:
        text[i].append((size_of(t), s))
    assert Counter((r.doc_id, r["size"]) for r in got) == Counter((i, size_of(t)) for i, t, *_ in rows)
    sizes, largest = Counter(), Counter()
    for i, t, _, s in rows:
        sizes[s] += size_of(t)
        largest[s] = max(largest[s], size_of(t))
    targets = brute_targets(sizes, weights, most)
    of_target = defaultdict(set)
    for s in targets:
        of_target[sizes[s], float(targets[s])].add(s)
    taken = Counter()
    for r in got:
        assert 0 <= r.taken <= most * r["size"] and r.taken == r.times * r["size"]
        match = [k for k in of_target if k[0] == r.source_size and math.isclose(k[1], r.target, rel_tol=1e-12)]
        assert len(match) == 1
        taken[match[0]] += r.taken
    for key, sources in of_target.items():
        allowed = sum(largest[s] for s in sources) / 2 + 1
        assert abs(taken[key] - sum(float(targets[s]) for s in sources)) <= allowed, key


def as_rows(df):
    return sorted(((r.doc_id, r["size"], r.source_size, r.target, r.taken) for r in df.collect()), key=str)


def mix_rows():
    rng = random.Random(6)
    out = [(k, " ".join("w" * 3 for _ in range(rng.randrange(0, 60))), "en", f"s{min(9, int(rng.expovariate(0.5)))}") for k in range(800)]
    out += [(2000 + k, "hot " * 20, "en", "s0") for k in range(400)]  # a third of the rows in one source
    return out + [(3000, None, "en", "z"), (3001, "", "en", "z"), (3002, "some words", "en", None), (3003, "some words", "en", ""), (None, "no id", "en", "s1")]


def test_mix_meets_targets(table):
    rows = mix_rows()
    got = mixing.mix(table(rows)).collect()
    check_mix(rows, got)
    check_mix(rows, mixing.mix(table(rows), weights=(5, 1), most=2).collect(), (5, 1), 2)


def test_mix_does_not_depend_on_the_layout(table):
    rows = mix_rows()
    shuffled = rows[:]
    random.Random(7).shuffle(shuffled)
    assert as_rows(mixing.mix(table(rows))) == as_rows(mixing.mix(table(shuffled).repartition(7)))


def test_mix_chooses_among_equal_rows(table):
    # one row again and again is one hash: as many copies as come nearest are taken
    rows = [(1, "a b c d", "en", "x")] * 500 + [(2, "other words", "en", "y")] * 900
    got = mixing.mix(table(rows).repartition(9)).collect()
    check_mix(rows, got)


def test_a_larger_budget_takes_what_a_smaller_takes(table):
    rows = [(k, "word " * (1 + k % 7), "en", "a" if k % 2 else "b") for k in range(300)]
    few = {r.doc_id: r.times for r in mixing.mix(table(rows), weights=(1, 3)).collect()}
    more = {r.doc_id: r.times for r in mixing.mix(table(rows), weights=(1, 2)).collect()}
    assert all(few[k] <= more[k] for k in few if rows[k][3] == "a") and few != more


def test_mix_edges(table):
    assert mixing.mix(table([])).count() == 0
    for r in mixing.mix(table([(1, None, "en", "a"), (2, " ", None, None)])).collect():
        assert (r["size"], r.source_size, r.target, r.taken) == (0, 0, 0.0, 0)
    check_mix(EDGE_ROWS, mixing.mix(table(EDGE_ROWS)).collect())
    with pytest.raises(ValueError):
        mixing.mix(table([]), weights=(1, 0))


def test_mix_hash_is_md5(table):
    got = mixing.sized(table([(5, "text", "en", "a"), (None, None, "en", "a")])).orderBy("size").collect()
    assert [r.h for r in got] == [int(hashlib.md5(s.encode()).hexdigest()[:15], 16) for s in ("\n", "5\ntext")]
