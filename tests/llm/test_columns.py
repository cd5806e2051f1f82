"""Columns that clash with results and helpers, and rows that repeat, in every operator."""

from __future__ import annotations

import public_tokenizers
import pytest
from pyspark.sql import functions as F

from riskloom.llm import bpe, divergence, exact_dedup, langid, minhash, mixing, packing, quality, search, secrets, simhash, suffix_dedup, toxicity

PIECES = public_tokenizers.path("piece_bpe_32k.model")
TEXTS = ["the cat sat on the mat and looked at the dog", "another text altogether, with words", None, "", 'token = "a8f3c2e19b7d4f60"']
OTHERS = ["TEXT", "Doc_Id", "_keep", "_clean", "_prediction", "label", "rank", "size", "t", "data"]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(k, TEXTS[k % 5], "en" if k % 2 else "de", "s", 5, *[f"{c}{k}" for c in OTHERS]) for k in range(20)]
    names = ["doc_id", "text", "lang", "source", "n_chars", *OTHERS]
    df = spark.createDataFrame(rows, [f"c{k}" for k in range(len(names))])
    return df.toDF(*names)


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(k, k % 2, (k + 1) % 2) for k in range(20)], "doc_id long, quality int, toxic int")


ROWS = {
    "exact": exact_dedup.keep_first,
    "near": simhash.keep_one,
    "language": lambda d: langid.accepted(d, PIECES),
    "secrets": lambda d: secrets.redact(d, PIECES),
}


@pytest.mark.parametrize("name", ROWS)
def test_operators_that_return_rows_keep_all_columns(docs, name):
    out = ROWS[name](docs)
    assert out.columns == docs.columns
    got = out.toDF(*[f"c{k}" for k in range(len(out.columns))]).collect()
    assert got
    for r in got:
        assert list(r)[5:] == [f"{c}{r.c0}" for c in OTHERS]


def test_other_operators_ignore_other_columns(spark, docs, labels):
    byte_bpe, word_bpe = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("word_bpe_49k.json")
    plain = docs.toDF(*docs.columns[:5], *[f"o{k}" for k in range(len(OTHERS))])
    items = spark.createDataFrame([(1, "the cat")], "item_id long, text string")
    for run in (
        minhash.compare_with_next, lambda d: bpe.round_trip(d, byte_bpe), simhash.near_dedup, lambda d: packing.crc_of_ids(packing.pack(d, word_bpe)),
        lambda d: suffix_dedup.suffix_dedup(d).drop("removed"), exact_dedup.exact_dedup, lambda d: search.search(d, items), lambda d: divergence.audit(d, 1),
        mixing.mix, lambda d: secrets.scan(d, PIECES).drop("score"),
        lambda d: langid.identify(d, PIECES).select("doc_id", "lang_pred"), lambda d: toxicity.toxicity(d, labels).select("doc_id", "held_out"),
        lambda d: quality.quality(d, labels).select("doc_id", "held_out"),
    ):
        assert sorted(map(str, run(docs).collect())) == sorted(map(str, run(plain).collect()))


def test_learning_rows_are_bounded_however_ids_repeat(spark, docs, labels):
    many = spark.range(5000).select(F.lit(3).cast("long").alias("doc_id"), F.concat(F.lit("text "), F.col("id") % 300).alias("text"))
    rows = toxicity.learning_rows(many, labels, "toxic", 100)
    assert rows.count() == 100 and rows.columns == ["doc_id", "text", "label"]
    assert toxicity.learning_rows(many, labels, "toxic", 1000).count() == 300  # equal rows count once
    assert toxicity.learning_rows(many.limit(0), labels, "toxic", 10).count() == 0
