"""The pipeline against its stages run one by one, and its stages on edge rows."""

from __future__ import annotations

import importlib

import corpus_pipeline
import pytest

from riskloom.llm.common import store

from .conftest import EDGES, SF
from .test_dedup import brute_exact, brute_simhash


def test_stages_and_registration():
    assert [k for k, _ in corpus_pipeline.STAGES] == ["language ID", "exact dedup", "SimHash near-dedup", "secret scan", "packing"]
    entry = importlib.import_module("__spark_entry__")
    names = entry.queries()
    assert "pipeline" in names and all(any(n.startswith(f"op{k}_") for n in names) for k in range(1, 11))


def test_stages_keep_what_brute_force_keeps(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    (_, language), (_, exact), (_, near), (_, scan), (_, packed) = corpus_pipeline.STAGES
    kept = store(language(spark, docs, SF), "t1")
    assert kept.columns == docs.columns and kept.count() == docs.count()  # all are prose in a learned language
    rows = [(r.doc_id, r.text) for r in kept.collect()]
    once = store(exact(spark, kept, SF), "t2")
    assert sorted(r.doc_id for r in once.collect()) == sorted(i for i, _, _, k, _ in brute_exact(rows) if k)
    rows = [(r.doc_id, r.text) for r in once.collect()]
    lone = store(near(spark, once, SF), "t3")
    assert sorted(r.doc_id for r in lone.collect()) == sorted({c for _, _, c in brute_simhash(rows)})
    clean = store(scan(spark, lone, SF), "t4")
    assert clean.columns == docs.columns and clean.count() == lone.count()
    pieces = packed(spark, clean, SF)
    assert {r.doc_id for r in pieces.select("doc_id").distinct().collect()} == {r.doc_id for r in clean.collect()}
    assert corpus_pipeline.run(spark, SF).count() == pieces.count()


@pytest.mark.parametrize("stage", [f for _, f in corpus_pipeline.STAGES])
def test_stages_take_edges_and_empty_tables(spark, make, stage):
    assert stage(spark, make(EDGES), SF).count() > 0
    assert stage(spark, make([]), SF).count() == 0
