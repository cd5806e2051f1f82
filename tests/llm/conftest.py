from __future__ import annotations

import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[2]
sys.path.insert(0, str(ROOT))

from riskloom.session import local_session  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    s = local_session(4, shuffle_partitions=4, app="riskloom-llm-tests")
    yield s


@pytest.fixture(scope="session")
def make(spark):
    """A documents table from (doc_id, text) or (doc_id, text, lang) rows, with a column
    whose name clashes with results."""

    def run(rows):
        full = [(r[0], r[1], r[2] if len(r) > 2 else "en", "src0", len(r[1] or ""), "x") for r in rows]
        return spark.createDataFrame(full, "doc_id long, text string, lang string, source string, n_chars long, score string")

    return run


@pytest.fixture(scope="session")
def given(spark):
    """(doc_id, text) of the smallest given documents table."""
    return [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]


#: NULLs, empty and white texts, a long text, ties, repeated rows and a NULL id.
EDGES = [
    (1, None), (2, ""), (3, " \n\t"), (4, "one"), (5, "one two"), (5, "one two"), (6, "One\ttwo "), (7, "x" * 30_000),
    (8, "word " * 20_000), (9, "the cat sat on the mat and looked at the dog"), (10, "the cat sat on the mat and looked at the dog"),
    (None, "the cat sat on the mat and looked at the dog"), (11, "naïve façade 漢字 😀 \u001c  ok"), (12, "<|endoftext|> a <|startoftext|>"),
]
