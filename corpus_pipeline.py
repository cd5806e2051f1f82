"""From raw documents to packed training sequences, in five stages.

Each stage is a function (spark, docs, sf_dir) -> DataFrame that works on all its
predecessor kept; all but the last return the columns of ``documents``.
``run`` applies them to the documents table and stores what each stage returns.

Defined results of every stage: an empty table gives no row; other columns are kept (packing
ignores them), also where they clash with a helper's name; of NULLs, empty and repeated texts the
operators' own modules speak.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from riskloom.llm import exact_dedup, langid, packing, secrets, simhash
from riskloom.llm.common import documents, store


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 6: documents go that have no letter, or that letters without an order explain better
    than the best language does."""
    return langid.accepted(docs, public_tokenizers.path("piece_bpe_32k.model"))


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 10: of equal texts the longest stays."""
    return exact_dedup.keep_first(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 4: one document of each group of near-duplicates stays."""
    return simhash.keep_one(docs, shingle=3, max_bits=2)


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 7: secrets are replaced; every document stays."""
    return secrets.redact(docs, public_tokenizers.path("piece_bpe_32k.model"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 5: the pieces of sequences of 2048 token ids."""
    return packing.crc_of_ids(packing.pack(docs, public_tokenizers.path("word_bpe_49k.json")))


STAGES = [
    ("language ID", language),
    ("exact dedup", exact),
    ("SimHash near-dedup", near),
    ("secret scan", without_secrets),
    ("packing", packed),
]

#: Language models and token packing cannot be written in SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents table."""
    docs = documents(spark, sf_dir)
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = store(docs, f"pipeline-{k + 1}")
    return docs
