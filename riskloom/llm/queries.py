"""The registered queries of this subpackage and their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from riskloom.llm import bpe, divergence, exact_dedup, langid, minhash, mixing, packing, quality, search, secrets, simhash, suffix_dedup, toxicity
from riskloom.llm.common import documents, labels


def q_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Operator 1: fingerprints of every text and its edited text."""
    return minhash.compare_with_next(documents(spark, sf_dir))


def q_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Operator 2: encode and decode every text."""
    return bpe.round_trip(documents(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.json"))


def q_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Operator 3: toxicity of every text."""
    return toxicity.toxicity(documents(spark, sf_dir), labels(spark, sf_dir))


def q_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Operator 4: fingerprints of 3-word shingles that differ in at most 2 bits."""
    return simhash.near_dedup(documents(spark, sf_dir), shingle=3, max_bits=2)


def q_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Operator 5: every text packed into sequences of 2048 ids."""
    return packing.crc_of_ids(packing.pack(documents(spark, sf_dir), public_tokenizers.path("word_bpe_49k.json")))


def q_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Operator 6: the language of every text."""
    return langid.identify(documents(spark, sf_dir), public_tokenizers.path("piece_bpe_32k.model"))


def q_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Operator 7: every candidate with its score."""
    return secrets.scan(documents(spark, sf_dir), public_tokenizers.path("piece_bpe_32k.model"))


def q_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Operator 8: quality of every text."""
    return quality.quality(documents(spark, sf_dir), labels(spark, sf_dir))


def q_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Operator 9: bytes of repeated 50-byte strings removed."""
    return suffix_dedup.suffix_dedup(documents(spark, sf_dir)).drop("removed")


def q_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Operator 10: groups of equal texts."""
    return exact_dedup.exact_dedup(documents(spark, sf_dir)).drop("n_chars")


def q_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Operator 11: the 50 best documents of every benchmark item."""
    return search.search(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"), top=50)


def q_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Operator 12: how far the sources of a language are from each other."""
    return divergence.audit(documents(spark, sf_dir))


def q_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Operator 13: sources mixed to target weights."""
    return mixing.mix(documents(spark, sf_dir)).drop("times")


EXACT_DEDUP_SQL = r"""
WITH d AS (
  SELECT doc_id, length(coalesce(text, '')) AS n,
         sha256(translate(coalesce(text, ''), chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13), '')) AS s
  FROM documents)
SELECT doc_id, first_value(doc_id) OVER w AS keep_id, count(*) OVER (PARTITION BY s) AS group_size,
       doc_id IS NOT DISTINCT FROM first_value(doc_id) OVER w AND n = first_value(n) OVER w AS kept, s AS text_sha256
FROM d WINDOW w AS (PARTITION BY s ORDER BY n DESC, doc_id NULLS LAST)
"""

#: Windows as hexadecimal digits; gaps and islands of what goes; the rest joined and hashed as bytes.
SUFFIX_SQL = r"""
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS x FROM documents),
n AS (SELECT doc_id, x, (length(x) // 2)::BIGINT AS n_bytes FROM d),
w AS (SELECT doc_id, i, substr(x, 2 * i + 1, 100) AS s FROM (SELECT doc_id, x, unnest(range(n_bytes - 49)) AS i FROM n WHERE n_bytes >= 50)),
first AS (SELECT s, min(doc_id) AS least FROM w GROUP BY s),
gone AS (SELECT doc_id, i FROM w JOIN first USING (s) WHERE least < doc_id),
breaks AS (SELECT doc_id, i, CASE WHEN i - lag(i) OVER (PARTITION BY doc_id ORDER BY i) <= 50 THEN 0 ELSE 1 END AS opens FROM gone),
numbered AS (SELECT doc_id, i, sum(opens) OVER (PARTITION BY doc_id ORDER BY i) AS run FROM breaks),
spans AS (SELECT doc_id, run, min(i) AS a, max(i) + 50 AS b FROM numbered GROUP BY doc_id, run),
pieces AS (SELECT doc_id, run, a, b, coalesce(lag(b) OVER (PARTITION BY doc_id ORDER BY run), 0) AS kept_from FROM spans),
cut AS (
  SELECT doc_id, sum(b - a)::BIGINT AS n_removed, count(*)::BIGINT AS n_spans,
         string_agg(substr(x, 2 * kept_from + 1, 2 * (a - kept_from)), '' ORDER BY run) || substr(any_value(x), 2 * max(b) + 1) AS kept
  FROM pieces JOIN n USING (doc_id) GROUP BY doc_id)
SELECT doc_id, n_bytes, coalesce(n_removed, 0) AS n_removed, coalesce(n_spans, 0) AS n_spans, sha256(unhex(coalesce(kept, x))) AS kept_sha256
FROM n LEFT JOIN cut USING (doc_id)
"""

SEARCH_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id,
         regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms
  FROM documents),
n AS (SELECT r, doc_id, len(terms) AS n FROM d WHERE len(terms) > 0),
total AS (SELECT count(*)::BIGINT AS nn, sum(n)::BIGINT AS ll FROM n),
tf AS (SELECT r, t, count(*) AS tf FROM (SELECT r, unnest(terms) AS t FROM d) GROUP BY r, t),
item AS (
  SELECT DISTINCT item_id, text AS item,
         unnest(list_distinct(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+'))) AS t
  FROM benchmark),
w AS (
  SELECT t, CAST(floor(1000 * ln((2 * nn + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE)) AS BIGINT) AS w
  FROM tf, total WHERE t IN (SELECT t FROM item) GROUP BY t, nn),
score AS (
  SELECT item_id, item, doc_id, r,
         sum(w * ((1000000000 * tf) // (1000 * tf + 20 * (100 - 50 + ((50 * n * nn) // ll)))))::BIGINT AS score
  FROM item JOIN w USING (t) JOIN tf USING (t) JOIN n USING (r), total GROUP BY item_id, item, doc_id, r),
ranked AS (
  SELECT item_id, row_number() OVER (PARTITION BY item_id, item ORDER BY score DESC, doc_id NULLS LAST)::INTEGER AS rank, doc_id, score
  FROM score WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 50
"""

DIVERGENCE_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS terms
  FROM documents),
found AS (SELECT DISTINCT lang, source FROM d),
tok AS (SELECT r, lang, source, unnest(terms) AS t FROM d),
kept AS (SELECT lang, t, count(*)::HUGEINT AS n FROM tok GROUP BY lang, t HAVING count(DISTINCT r) >= 10),
lang_total AS (SELECT lang, sum(n)::HUGEINT AS nn, count(*)::HUGEINT AS v FROM kept GROUP BY lang),
cnt AS (SELECT lang, source, t, count(*)::HUGEINT AS n FROM tok JOIN kept USING (lang, t) GROUP BY lang, source, t),
src_total AS (SELECT lang, source, sum(n)::HUGEINT AS nn FROM cnt GROUP BY lang, source),
share AS (
  SELECT lang, source, t, coalesce(c.n, 0) AS n,
         1 + (1000000000::HUGEINT * (coalesce(c.n, 0) + 2)) // (coalesce(s.nn, 0) + 2 * l.v) AS p,
         1 + (1000000000::HUGEINT * (k.n + 2)) // (l.nn + 2 * l.v) AS q
  FROM found f JOIN kept k USING (lang) JOIN lang_total l USING (lang)
  LEFT JOIN src_total s USING (lang, source) LEFT JOIN cnt c USING (lang, source, t)),
pair AS (
  SELECT a.lang, a.source, b.source AS item, sum(((a.p - b.p) * (a.p - b.p)) // (a.p + b.p)) AS value
  FROM share a JOIN share b ON a.lang = b.lang AND a.t = b.t AND a.source <> b.source GROUP BY ALL),
part AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(value, 0)::BIGINT AS value
  FROM found a JOIN found b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN pair p ON p.lang = a.lang AND p.source = a.source AND p.item = b.source
  UNION ALL
  SELECT lang, source, 'term', t, (((p - q) * (p - q)) // (p + q))::BIGINT FROM share WHERE n > 0 AND p > q),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item)::INTEGER AS rank FROM part)
SELECT lang, source, part, item, value, rank FROM ranked WHERE part = 'pair' OR rank <= 10
"""

MIXING_SQL = r"""
WITH d AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
         ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '') || chr(10) || coalesce(text, '')), 1, 15))::BIGINT AS h
  FROM documents),
src AS (
  SELECT source, sum(size)::HUGEINT AS source_size, ((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::HUGEINT AS w
  FROM d GROUP BY source),
-- the level if all sources with a smaller limit for their weight stop at it
tried AS (
  SELECT a.source_size AS a_size, a.w AS a_w,
         sum(b.source_size) - sum(CASE WHEN 3 * b.source_size * a.w < 3 * a.source_size * b.w THEN 3 * b.source_size ELSE 0 END) AS words,
         sum(CASE WHEN 3 * b.source_size * a.w < 3 * a.source_size * b.w THEN 0 ELSE b.w END) AS units
  FROM src a, src b GROUP BY a.source, a.source_size, a.w),
level AS (
  SELECT words::HUGEINT AS words, units::HUGEINT AS units FROM tried
  WHERE 3 * a_size * units >= a_w * words ORDER BY a_size::DOUBLE / a_w::DOUBLE LIMIT 1),
target AS (
  SELECT source, source_size, CASE WHEN 3 * source_size * units < w * words THEN (3 * source_size)::DOUBLE ELSE (w * words)::DOUBLE / units::DOUBLE END AS target,
         least(3 * source_size, round(CASE WHEN 3 * source_size * units < w * words THEN (3 * source_size)::DOUBLE ELSE (w * words)::DOUBLE / units::DOUBLE END)::HUGEINT) AS words
  FROM src, level),
plan AS (
  SELECT *, CASE WHEN source_size > 0 THEN words // source_size ELSE 0 END AS whole,
         words - CASE WHEN source_size > 0 THEN (words // source_size) * source_size ELSE 0 END AS need
  FROM target),
run AS (SELECT *, sum(size) OVER (PARTITION BY source ORDER BY h ROWS UNBOUNDED PRECEDING) AS run FROM d)
SELECT doc_id, size, source_size::BIGINT AS source_size, target,
       (size * (whole + CASE WHEN size > 0 AND need > 0 AND 2 * (need - run + size) >= size THEN 1 ELSE 0 END))::BIGINT AS taken
FROM run JOIN plan ON run.source IS NOT DISTINCT FROM plan.source
"""

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_minhash": q_minhash,
    "op2_bpe": q_bpe,
    "op3_toxicity": q_toxicity,
    "op4_simhash": q_simhash,
    "op5_packing": q_packing,
    "op6_langid": q_langid,
    "op7_secrets": q_secrets,
    "op8_quality": q_quality,
    "op9_suffix_dedup": q_suffix_dedup,
    "op10_exact_dedup": q_exact_dedup,
    "op11_search": q_search,
    "op12_divergence": q_divergence,
    "op13_mixing": q_mixing,
}

ORACLE_SQL: dict[str, str] = {
    "op9_suffix_dedup": SUFFIX_SQL,
    "op10_exact_dedup": EXACT_DEDUP_SQL,
    "op11_search": SEARCH_SQL,
    "op12_divergence": DIVERGENCE_SQL,
    "op13_mixing": MIXING_SQL,
}
