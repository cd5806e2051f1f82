"""Operations of a training-data pipeline: fingerprints, tokenizers, packing,
language and quality models, secret scans and three kinds of deduplication.

Nothing else in the library imports this subpackage.  Every operator takes and
returns DataFrames; ``queries.py`` registers one ``opN_<name>`` query each.
"""
