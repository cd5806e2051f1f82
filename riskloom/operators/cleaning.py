"""Text cleaning (C1-C4) and typing (P1-P7) as one-projection operators."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.functions import casts, text


def present(df: DataFrame, wanted: Sequence[str], missing: str = "skip") -> list[str]:
    """The wanted columns that exist, in order.  ``missing="error"`` raises
    on an absent column instead of skipping it."""
    have = set(df.columns)
    absent = [c for c in wanted if c not in have]
    if absent and missing == "error":
        raise ValueError(f"missing required columns: {absent}")
    return [c for c in wanted if c in have]


def clean_string_columns(
    df: DataFrame, columns: Sequence[str] = text.TEXT_COLUMNS, missing: str = "skip"
) -> DataFrame:
    """C1 + C2 (+ P7): normalise text columns and turn sentinels into NULL.

    One ``withColumns`` projection for all columns (no per-column job or plan
    growth)."""
    cols = present(df, columns, missing)
    if not cols:
        return df
    # Two projections: the sentinel test reads the normalised text twice, and
    # Catalyst will not merge them (that would run the regex chain twice).
    normalized = df.withColumns({c: text.normalize_text(F.col(c)) for c in cols})
    return normalized.withColumns({c: text.null_if_sentinel(F.col(c)) for c in cols})


def clean_merchant(df: DataFrame, column: str = "merchant") -> DataFrame:
    """C3 + C4: merchant-specific cleaning (replace, not delete) and blank -> NULL."""
    if column not in df.columns:
        return df
    staged = df.withColumn(column, text.merchant_spacing(F.col(column)))
    return staged.withColumn(column, text.blank_to_null(F.col(column)))


def cast_columns(df: DataFrame) -> DataFrame:
    """Type the raw text columns that exist, ANSI-safe (bad text -> NULL)."""
    exprs = {}
    if "is_fraud" in df.columns:
        exprs["is_fraud"] = casts.parse_label(F.col("is_fraud"))
    if "trans_date_trans_time" in df.columns:
        exprs["trans_date_trans_time"] = casts.strip_quotes(F.col("trans_date_trans_time"))
    if "amt" in df.columns:
        exprs["amt"] = casts.to_float(F.col("amt"))
    if "city_pop" in df.columns:
        exprs["city_pop"] = casts.first_int(F.col("city_pop"))
    for c in casts.GEO_COLUMNS:
        if c in df.columns:
            exprs[c] = casts.to_double(F.col(c))
    return df.withColumns(exprs) if exprs else df


def clean_and_type(df: DataFrame) -> DataFrame:
    """C1-C4 then P1-P5 in a single projection chain (collapsed by Catalyst)."""
    return df.transform(clean_string_columns).transform(clean_merchant).transform(cast_columns)
