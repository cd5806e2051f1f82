"""Text-cleaning column expressions (all JVM built-ins, codegen friendly)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values that must equal the reference's behaviour.
# Sentinel spellings turned into NULL after cleaning (case-exact, after trim):
NULL_SENTINELS = ("", "null", "NULL", "None")
# Text columns normalised by the generic cleaner, in this order:
TEXT_COLUMNS = ("merchant", "job", "category", "city", "state", "trans_num", "dob")


def without(c: Column, *chars: str) -> Column:
    """Delete characters (``translate`` copies every text, a search only those it finds something in)."""
    for char in chars:
        c = F.replace(c, F.lit(char), F.lit(""))
    return c


def normalize_text(c: Column) -> Column:
    r"""Delete backslashes and double quotes, fold tab/CR/LF runs and whitespace
    runs into one space, trim.

    One regex pass instead of four: the two characters are deleted by searches that leave a
    text without them as it is, and folding ``[\t\r\n]+`` before collapsing ``\s+`` gives the same text as
    collapsing ``\s+`` alone (every such run ends up as one space)."""
    s = without(c.cast("string"), "\\", '"')
    s = F.regexp_replace(s, r"\s+", " ")
    return F.trim(s)


def null_if_sentinel(c: Column) -> Column:
    """The sentinel spellings become NULL."""
    return F.when(F.array_contains(F.array(*[F.lit(s) for s in NULL_SENTINELS]), c), F.lit(None).cast("string")).otherwise(c)


def merchant_spacing(c: Column) -> Column:
    r"""Runs of backslash/quote/tab/CR/LF become ONE space (replace, not
    delete), whitespace collapses, ends are stripped.

    One regex pass: a run of those characters and of whitespace becomes a
    single space either way, so ``[\\"\s]+`` -> ' ' followed by a trim gives
    the same text as the three-step form."""
    return F.trim(F.regexp_replace(c.cast("string"), r'[\\"\s]+', " "))


def blank_to_null(s: Column) -> Column:
    """C4: a blank value is NULL (after ``merchant_spacing`` blank means empty)."""
    return F.nullif(s, F.lit(""))


def clean_merchant_text(c: Column) -> Column:
    """C3 + C4 as one expression."""
    return blank_to_null(merchant_spacing(c))


def join_key(*cols: Column | str, sep: str = "_") -> Column:
    """Concatenate with a separator, skipping NULL parts (all NULL -> '')."""
    return F.concat_ws(sep, *[F.col(c) if isinstance(c, str) else c for c in cols])
