"""ANSI-safe typing expressions for text columns.

Spark 4 runs with ANSI mode on, where ``cast('' as int)`` raises; every text
cast here is a ``try_cast`` so malformed values become NULL instead.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from riskloom.functions.text import without

# Fixed values (reference behaviour): the label keeps only a leading 0/1, the
# population keeps its first digit run.
LABEL_PATTERN = r"^([01])"
DIGITS_PATTERN = r"(\d+)"
GEO_COLUMNS = ("lat", "long", "merch_lat", "merch_long")


def parse_label(c: Column) -> Column:
    """First character must be 0 or 1 ('10' -> 1, ' 1' -> NULL)."""
    return F.regexp_extract(c, LABEL_PATTERN, 1).try_cast("int")


def strip_quotes(c: Column) -> Column:
    """Remove double quotes and trim."""
    return F.trim(without(c, '"'))


def to_float(c: Column) -> Column:
    """32-bit float, NULL when not a number."""
    return c.try_cast("float")


def first_int(c: Column) -> Column:
    """First digit run as int ('1,234' -> 1, '-5' -> 5, 'x' -> NULL)."""
    return F.regexp_extract(c, DIGITS_PATTERN, 1).try_cast("int")


def to_double(c: Column) -> Column:
    """P5: double, NULL when not a number."""
    return c.try_cast("double")
