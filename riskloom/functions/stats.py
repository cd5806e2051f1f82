"""Hashing and ordering expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def hash32(key: Column, salt: str | None = None) -> Column:
    """Unsigned 32-bit hash of a key: first 8 hex digits of md5, as bigint.

    Portable (any SQL engine with md5 computes the same number) and independent
    of partitioning, unlike ``rand``/``sample(seed)``.
    """
    k = key.cast("string")
    if salt:
        k = F.concat(k, F.lit(salt))
    return F.conv(F.substring(F.md5(k), 1, 8), 16, 10).cast("bigint")


def ordered_bits(x: Column) -> Column:
    """A double as a 64-bit integer of the same order: its IEEE 754 bits, with the order of
    negative numbers turned.

    0.0 and -0.0 are 0; infinite values lie beyond the finite ones; NULL and NaN are
    for the caller to leave out.  One call of the JVM's own conversion: the bits as an expression of
    logarithms and powers grow a stage's code beyond what the JVM compiles."""
    bits = F.reflect(F.lit("java.lang.Double"), F.lit("doubleToLongBits"), F.abs(x)).cast("long")
    return F.when(x < 0, -bits).when(x >= 0, bits)  # no call for NULL
