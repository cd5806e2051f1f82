"""Column-expression builders: text cleaning, safe casts, clocks, hashes, statistics."""

from riskloom.functions.casts import first_int, parse_label, strip_quotes, to_double, to_float
from riskloom.functions.clock import epoch_clock, packed_clock
from riskloom.functions.stats import hash32, ordered_bits
from riskloom.functions.text import clean_merchant_text, join_key, normalize_text

__all__ = [
    "clean_merchant_text",
    "epoch_clock",
    "first_int",
    "hash32",
    "join_key",
    "normalize_text",
    "ordered_bits",
    "packed_clock",
    "parse_label",
    "strip_quotes",
    "to_double",
    "to_float",
]
