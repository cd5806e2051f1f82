"""Date/time parsing from free text (T1-T4, T9, T10) as column expressions.

Time never becomes a timestamp column in the source data: the text is split into
tokens, layouts are dispatched with ``when``/``coalesce``, and two clocks are
derived from the integer fields -- the packed ``YYYYMMDDHHMM`` number and real
epoch seconds.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from riskloom.functions.text import without

# Fixed values (reference behaviour): year = first 19xx/20xx run of the date part.
YEAR_PATTERN = r"(19|20)\d{2}"
ISO_PREFIX = r"^\d{4}-"


def date_clean(c: Column) -> Column:
    """Strip double quotes and trim."""
    return F.trim(without(c, '"'))




def parse_from_parts(dp: Column, tp: Column, slash: Column, dash: Column, colon: Column, iso_dates: bool = True) -> dict[str, Column]:
    """T2-T4 from pre-split tokens; returns int columns year .. minute.

    Layout dispatch: ``/`` -> M/D/Y (token 0 month, token 1 day); ``-`` -> D-M-Y
    (token 0 day, token 1 month); ``/`` wins.  With ``iso_dates`` (default) a date
    part starting with four digits and ``-`` is read as Y-M-D; without it the
    literal rule is kept, which reads the year as the day.
    """
    year = F.regexp_extract(dp, YEAR_PATTERN, 0).try_cast("int")
    has_slash = dp.contains("/")
    has_dash = dp.contains("-")
    month_txt = F.coalesce(F.when(has_slash, F.get(slash, 0)), F.when(has_dash, F.get(dash, 1)))
    day_txt = F.coalesce(F.when(has_slash, F.get(slash, 1)), F.when(has_dash, F.get(dash, 0)))
    if iso_dates:
        is_iso = (~has_slash) & dp.rlike(ISO_PREFIX)
        month_txt = F.when(is_iso, F.get(dash, 1)).otherwise(month_txt)
        day_txt = F.when(is_iso, F.get(dash, 2)).otherwise(day_txt)
        year = F.when(is_iso, F.get(dash, 0).try_cast("int")).otherwise(year)
    return {
        "year": year,
        "month": month_txt.try_cast("int"),
        "day": day_txt.try_cast("int"),
        "hour": F.get(colon, 0).try_cast("int"),
        "minute": F.get(colon, 1).try_cast("int"),
    }


def packed_clock(year: Column, month: Column, day: Column, hour: Column, minute: Column) -> Column:
    """Y*10^8 + M*10^6 + D*10^4 + H*100 + Min as long; NULL if any part is NULL.

    This is the reference's clock.  It is an ordering key, not elapsed time:
    differences count days inside a month and jump at month ends.
    """
    return (
        year.cast("long") * 100000000
        + month.cast("long") * 1000000
        + day.cast("long") * 10000
        + hour.cast("long") * 100
        + minute.cast("long")
    )


def epoch_clock(year: Column, month: Column, day: Column, hour: Column, minute: Column) -> Column:
    """Real epoch seconds of the same fields (time-zone independent); NULL
    if any part is NULL or the fields are not a real calendar time."""
    ts = F.try_make_timestamp_ntz(year, month, day, hour, minute, F.lit(0))
    return F.unix_timestamp(ts)
