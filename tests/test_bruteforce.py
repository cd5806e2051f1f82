"""Pure-Python brute force against the Spark operators on random small inputs.

Independent of Spark's own window/regex semantics: the expected values are
computed with plain Python from the written rules."""

from __future__ import annotations

import random
import re

import pytest
from pyspark.sql import types as T

from riskloom.operators import behavior, calendar

from conftest import rows


# ------------------------------------------------------------ date parsing rule
def _int(s):
    if s is None:
        return None
    s = s.strip()
    return int(s) if re.fullmatch(r"[+-]?\d+", s) and abs(int(s)) < 2**31 else None


def _tok(parts, i):
    return parts[i] if parts is not None and i < len(parts) else None


def _parse(text, iso):
    clean = text.replace('"', "").strip(" ")
    parts = clean.split(" ")
    dp, tp = _tok(parts, 0), _tok(parts, 1)
    m = re.search(r"(19|20)\d{2}", dp)
    year = int(m.group(0)) if m else None
    slash, dash = "/" in dp, "-" in dp
    month = _tok(dp.split("/"), 0) if slash else None
    day = _tok(dp.split("/"), 1) if slash else None
    if month is None and dash:
        month = _tok(dp.split("-"), 1)
    if day is None and dash:
        day = _tok(dp.split("-"), 0)
    if iso and not slash and re.match(r"\d{4}-", dp):
        year, month, day = _int(_tok(dp.split("-"), 0)), _tok(dp.split("-"), 1), _tok(dp.split("-"), 2)
    colon = tp.split(":") if tp is not None else None
    return (year, _int(month), _int(day), _int(_tok(colon, 0)), _int(_tok(colon, 1)))


@pytest.mark.parametrize("iso", [False, True])
def test_date_rule_matches_python(spark, iso):
    rnd = random.Random(17 if iso else 3)
    atoms = ["1", "01", "12", "31", "2019", "1999", "2024", "/", "-", " ", ":", '"', "x", "00", "7", "13"]
    texts = ["".join(rnd.choice(atoms) for _ in range(rnd.randint(1, 9))) for _ in range(600)]
    texts += ["1/2/2019 10:05", "02-01-2019 7:3", "2019-03-04 23:59", "2019-03-04", "/5/2019", "5//2019 :"]
    schema = T.StructType([T.StructField("i", T.IntegerType()), T.StructField("trans_date_trans_time", T.StringType())])
    df = spark.createDataFrame(list(enumerate(texts)), schema)
    got = {r[0]: r[1:] for r in rows(calendar.parse_datetime(df, iso_dates=iso), "i", *calendar.FIELDS)}
    for i, t in enumerate(texts):
        assert got[i] == _parse(t, iso), t


# ------------------------------------------------------------ behaviour windows
def _expected(events, frame, unit):
    """events: list of (user, trans_num, clock or None, amt)."""
    out = {}
    by_user = {}
    for e in events:
        by_user.setdefault(e[0], []).append(e)
    for user, evs in by_user.items():
        n = len(evs)
        amts = [e[3] for e in evs if e[3] is not None]
        avg = sum(amts) / len(amts) if amts else None
        order = sorted(evs, key=lambda e: (e[2] is not None, e[2] if e[2] is not None else 0, e[1]))
        prev = None
        for e in order:
            clock = e[2]
            if clock is None:
                cnt = sum(1 for x in evs if x[2] is None)
            else:
                cnt = sum(1 for x in evs if x[2] is not None and clock - frame <= x[2] <= clock)
            gap = (clock - prev) / unit if (prev is not None and clock is not None) else -1.0
            out[e[1]] = (n, avg, cnt, gap)
            prev = clock
    return out


@pytest.mark.parametrize("seed", [1, 2])
def test_windows_match_python(spark, seed):
    rnd = random.Random(seed)
    events = []
    base = 1_700_000_000
    for u in range(6):
        hot = u == 0
        for j in range(120 if hot else rnd.randint(1, 25)):
            clock = None if rnd.random() < 0.08 else base + rnd.choice([0, 1, 59, 3600, 86399, 86400, 86401]) * rnd.randint(0, 40)
            amt = None if rnd.random() < 0.05 else round(rnd.random() * 100, 2)
            events.append((f"u{u}", f"t{u}-{j:03d}", clock, amt))
    schema = T.StructType(
        [
            T.StructField("user_id", T.StringType()),
            T.StructField("trans_num", T.StringType()),
            T.StructField("epoch_seconds", T.LongType()),
            T.StructField("amt", T.DoubleType()),
        ]
    )
    df = spark.createDataFrame(events, schema)
    for spec in (behavior.EPOCH, behavior.ClockSpec("epoch_seconds", 86400, 3600.0, 600)):
        want = _expected(events, spec.frame, spec.unit)
        out = behavior.sequence_features(df, spec=spec)
        got = rows(out, "trans_num", "user_transaction_count", "user_avg_amt", "trans_count_last_24h", "hours_since_last_trans")
        assert len(got) == len(events)
        for t, n, avg, cnt, gap in got:
            w = want[t]
            assert (n, cnt) == (w[0], w[2]), t
            assert avg == pytest.approx(w[1]) and gap == pytest.approx(w[3]), t


def test_packed_window_is_real_24h_truncated_at_month_start(spark):
    """SURVEY property: packed W6 = count over [max(month start, t - 24 h), t]
    on real time -- checked on every ``orders`` row (dates across 1995-2001)."""
    import datetime as dt

    from pyspark.sql import functions as F

    from conftest import SF_SMALL

    o = spark.read.parquet(f"{SF_SMALL}/orders.parquet").select(
        F.col("o_orderkey").cast("string").alias("trans_num"),
        F.col("o_custkey").cast("string").alias("user_id"),
        F.date_format("o_orderdate", "M/d/yyyy HH:mm").alias("trans_date_trans_time"),
        F.col("o_totalprice").alias("amt"),
    )
    feats = behavior.sequence_features(calendar.calendar_features(o), spec=behavior.PACKED)
    got = rows(feats, "trans_num", "user_id", "year", "month", "day", "hour", "minute", "trans_count_last_24h")
    by_user = {}
    for t, u, y, mo, d, h, mi, _ in got:
        by_user.setdefault(u, []).append(dt.datetime(y, mo, d, h, mi))
    for t, u, y, mo, d, h, mi, cnt in got:
        now = dt.datetime(y, mo, d, h, mi)
        lo = max(now.replace(day=1, hour=0, minute=0), now - dt.timedelta(hours=24))
        assert cnt == sum(1 for x in by_user[u] if lo <= x <= now), t


# ------------------------------------------------------------ cleaning / typing
_WS = " \t\n\x0b\f\r"  # Java's \s


def _c1c2(s):
    if s is None:
        return None
    s = s.replace("\\", "").replace('"', "")
    s = re.sub(f"[{re.escape(_WS)}]+", " ", s).strip(" ")
    return None if s in ("", "null", "NULL", "None") else s


def _c3c4(s):
    if s is None:
        return None
    s = re.sub(r'[\\"\t\r\n]+', " ", s)
    s = re.sub(f"[{re.escape(_WS)}]+", " ", s)
    s = re.sub(f"^[{re.escape(_WS)}]+|[{re.escape(_WS)}]+$", "", s)
    return None if s == "" else s


def _p1(s):
    m = re.match(r"[01]", s) if s is not None else None
    return int(m.group(0)) if m else None


def _p4(s):
    m = re.search(r"\d+", s) if s is not None else None
    if not m:
        return None
    v = int(m.group(0))
    return v if v < 2**31 else None


def test_cleaning_and_typing_rules_match_python(spark):
    from riskloom.operators import cleaning

    rnd = random.Random(23)
    atoms = ["a", "B", " ", "  ", "\t", "\n", "\r", "\x0b", "\\", '"', "null", "NULL", "None", "0", "1", "10", "-", ",", "99999999999"]
    vals = ["".join(rnd.choice(atoms) for _ in range(rnd.randint(0, 6))) for _ in range(800)] + [None]
    schema = T.StructType(
        [T.StructField("i", T.IntegerType())]
        + [T.StructField(c, T.StringType()) for c in ("job", "merchant", "is_fraud", "city_pop")]
    )
    df = spark.createDataFrame([(i, v, v, v, v) for i, v in enumerate(vals)], schema)
    text = {r[0]: r[1] for r in rows(cleaning.clean_string_columns(df, ["job"]), "i", "job")}
    merch = {r[0]: r[1] for r in rows(cleaning.clean_merchant(df), "i", "merchant")}
    typed = {r[0]: r[1:] for r in rows(cleaning.cast_columns(df), "i", "is_fraud", "city_pop")}
    for i, v in enumerate(vals):
        assert text[i] == _c1c2(v), repr(v)
        assert merch[i] == _c3c4(v), repr(v)
        assert typed[i] == (_p1(v), _p4(v)), repr(v)
