"""Independent DuckDB SQL for every SQL-expressible registered query.

The views ``events``/``orders``/... are pre-registered by the checker.  Each
query is written directly from the operator semantics (plain per-user windows,
global ``row_number``), not from the Spark plan, so the two sides check each
other.  Keys trained with MLlib (``*_scores``, ``model_metrics``, ``model_roundtrip``,
``run_pipeline``) return what SQL can tell: which rows and models are there, and
that scores, predictions and stored models agree.
"""

from __future__ import annotations

from riskloom.operators.modeling import MODEL_FEATURES, MODEL_NAMES
from riskloom.operators.profiling import CORRELATION_FEATURES as _CORR

FEATURES11 = list(MODEL_FEATURES)
CORR_FEATURES = list(_CORR)


def _hash(expr: str) -> str:
    return f"('0x' || substring(md5(CAST({expr} AS VARCHAR)), 1, 8))::BIGINT"


def _c1(col: str) -> str:
    """C1 normalisation (without the sentinel step)."""
    x = f"CAST({col} AS VARCHAR)"
    x = f"regexp_replace({x}, '\\\\', '', 'g')"
    x = f"regexp_replace({x}, '\"', '', 'g')"
    x = f"regexp_replace({x}, '[\\t\\r\\n]+', ' ', 'g')"
    x = f"regexp_replace({x}, '\\s+', ' ', 'g')"
    return f"trim({x})"


def _sentinel(col: str) -> str:
    return f"CASE WHEN {col} IN ('', 'null', 'NULL', 'None') THEN NULL ELSE {col} END"


RAW = r"""raw AS (
  SELECT CAST(event_id AS VARCHAR) AS trans_num,
    CASE WHEN event_id % 101 = 0 THEN 'not-a-date'
         WHEN event_id % 2 = 0 THEN strftime(ts, '%d-%m-%Y %H:%M')
         ELSE strftime(ts, '%-m/%-d/%Y %H:%M') END AS trans_date_trans_time,
    CASE WHEN event_id % 89 = 0 THEN NULL ELSE CAST(value AS VARCHAR) END AS amt,
    CASE WHEN event_id % 97 = 0 THEN NULL WHEN event_type = 'error' THEN '1' ELSE '0' END AS is_fraud,
    CASE WHEN event_id % 13 = 0 THEN ' null' WHEN event_id % 11 = 0 THEN 'NULL'
         ELSE concat('  ', props, chr(92), chr(9), chr(10), 'x ') END AS merchant,
    event_type AS category,
    concat('city', CAST(user_id % 10 AS VARCHAR)) AS city,
    CASE WHEN user_id % 7 = 0 THEN NULL ELSE concat('job', CAST(user_id % 5 AS VARCHAR)) END AS job,
    CAST(user_id AS VARCHAR) AS dob
  FROM events)"""

RAW_CONTRACT = r"""raw AS (
  SELECT CAST(event_id AS VARCHAR) AS trans_num,
    CASE WHEN event_id % 5 = 0 THEN strftime(ts, '%d-%m-%Y')
         WHEN event_id % 3 = 0 THEN concat(' "', strftime(ts, '%d-%m-%Y %H:%M'), '"')
         ELSE strftime(ts, '%d-%m-%Y %H:%M') END AS trans_date_trans_time,
    CASE WHEN event_id % 89 = 0 THEN NULL ELSE CAST(value AS VARCHAR) END AS amt,
    CASE WHEN event_id % 7 = 0 THEN '10' WHEN event_id % 11 = 0 THEN ' 1' WHEN event_id % 13 = 0 THEN '0"2020'
         WHEN event_type = 'error' THEN '1' ELSE '0' END AS is_fraud,
    CASE WHEN event_id % 4 = 0 THEN '' WHEN event_id % 9 = 0 THEN 'None' ELSE props END AS merchant,
    event_type AS category,
    concat('city', CAST(user_id % 10 AS VARCHAR)) AS city,
    CASE WHEN user_id % 7 = 0 THEN ' None ' ELSE concat('job', CAST(user_id % 5 AS VARCHAR)) END AS job,
    CAST(user_id AS VARCHAR) AS dob,
    CASE WHEN event_id % 8 = 0 THEN 'None' WHEN event_id % 6 = 0 THEN ''
         ELSE concat('S', chr(9), CAST(user_id % 6 AS VARCHAR)) END AS state,
    CASE WHEN event_id % 6 = 0 THEN NULL WHEN event_id % 10 = 1 THEN 'x' WHEN event_id % 50 = 2 THEN '1,234'
         ELSE concat(CAST(event_id % 5 * 100 AS VARCHAR), ' people') END AS city_pop,
    CASE WHEN event_id % 12 = 0 THEN 'n/a' ELSE concat(CAST(user_id % 90 AS VARCHAR), '.25') END AS lat,
    CASE WHEN event_id % 12 = 1 THEN NULL ELSE concat('-', CAST(user_id % 180 AS VARCHAR), '.5') END AS long,
    concat(CAST(event_id % 90 AS VARCHAR), '.125') AS merch_lat,
    CASE WHEN event_id % 12 = 2 THEN '' ELSE CAST(event_id % 180 AS VARCHAR) END AS merch_long
  FROM events)"""

_TEXT = ["merchant", "category", "city", "job", "dob"]

CLEANED = (
    "cleaned0 AS (SELECT "
    + ", ".join([f"{_c1('trans_num')} AS trans_num", "trans_date_trans_time", "amt", "is_fraud"])
    + ", "
    + ", ".join(f"{_c1(c)} AS {c}" for c in _TEXT)
    + " FROM raw),\ncleaned AS (SELECT "
    + ", ".join(
        [_sentinel("trans_num") + " AS trans_num", "trans_date_trans_time", "amt", "is_fraud"]
        + [f"{_sentinel(c)} AS {c}" for c in _TEXT]
    )
    + " FROM cleaned0)"
)

TYPED = r"""typed AS (
  SELECT trans_num,
    trim(replace(trans_date_trans_time, '"', '')) AS trans_date_trans_time,
    TRY_CAST(amt AS FLOAT) AS amt,
    TRY_CAST(regexp_extract(is_fraud, '^([01])', 1) AS INTEGER) AS is_fraud,
    merchant, category, city, job, dob
  FROM cleaned)"""

PREPARED = r"""prepared AS (
  SELECT coalesce(trans_num, 'unknown') AS trans_num,
    coalesce(trans_date_trans_time, 'unknown') AS trans_date_trans_time,
    amt, is_fraud,
    coalesce(merchant, 'unknown') AS merchant, coalesce(category, 'unknown') AS category,
    coalesce(city, 'unknown') AS city, coalesce(job, 'unknown') AS job, coalesce(dob, 'unknown') AS dob
  FROM typed WHERE amt IS NOT NULL AND is_fraud IS NOT NULL)"""


def _parsed(name: str, src: str, iso: bool) -> str:
    month = (
        "coalesce(CASE WHEN contains(dp, '/') THEN str_split(dp, '/')[1] END, "
        "CASE WHEN contains(dp, '-') THEN str_split(dp, '-')[2] END)"
    )
    day = (
        "coalesce(CASE WHEN contains(dp, '/') THEN str_split(dp, '/')[2] END, "
        "CASE WHEN contains(dp, '-') THEN str_split(dp, '-')[1] END)"
    )
    year = r"TRY_CAST(regexp_extract(dp, '(19|20)\d{2}', 0) AS INTEGER)"
    if iso:
        iso_c = r"(NOT contains(dp, '/') AND regexp_matches(dp, '^\d{4}-'))"
        month = f"CASE WHEN {iso_c} THEN str_split(dp, '-')[2] ELSE {month} END"
        day = f"CASE WHEN {iso_c} THEN str_split(dp, '-')[3] ELSE {day} END"
        year = f"CASE WHEN {iso_c} THEN TRY_CAST(str_split(dp, '-')[1] AS INTEGER) ELSE {year} END"
    return f"""{name} AS (
  SELECT * EXCLUDE (dc, dp, tp),
    {year} AS year,
    TRY_CAST({month} AS INTEGER) AS month,
    TRY_CAST({day} AS INTEGER) AS day,
    TRY_CAST(str_split(tp, ':')[1] AS INTEGER) AS hour,
    TRY_CAST(str_split(tp, ':')[2] AS INTEGER) AS minute
  FROM (SELECT *, str_split(dc, ' ')[1] AS dp, str_split(dc, ' ')[2] AS tp
        FROM (SELECT *, trim(replace(trans_date_trans_time, '"', '')) AS dc FROM {src})))"""


CALENDAR = r"""cal AS (
  SELECT *,
    CASE WHEN hour >= 22 OR hour <= 5 THEN 1 ELSE 0 END AS is_night,
    CASE WHEN hour >= 9 AND hour <= 17 THEN 1 ELSE 0 END AS is_business_hours,
    day AS day_of_month,
    CAST(year AS BIGINT) * 100000000 + CAST(month AS BIGINT) * 1000000 + CAST(day AS BIGINT) * 10000
      + CAST(hour AS BIGINT) * 100 + CAST(minute AS BIGINT) AS trans_seconds,
    CAST(epoch(try(make_timestamp(year, month, day, hour, minute, 0.0))) AS BIGINT) AS epoch_seconds,
    concat_ws('_', city, job, dob) AS user_id
  FROM parsed WHERE year IS NOT NULL AND month IS NOT NULL AND day IS NOT NULL)"""


def _seq(name: str, clock: str, frame: int, unit: float) -> str:
    return f"""{name}_w AS (
  SELECT *,
    count(*) OVER (PARTITION BY user_id) AS user_transaction_count,
    avg(CAST(amt AS DOUBLE)) OVER (PARTITION BY user_id) AS user_avg_amt,
    lag({clock}) OVER (PARTITION BY user_id ORDER BY {clock} ASC NULLS FIRST, trans_num) AS prev_clock,
    count(*) OVER (PARTITION BY user_id ORDER BY {clock} ASC NULLS FIRST
                   RANGE BETWEEN {frame} PRECEDING AND CURRENT ROW) AS trans_count_last_24h
  FROM cal),
{name} AS (
  SELECT *, CASE WHEN hours_since_last_trans BETWEEN 0 AND 1 THEN 1 ELSE 0 END AS is_rapid_transaction
  FROM (SELECT *, CASE WHEN prev_clock IS NOT NULL
                       THEN CAST({clock} - prev_clock AS DOUBLE) / CAST({unit} AS DOUBLE)
                       ELSE -1.0::DOUBLE END AS hours_since_last_trans
        FROM {name}_w))"""


def chain(*parts: str) -> str:
    return "WITH " + ",\n".join(parts) + "\n"


BASE_TYPED = [RAW, CLEANED, TYPED]
BASE_CAL = BASE_TYPED + [PREPARED, _parsed("parsed", "prepared", True), CALENDAR]
BASE_FEAT = BASE_CAL + [_seq("feat", "epoch_seconds", 86400, 3600.0)]
BASE_PACKED = BASE_CAL + [_seq("feat", "trans_seconds", 10000, 10000.0)]


def _r6(c: str) -> str:
    return f"(round({c}, 6) + CAST(0 AS DOUBLE)) AS {c}"


FEATURE_OUTPUT = [
    "trans_num",
    "user_id",
    "amt",
    "is_fraud",
    "hour",
    "minute",
    "is_night",
    "is_business_hours",
    "day_of_month",
    "trans_seconds",
    "epoch_seconds",
    "user_transaction_count",
    "user_avg_amt",
    "hours_since_last_trans",
    "is_rapid_transaction",
    "trans_count_last_24h",
]


def _feat_cols(cols: list[str]) -> str:
    return ", ".join(_r6(c) if c in ("user_avg_amt", "hours_since_last_trans") else c for c in cols)


def _corr(a: str, b: str) -> str:
    da, db = f"CAST({a} AS DOUBLE)", f"CAST({b} AS DOUBLE)"
    den = f"(stddev_samp({da}) * stddev_samp({db}))"
    return f"CASE WHEN {den} = 0 THEN NULL ELSE covar_samp({da}, {db}) / {den} END"


def _complete(cols: list[str]) -> str:
    return " AND ".join(f"{c} IS NOT NULL AND NOT isnan(CAST({c} AS DOUBLE))" for c in cols)


def _correlation_matrix() -> str:
    cols = CORR_FEATURES
    pairs = [(a, b) for i, a in enumerate(cols) for b in cols[i:]]
    aggs = ", ".join(f'{_corr(a, b)} AS "{a}|{b}"' for a, b in pairs)
    rows = []
    for a, b in pairs:
        rows.append(f"SELECT '{a}' AS feature_a, '{b}' AS feature_b, \"{a}|{b}\" AS c FROM m")
        if a != b:
            rows.append(f"SELECT '{b}', '{a}', \"{a}|{b}\" FROM m")
    return (
        chain(*BASE_FEAT, f"m AS (SELECT {aggs} FROM feat WHERE {_complete(cols)})")
        + "SELECT feature_a, feature_b, CAST((round_even(c, 3) + CAST(0 AS DOUBLE)) AS DOUBLE) AS corr FROM ("
        + " UNION ALL ".join(rows)
        + ")"
    )


def _label_corr_top5() -> str:
    feats = [c for c in CORR_FEATURES if c != "is_fraud"]
    aggs = ", ".join(f'{_corr(c, "is_fraud")} AS "{c}"' for c in feats)
    rows = " UNION ALL ".join(f"SELECT '{c}' AS feature, \"{c}\" AS c FROM m" for c in feats)
    return (
        chain(*BASE_FEAT, f"m AS (SELECT {aggs} FROM feat WHERE {_complete(CORR_FEATURES)})")
        + f"""SELECT CAST(rank AS INTEGER) AS rank, feature, CAST((round_even(c, 3) + CAST(0 AS DOUBLE)) AS DOUBLE) AS corr FROM (
  SELECT *, row_number() OVER (ORDER BY abs(c) DESC, feature) AS rank
  FROM ({rows}) WHERE c IS NOT NULL AND NOT isnan(c)) WHERE rank <= 5"""
    )


def _stats_by_class() -> str:
    parts = [
        "CAST((round_even(avg(CAST(amt AS DOUBLE)), 2) + CAST(0 AS DOUBLE)) AS DOUBLE) AS amt_mean",
        "CAST((round_even(quantile_cont(CAST(amt AS DOUBLE), 0.5), 2) + CAST(0 AS DOUBLE)) AS DOUBLE) AS amt_median",
        "CAST((round_even(stddev_samp(CAST(amt AS DOUBLE)), 2) + CAST(0 AS DOUBLE)) AS DOUBLE) AS amt_std",
        "count(amt) AS amt_count",
    ]
    for c in ("user_avg_amt", "user_transaction_count", "trans_count_last_24h"):
        parts += [
            f"CAST((round_even(avg(CAST({c} AS DOUBLE)), 2) + CAST(0 AS DOUBLE)) AS DOUBLE) AS {c}_mean",
            f"CAST((round_even(quantile_cont(CAST({c} AS DOUBLE), 0.5), 2) + CAST(0 AS DOUBLE)) AS DOUBLE) AS {c}_median",
        ]
    return chain(*BASE_FEAT) + f"SELECT is_fraud, {', '.join(parts)} FROM feat WHERE is_fraud IS NOT NULL GROUP BY is_fraud"


def _segment_rates() -> str:
    segs = [
        ("time_of_day", "night", "is_night = 1"),
        ("time_of_day", "day", "is_night = 0"),
        ("amount", "high", "CAST(amt AS DOUBLE) > (SELECT m_amt FROM med)"),
        ("amount", "low", "CAST(amt AS DOUBLE) <= (SELECT m_amt FROM med)"),
        ("frequency", "high", "CAST(user_transaction_count AS DOUBLE) > (SELECT m_cnt FROM med)"),
        ("frequency", "low", "CAST(user_transaction_count AS DOUBLE) <= (SELECT m_cnt FROM med)"),
        ("speed", "rapid", "is_rapid_transaction = 1"),
        ("speed", "normal", "is_rapid_transaction = 0"),
    ]
    rows = " UNION ALL ".join(
        f"""SELECT '{s}' AS segment, '{b}' AS bucket, count(*) AS n_rows,
  CAST((round_even(avg(CAST(is_fraud AS DOUBLE)) * 100.0, 4) + CAST(0 AS DOUBLE)) AS DOUBLE) AS fraud_pct
  FROM lab WHERE {cond}"""
        for s, b, cond in segs
    )
    return (
        chain(
            *BASE_FEAT,
            "lab AS (SELECT * FROM feat WHERE is_fraud IS NOT NULL)",
            "med AS (SELECT quantile_cont(CAST(amt AS DOUBLE), 0.5) AS m_amt, "
            "quantile_cont(CAST(user_transaction_count AS DOUBLE), 0.5) AS m_cnt FROM lab)",
        )
        + rows
    )


_SPLIT_KEY = "trans_num || '#split'"
SPLIT = f"CASE WHEN {_hash(_SPLIT_KEY)} % 100 < 70 THEN 'train' ELSE 'test' END"


def _undersample(src: str) -> str:
    return f"""cnt AS (SELECT count(*) FILTER (WHERE is_fraud = 1) AS n1, count(*) FILTER (WHERE is_fraud = 0) AS n0 FROM {src}),
par AS (SELECT CASE WHEN n1 <= n0 THEN 1 ELSE 0 END AS minority, least(n1, n0) AS n_min FROM cnt),
maj AS (SELECT s.*, row_number() OVER (ORDER BY {_hash('trans_num')}, trans_num) AS rn
        FROM {src} s, par WHERE s.is_fraud IN (0, 1) AND s.is_fraud <> par.minority),
bal AS (
  SELECT s.* FROM {src} s, par WHERE par.n_min > 0 AND s.is_fraud = par.minority
  UNION ALL
  SELECT maj.* EXCLUDE (rn) FROM maj, par WHERE par.n_min > 0 AND maj.rn <= par.n_min
  UNION ALL
  SELECT s.* FROM {src} s, par WHERE par.n_min = 0 AND s.is_fraud IN (0, 1))"""


def _oversample(src: str) -> str:
    return f"""cnt AS (SELECT count(*) FILTER (WHERE is_fraud = 1) AS n1, count(*) FILTER (WHERE is_fraud = 0) AS n0 FROM {src}),
par AS (SELECT CASE WHEN n1 <= n0 THEN 1 ELSE 0 END AS minority, least(n1, n0) AS n_min, greatest(n1, n0) AS n_maj FROM cnt),
mino AS (SELECT s.*, row_number() OVER (ORDER BY {_hash('trans_num')}, trans_num) AS rn
         FROM {src} s, par WHERE par.n_min > 0 AND s.is_fraud = par.minority),
bal AS (
  SELECT s.* FROM {src} s, par WHERE par.n_min > 0 AND s.is_fraud IN (0, 1) AND s.is_fraud <> par.minority
  UNION ALL
  SELECT mino.* EXCLUDE (rn) FROM mino, par,
    generate_series(1, CAST(par.n_maj // par.n_min + CASE WHEN mino.rn <= par.n_maj % par.n_min THEN 1 ELSE 0 END AS BIGINT)) AS g(i)
  UNION ALL
  SELECT s.* FROM {src} s, par WHERE par.n_min = 0 AND s.is_fraud IN (0, 1))"""


SCORED = """scored AS (
  SELECT trans_num, 'amt_rule' AS model, is_fraud,
         CASE WHEN amt > 40 THEN 1.0 ELSE 0.0 END::DOUBLE AS prediction, CAST(amt AS DOUBLE) AS score FROM cal
  UNION ALL
  SELECT trans_num, 'night_rule' AS model, is_fraud,
         CASE WHEN hour >= 22 OR hour <= 5 THEN 1.0 ELSE 0.0 END::DOUBLE AS prediction, CAST(-hour AS DOUBLE) AS score FROM cal)"""

CM = """cm AS (
  SELECT model,
    count(*) FILTER (WHERE is_fraud = 0 AND prediction = 0) AS tn,
    count(*) FILTER (WHERE is_fraud = 0 AND prediction = 1) AS fp,
    count(*) FILTER (WHERE is_fraud = 1 AND prediction = 0) AS fn,
    count(*) FILTER (WHERE is_fraud = 1 AND prediction = 1) AS tp
  FROM scored GROUP BY model)"""

AUC = """dist AS (
  SELECT model, score, CAST(count(*) FILTER (WHERE is_fraud = 1) AS DOUBLE) AS pos,
         CAST(count(*) FILTER (WHERE is_fraud = 0) AS DOUBLE) AS neg
  FROM scored WHERE score IS NOT NULL GROUP BY model, score),
cum AS (
  SELECT *, coalesce(sum(neg) OVER (PARTITION BY model ORDER BY score
                     ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS neg_below FROM dist),
auc AS (SELECT model, sum(pos * (neg_below + 0.5 * neg)) / (sum(pos) * sum(neg)) AS roc_auc FROM cum GROUP BY model)"""

METRICS = """rates AS (
  SELECT *, CASE WHEN tp + fp = 0 THEN 0.0 ELSE CAST(tp AS DOUBLE) / (tp + fp) END AS p1,
    CASE WHEN tp + fn = 0 THEN NULL ELSE CAST(tp AS DOUBLE) / (tp + fn) END AS r1,
    CASE WHEN tn + fn = 0 THEN 0.0 ELSE CAST(tn AS DOUBLE) / (tn + fn) END AS p0,
    CASE WHEN tn + fp = 0 THEN NULL ELSE CAST(tn AS DOUBLE) / (tn + fp) END AS r0
  FROM cm),
met AS (
  SELECT r.model, tn, fp, fn, tp,
    CAST(tp + tn AS DOUBLE) / (tn + fp + fn + tp) AS accuracy,
    p1 AS precision, r1 AS recall,
    (CAST(tn + fp AS DOUBLE) * f0 + CAST(fn + tp AS DOUBLE) * f1) / (tn + fp + fn + tp) AS f1_score,
    f1 AS f1_positive, a.roc_auc
  FROM (SELECT *,
          CASE WHEN p1 + coalesce(r1, 0) = 0 THEN 0.0 ELSE 2 * p1 * coalesce(r1, 0) / (p1 + coalesce(r1, 0)) END AS f1,
          CASE WHEN p0 + coalesce(r0, 0) = 0 THEN 0.0 ELSE 2 * p0 * coalesce(r0, 0) / (p0 + coalesce(r0, 0)) END AS f0
        FROM rates) r LEFT JOIN auc a ON r.model = a.model)"""

EVAL_BASE = BASE_CAL + [SCORED, CM, AUC, METRICS]
_METRIC_COLS = ["accuracy", "precision", "recall", "f1_score", "f1_positive", "roc_auc"]


def _scaled() -> str:
    stats = ", ".join(
        f"avg(CAST({c} AS DOUBLE)) AS m_{c}, stddev_samp(CAST({c} AS DOUBLE)) AS s_{c}" for c in FEATURES11
    )
    cols = ", ".join(
        f"(round(CASE WHEN s_{c} = 0 OR s_{c} IS NULL THEN 0.0 ELSE (CAST(coalesce({c}, 0) AS DOUBLE) - m_{c}) / s_{c} END, 6) + CAST(0 AS DOUBLE)) AS z_{c}"
        for c in FEATURES11
    )
    return (
        chain(*BASE_FEAT, f"st AS (SELECT {stats} FROM feat WHERE {SPLIT} = 'train')")
        + f"SELECT trans_num, {cols} FROM feat, st"
    )


def _feature_matrix() -> str:
    cols = ", ".join(f"(round(CAST(coalesce({c}, 0) AS DOUBLE), 6) + CAST(0 AS DOUBLE)) AS f_{c}" for c in FEATURES11)
    return chain(*BASE_FEAT) + f"SELECT trans_num, {cols} FROM feat"


def _model_cols() -> str:
    return ", ".join(
        _r6(c) if c in ("user_avg_amt", "hours_since_last_trans") else c for c in ["trans_num", "is_fraud", *FEATURES11]
    )


def _null_profile() -> str:
    typed_cols = ["trans_num", "trans_date_trans_time", "amt", "is_fraud", "merchant", "category", "city", "job", "dob"]
    before = " UNION ALL ".join(
        f"SELECT 'typed' AS stage, '{c}' AS column_name, count(*) FILTER (WHERE {c} IS NULL) AS null_count FROM typed"
        for c in typed_cols
    )
    after = " UNION ALL ".join(
        f"SELECT 'imputed', '{c}', count(*) FILTER (WHERE {c} IS NULL) FROM prepared" for c in typed_cols
    )
    return chain(*BASE_TYPED, PREPARED) + f"SELECT * FROM ({before}) WHERE null_count > 0 UNION ALL {after}"


def _impute_default() -> str:
    c3 = (
        "regexp_replace(regexp_replace(regexp_replace(merchant, '[\\\\\"\\t\\r\\n]+', ' ', 'g'), "
        "'\\s+', ' ', 'g'), '^\\s+|\\s+$', '', 'g')"
    )
    cols = ["trans_num", "trans_date_trans_time", "amt", "is_fraud", "merchant", "category", "city", "job", "dob"]
    sel = ", ".join(f"coalesce({c}, '0') AS {c}" for c in cols)
    return (
        chain(
            RAW,
            CLEANED,
            f"m AS (SELECT * REPLACE (CASE WHEN {c3} IS NULL OR regexp_matches({c3}, '^\\s*$') THEN NULL ELSE {c3} END AS merchant) FROM cleaned)",
        )
        + f"SELECT {sel} FROM m WHERE amt IS NOT NULL AND is_fraud IS NOT NULL"
    )


def _clean_merchant() -> str:
    c3 = (
        "regexp_replace(regexp_replace(regexp_replace(merchant, '[\\\\\"\\t\\r\\n]+', ' ', 'g'), "
        "'\\s+', ' ', 'g'), '^\\s+|\\s+$', '', 'g')"
    )
    return chain(RAW) + (
        f"SELECT trans_num, CASE WHEN {c3} IS NULL OR regexp_matches({c3}, '^\\s*$') THEN NULL ELSE {c3} END AS merchant FROM raw"
    )


MIXED = r"""mixed AS (
  SELECT CAST(o_orderkey AS VARCHAR) AS trans_num,
    CASE WHEN o_orderkey % 4 = 0 THEN strftime(o_orderdate, '%Y-%m-%d %H:%M')
         WHEN o_orderkey % 4 = 1 THEN strftime(o_orderdate, '%d-%m-%Y %H:%M')
         WHEN o_orderkey % 4 = 2 THEN strftime(o_orderdate, '%-m/%-d/%Y %-H:%M')
         ELSE strftime(o_orderdate, '%Y-%m-%d') END AS trans_date_trans_time
  FROM orders)"""

_F = "trans_num, year, month, day, hour, minute"


_CLEAN_STATE = "cs AS (SELECT trans_num, " + _sentinel("s") + f" AS state, city_pop, lat, long, merch_lat, merch_long FROM (SELECT *, {_c1('state')} AS s FROM raw))"
TYPED_CONTRACT = _CLEAN_STATE + r""",
typed_c AS (SELECT typed.*, cs.state,
    TRY_CAST(regexp_extract(city_pop, '(\d+)', 1) AS INTEGER) AS city_pop,
    TRY_CAST(lat AS DOUBLE) AS lat, TRY_CAST(long AS DOUBLE) AS long,
    TRY_CAST(merch_lat AS DOUBLE) AS merch_lat, TRY_CAST(merch_long AS DOUBLE) AS merch_long
  FROM typed JOIN cs USING (trans_num))"""


def build() -> dict[str, str]:
    q: dict[str, str] = {}
    q["csv_lines"] = chain(RAW) + (
        "SELECT * REPLACE (regexp_replace(merchant, '[\\n\\r]', ' ', 'g') AS merchant), "
        "CAST(NULL AS VARCHAR) AS absent, city AS city_of_short FROM raw"
    )
    on_contract = [RAW_CONTRACT if part is RAW else part for part in BASE_FEAT]
    q["typed_contract"] = chain(*on_contract[:3], TYPED_CONTRACT) + "SELECT * FROM typed_c"
    q["impute_contract"] = chain(*on_contract[:3], TYPED_CONTRACT) + (
        "SELECT trans_num, coalesce(city_pop, (SELECT quantile_disc(city_pop, 0.5) FROM typed_c WHERE amt IS NOT NULL AND is_fraud IS NOT NULL)) AS city_pop, "
        "coalesce(state, 'unknown') AS state, coalesce(job, 'unknown') AS job, coalesce(merchant, 'unknown') AS merchant "
        "FROM typed_c WHERE amt IS NOT NULL AND is_fraud IS NOT NULL"
    )
    q["features_contract"] = chain(*on_contract) + f"SELECT {_feat_cols(FEATURE_OUTPUT)} FROM feat"
    models = ", ".join(f"('{m}')" for m in MODEL_NAMES)
    test = chain(*BASE_FEAT, f"test AS (SELECT * FROM feat WHERE {SPLIT} = 'test')", f"models AS (SELECT * FROM (VALUES {models}) v(model))")
    for key in ("lr_scores", "rf_scores", "gbt_scores"):
        q[key] = test + "SELECT trans_num, is_fraud, true AS in_range, true AS follows FROM test"
    q["model_metrics"] = test + "SELECT model, (SELECT count(*) FROM test WHERE is_fraud IN (0, 1)) AS n_rows, true AS in_range FROM models"
    q["model_roundtrip"] = test + "SELECT trans_num, true AS same FROM test"
    q["run_pipeline"] = (
        chain(
            *BASE_FEAT,
            f"test AS (SELECT * FROM feat WHERE {SPLIT} = 'test')",
            f"tr AS (SELECT * FROM feat WHERE {SPLIT} = 'train')",
            _undersample("tr"),
            f"models AS (SELECT * FROM (VALUES {models}) v(model))",
        )
        + "SELECT model, (SELECT count(*) FROM test WHERE is_fraud IN (0, 1)) AS n_scored, (SELECT count(*) FROM bal) AS n_balanced, true AS proportions FROM models"
    )
    q["csv_roundtrip"] = chain(RAW) + "SELECT * FROM raw"
    q["typed"] = chain(*BASE_TYPED) + "SELECT * FROM typed"
    q["clean_strings"] = chain(RAW, CLEANED) + "SELECT trans_num, merchant, category, city, job, dob FROM cleaned"
    q["clean_merchant"] = _clean_merchant()
    q["null_profile"] = _null_profile()
    q["drop_essential"] = (
        chain(*BASE_TYPED) + "SELECT trans_num, amt, is_fraud FROM typed WHERE amt IS NOT NULL AND is_fraud IS NOT NULL"
    )
    q["impute_median"] = chain(*BASE_TYPED) + (
        "SELECT trans_num, coalesce(amt, CAST(coalesce((SELECT quantile_cont(CAST(amt AS DOUBLE), 0.5) "
        "FROM typed WHERE is_fraud IS NOT NULL), 0.0) AS FLOAT)) AS amt, is_fraud FROM typed WHERE is_fraud IS NOT NULL"
    )
    q["impute_unknown"] = chain(*BASE_TYPED, PREPARED) + "SELECT trans_num, merchant, job, trans_date_trans_time FROM prepared"
    q["impute_default"] = _impute_default()
    q["parsed_time"] = chain(*BASE_TYPED, _parsed("parsed", "typed", False)) + f"SELECT {_F} FROM parsed"
    q["parsed_time_iso"] = chain(MIXED, _parsed("parsed", "mixed", True)) + f"SELECT {_F} FROM parsed"
    q["valid_dates"] = (
        chain(*BASE_TYPED, PREPARED, _parsed("parsed", "prepared", True))
        + f"SELECT {_F} FROM parsed WHERE year IS NOT NULL AND month IS NOT NULL AND day IS NOT NULL"
    )
    q["calendar_flags"] = chain(*BASE_CAL) + "SELECT trans_num, hour, is_night, is_business_hours, day_of_month FROM cal"
    q["packed_clock"] = chain(*BASE_CAL) + "SELECT trans_num, trans_seconds FROM cal"
    q["epoch_clock"] = chain(*BASE_CAL) + "SELECT trans_num, epoch_seconds FROM cal"
    q["user_key"] = chain(*BASE_TYPED) + "SELECT trans_num, concat_ws('_', city, job, dob) AS user_id FROM typed"
    q["user_totals"] = chain(*BASE_FEAT) + (
        "SELECT trans_num, user_id, user_transaction_count, (round(user_avg_amt, 6) + CAST(0 AS DOUBLE)) AS user_avg_amt FROM feat"
    )
    q["prev_event"] = chain(*BASE_PACKED) + "SELECT trans_num, user_id, trans_seconds, prev_clock FROM feat"
    q["gap_features"] = chain(*BASE_PACKED) + (
        "SELECT trans_num, (round(hours_since_last_trans, 6) + CAST(0 AS DOUBLE)) AS hours_since_last_trans, is_rapid_transaction FROM feat"
    )
    q["trailing_count_packed"] = chain(*BASE_PACKED) + "SELECT trans_num, trans_count_last_24h FROM feat"
    q["trailing_count_24h"] = chain(*BASE_FEAT) + "SELECT trans_num, trans_count_last_24h FROM feat"
    q["gap_hours"] = chain(*BASE_FEAT) + (
        "SELECT trans_num, epoch_seconds, prev_clock, (round(hours_since_last_trans, 6) + CAST(0 AS DOUBLE)) AS hours_since_last_trans, "
        "is_rapid_transaction FROM feat"
    )
    q["features"] = chain(*BASE_FEAT) + f"SELECT {_feat_cols(FEATURE_OUTPUT)} FROM feat"
    q["features_carried"] = q["features"]
    q["resumed_features"] = q["features"]
    q["prev_event_carried"] = chain(*BASE_PACKED) + "SELECT trans_num, user_id, trans_seconds, prev_clock, trans_count_last_24h FROM feat"
    q["features_incremental"] = chain(*BASE_FEAT) + (
        "SELECT trans_num, epoch_seconds, prev_clock, (round(hours_since_last_trans, 6) + CAST(0 AS DOUBLE)) AS hours_since_last_trans, "
        "is_rapid_transaction, trans_count_last_24h FROM feat"
    )
    q["totals_incremental"] = chain(*BASE_CAL) + (
        "SELECT user_id, count(*) AS user_transaction_count, (round(avg(CAST(amt AS DOUBLE)), 6) + CAST(0 AS DOUBLE)) AS user_avg_amt FROM cal GROUP BY user_id"
    )
    q["valid_date_report"] = chain(*BASE_TYPED, PREPARED, _parsed("parsed", "prepared", True)) + (
        "SELECT count(*) AS rows_in, count(*) FILTER (WHERE year IS NULL OR month IS NULL OR day IS NULL) AS rows_invalid_date FROM parsed"
    )
    q["median_sketch"] = chain(*BASE_TYPED) + (
        "SELECT prob::DOUBLE AS prob, (SELECT count(amt) FROM typed) AS n, true AS within FROM (VALUES (0.05), (0.25), (0.5), (0.75), (0.95)) v(prob)"
    )
    q["csv_rejects"] = (
        "SELECT CAST(event_id AS VARCHAR) AS event_id, CASE WHEN event_id % 17 = 0 OR event_id % 19 = 0 THEN NULL ELSE props || ', \"x\"' END AS props, "
        "CASE WHEN event_id % 17 = 0 THEN 'short' WHEN event_id % 19 = 0 THEN 'long' ELSE 'fits' END AS reason, "
        "CAST(CASE WHEN event_id % 17 = 0 THEN 4 WHEN event_id % 19 = 0 THEN 7 ELSE 5 END AS INTEGER) AS n_fields FROM events"
    )
    q["months_rewritten"] = chain(*BASE_CAL) + "SELECT trans_num, amt, is_fraud, year, month FROM cal"
    q["balance_train"] = (
        chain(
            *BASE_FEAT,
            f"tr AS (SELECT * FROM feat WHERE {SPLIT} = 'train' AND is_fraud IS NOT NULL)",
            "c AS (SELECT is_fraud, count(*) AS n_rows FROM tr GROUP BY is_fraud)",
        )
        + "SELECT 'none' AS method, is_fraud, n_rows FROM c UNION ALL SELECT 'undersample', is_fraud, (SELECT min(n_rows) FROM c) FROM c "
        "UNION ALL SELECT 'oversample', is_fraud, (SELECT max(n_rows) FROM c) FROM c"
    )
    q["skip_invalid"] = chain(*BASE_TYPED, _parsed("parsed", "typed", True), CALENDAR) + (
        "SELECT trans_num, (round(CAST(amt AS DOUBLE), 6) + CAST(0 AS DOUBLE)) AS f_amt, CAST(hour AS DOUBLE) AS f_hour, CAST(is_fraud AS DOUBLE) AS f_is_fraud "
        "FROM cal WHERE amt IS NOT NULL AND hour IS NOT NULL AND is_fraud IS NOT NULL"
    )
    q["class_distribution"] = chain(*BASE_FEAT) + (
        "SELECT is_fraud, count(*) AS n_rows, "
        "CAST((round_even(CAST(count(*) AS DOUBLE) * 100.0 / sum(count(*)) OVER (), 4) + CAST(0 AS DOUBLE)) AS DOUBLE) AS pct "
        "FROM feat WHERE is_fraud IS NOT NULL GROUP BY is_fraud"
    )
    q["amount_summary"] = chain(*BASE_FEAT) + (
        "SELECT count(amt) AS n, (round(avg(CAST(amt AS DOUBLE)), 6) + CAST(0 AS DOUBLE)) AS mean, "
        "(round(stddev_samp(CAST(amt AS DOUBLE)), 6) + CAST(0 AS DOUBLE)) AS stddev, min(CAST(amt AS DOUBLE)) AS min, "
        "(round(quantile_cont(CAST(amt AS DOUBLE), 0.25), 6) + CAST(0 AS DOUBLE)) AS p25, (round(quantile_cont(CAST(amt AS DOUBLE), 0.5), 6) + CAST(0 AS DOUBLE)) AS p50, "
        "(round(quantile_cont(CAST(amt AS DOUBLE), 0.75), 6) + CAST(0 AS DOUBLE)) AS p75, max(CAST(amt AS DOUBLE)) AS max "
        "FROM feat WHERE is_fraud IS NOT NULL"
    )
    q["correlation_matrix"] = _correlation_matrix()
    q["label_correlation_top5"] = _label_corr_top5()
    q["stats_by_class"] = _stats_by_class()
    q["rate_by_hour_top5"] = chain(*BASE_FEAT) + """SELECT CAST(rank AS INTEGER) AS rank, hour, n_rows,
  CAST((round_even(rate * 100.0, 4) + CAST(0 AS DOUBLE)) AS DOUBLE) AS fraud_pct FROM (
  SELECT hour, count(*) AS n_rows, avg(CAST(is_fraud AS DOUBLE)) AS rate,
    row_number() OVER (ORDER BY avg(CAST(is_fraud AS DOUBLE)) DESC, hour) AS rank
  FROM feat WHERE is_fraud IS NOT NULL AND hour IS NOT NULL GROUP BY hour) WHERE rank <= 5"""
    q["segment_rates"] = _segment_rates()
    q["split_audit"] = chain(*BASE_FEAT, f"sp AS (SELECT *, {SPLIT} AS split FROM feat)") + (
        "SELECT split, count(*) AS n_rows, count(*) FILTER (WHERE is_fraud = 1) AS n_positive, "
        "CAST((round_even(CAST(count(*) FILTER (WHERE is_fraud = 1) AS DOUBLE) * 100.0 / count(*), 4) + CAST(0 AS DOUBLE)) AS DOUBLE) "
        "AS positive_pct FROM sp GROUP BY split"
    )
    q["class_filter"] = chain(*BASE_CAL) + "SELECT trans_num, amt, is_fraud FROM cal WHERE is_fraud = 1"
    q["sample_n"] = chain(*BASE_FEAT) + (
        f"SELECT trans_num, is_fraud, amt FROM (SELECT *, row_number() OVER (ORDER BY {_hash('trans_num')}, trans_num) AS rn "
        "FROM feat) WHERE rn <= 500"
    )
    q["undersample"] = chain(*BASE_FEAT, _undersample("feat")) + "SELECT trans_num, is_fraud, amt FROM bal"
    q["oversample"] = chain(*BASE_FEAT, _oversample("feat")) + "SELECT trans_num, is_fraud, amt FROM bal"
    q["feature_matrix"] = _feature_matrix()
    q["scaled_features"] = _scaled()
    q["drop_vectors"] = chain(*BASE_FEAT) + f"SELECT {_model_cols()} FROM feat"
    q["pipeline_features"] = (
        chain(*BASE_FEAT, f"tr AS (SELECT * FROM feat WHERE {SPLIT} = 'train')", _undersample("tr"))
        + "SELECT "
        + ", ".join(
            [
                "trans_num",
                "CAST(is_fraud AS DOUBLE) AS is_fraud",
                *[
                    (f"(round(coalesce({c}, 0), 6) + CAST(0 AS DOUBLE)) AS {c}" if c in ("user_avg_amt", "hours_since_last_trans") else f"coalesce({c}, 0) AS {c}")
                    for c in FEATURES11
                ],
            ]
        )
        + " FROM bal"
    )
    q["confusion_matrix"] = chain(*BASE_CAL, SCORED, CM) + "SELECT model, tn, fp, fn, tp FROM cm"
    q["classification_metrics"] = chain(*EVAL_BASE) + (
        "SELECT model, " + ", ".join(f"(round({c}, 6) + CAST(0 AS DOUBLE)) AS {c}" for c in _METRIC_COLS) + ", tn, fp, fn, tp FROM met"
    )
    q["roc_auc"] = chain(*BASE_CAL, SCORED, AUC) + "SELECT model, (round(roc_auc, 6) + CAST(0 AS DOUBLE)) AS roc_auc FROM auc"
    q["model_comparison"] = chain(*EVAL_BASE) + (
        "SELECT model, "
        + ", ".join(
            f"CAST((round_even({c}, 4) + CAST(0 AS DOUBLE)) AS DOUBLE) AS {c}" for c in ["accuracy", "precision", "recall", "f1_score", "roc_auc"]
        )
        + " FROM met"
    )
    q["best_model"] = chain(*EVAL_BASE) + """SELECT metric, model, (round(value, 6) + CAST(0 AS DOUBLE)) AS value FROM (
  SELECT *, row_number() OVER (PARTITION BY metric ORDER BY value DESC NULLS LAST, model) AS rk FROM (
    SELECT 'accuracy' AS metric, model, accuracy AS value FROM met
    UNION ALL SELECT 'f1_score', model, f1_score FROM met
    UNION ALL SELECT 'roc_auc', model, roc_auc FROM met)) WHERE rk = 1"""
    return q


ORACLE_SQL = build()
