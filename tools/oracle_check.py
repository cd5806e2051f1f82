"""Run registered queries on Spark and their oracle SQL on DuckDB; compare.

Usage: python tools/oracle_check.py [sf_dir] [key ...]

Comparison: row count, column names (sorted), and the multiset of rows with
columns in name order (floats compared after rounding to 9 significant digits).
"""

from __future__ import annotations

import json
import math
import sys
import time
from collections import Counter
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

import duckdb  # noqa: E402

from riskloom.session import local_session  # noqa: E402
from riskloom.sources.fixtures import TABLES  # noqa: E402


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        if v == 0.0 and math.copysign(1.0, v) < 0:
            return "-0.0"  # a hash of the printed value would tell -0.0 from 0.0
        return float(f"{v:.9g}")
    if hasattr(v, "item"):
        return _norm(v.item())
    return v


def _rows(cols, records):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return Counter(tuple(_norm(r[i]) for i in order) for r in records)


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def main() -> int:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    keys = sys.argv[2:]
    import importlib

    entry = importlib.import_module("__spark_entry__")
    spark = local_session(8)
    qs, sqls = entry.queries(), entry.oracle_sql()
    con = duck(sf_dir)
    report = {}
    for k in keys or list(qs):
        t0 = time.time()
        try:
            sdf = qs[k](spark, sf_dir)
            s_cols = sdf.columns
            s_rows = [tuple(r) for r in sdf.collect()]
        except Exception as e:  # noqa: BLE001
            report[k] = {"status": "spark_error", "error": str(e)[:400]}
            print(k, "SPARK ERROR", str(e)[:400], flush=True)
            continue
        ts = time.time() - t0
        if k not in sqls:
            report[k] = {"status": "rows_only", "rows": len(s_rows), "sec": round(ts, 2)}
            print(k, "rows-only", len(s_rows), f"{ts:.1f}s", flush=True)
            continue
        try:
            res = con.execute(sqls[k])
            d_cols = [d[0] for d in res.description]
            d_rows = res.fetchall()
        except Exception as e:  # noqa: BLE001
            report[k] = {"status": "sql_error", "error": str(e)[:400]}
            print(k, "SQL ERROR", str(e)[:400], flush=True)
            continue
        ok_cols = sorted(s_cols) == sorted(d_cols)
        ok_n = len(s_rows) == len(d_rows)
        a, b = _rows(s_cols, s_rows), _rows(d_cols, d_rows)
        ok_v = ok_cols and a == b
        status = "match" if (ok_cols and ok_n and ok_v) else "MISMATCH"
        report[k] = {"status": status, "rows": [len(s_rows), len(d_rows)], "sec": round(ts, 2)}
        print(k, status, len(s_rows), len(d_rows), f"{ts:.1f}s", flush=True)
        if status != "match":
            if not ok_cols:
                print("   cols spark", sorted(s_cols), "\n   cols duck ", sorted(d_cols))
            else:
                print("   spark-only", list((a - b).items())[:3])
                print("   duck-only ", list((b - a).items())[:3])
    print(json.dumps({k: v["status"] for k, v in report.items()}))
    spark.stop()
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
