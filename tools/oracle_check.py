"""Run each registered query on Spark and its oracle SQL on DuckDB; compare.

Usage: python tools/oracle_check.py [--sf-dir DIR] [names...]

Prints one line per query: rows on both sides, column match, exact value
match (columns sorted by name, rows order-insensitive) and a float-tolerant
match. Exit code 1 if any exact match fails.
"""

from __future__ import annotations

import argparse
import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402

from tidemark.plans import registry  # noqa: E402
from tidemark.session import build_session  # noqa: E402
from tidemark.sources.tables import TABLES  # noqa: E402


def _norm(v, tol: bool):
    if v is None:
        return (0, "")
    if isinstance(v, float):
        if math.isnan(v):
            return (1, "nan")
        return (1, f"{v:.9g}" if tol else repr(v))
    if hasattr(v, "item"):
        return _norm(v.item(), tol)
    if isinstance(v, (list, tuple)):
        return (2, tuple(_norm(x, tol) for x in v))
    return (3, str(v))


def _rows(cols, rows, tol):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted(tuple(_norm(r[i], tol) for i in order) for r in rows)


def main() -> int:
    ap = argparse.ArgumentParser()
    ap.add_argument("--sf-dir", default="/root/testdata/sf0.01")
    ap.add_argument("--json", help="also write a per-query report to this file")
    ap.add_argument("names", nargs="*")
    a = ap.parse_args()
    spark = build_session("local[8]", shuffle_partitions=8)
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{a.sf_dir}/{t}.parquet')")
    qs, ors = registry.queries(), registry.oracles()
    names = a.names or list(qs)
    bad = 0
    report = {}
    for n in names:
        t0 = time.time()
        df = qs[n](spark, a.sf_dir)
        s_cols = df.columns
        s_rows = [tuple(r) for r in df.collect()]
        ts = time.time() - t0
        if n not in ors:
            print(f"{n:24s} spark_rows={len(s_rows):7d} (no oracle) {ts:.1f}s", flush=True)
            report[n] = {"spark_rows": len(s_rows), "oracle": False, "spark_sec": round(ts, 2)}
            continue
        t0 = time.time()
        res = con.execute(ors[n])
        d_cols = [d[0] for d in res.description]
        d_rows = res.fetchall()
        td = time.time() - t0
        cols_ok = sorted(s_cols) == sorted(d_cols)
        exact = cols_ok and _rows(s_cols, s_rows, False) == _rows(d_cols, d_rows, False)
        approx = cols_ok and _rows(s_cols, s_rows, True) == _rows(d_cols, d_rows, True)
        bad += not exact
        report[n] = {"spark_rows": len(s_rows), "oracle_rows": len(d_rows), "columns": cols_ok,
                     "exact": exact, "approx": approx, "spark_sec": round(ts, 2)}
        print(f"{n:24s} spark_rows={len(s_rows):7d} duck_rows={len(d_rows):7d} cols={cols_ok} "
              f"exact={exact} approx={approx} spark={ts:.1f}s duck={td:.1f}s", flush=True)
        if not cols_ok:
            print("   spark cols", s_cols, "\n   duck cols ", d_cols)
        elif not exact:
            sr, dr = _rows(s_cols, s_rows, False), _rows(d_cols, d_rows, False)
            diff_s = [r for r in sr if r not in set(dr)][:3]
            diff_d = [r for r in dr if r not in set(sr)][:3]
            print("   only spark:", diff_s, "\n   only duck: ", diff_d)
    spark.stop()
    if a.json:
        import json
        with open(a.json, "w") as f:
            json.dump(report, f, indent=1, sort_keys=True)
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main())
