"""Run query keys in Spark and their oracle SQL in DuckDB and compare
row count, column names and order-insensitive values.

Usage: python -m tests.oracle_compare [sf_dir] [key ...]
"""

from __future__ import annotations

import datetime as dt
import decimal
import sys
import time

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        return repr(round(v, 9))
    if isinstance(v, decimal.Decimal):
        return format(v.normalize(), "f")
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat(sep=" ")
    if isinstance(v, dt.date):
        return v.isoformat()
    return str(v)


def _canon(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    names = [cols[i] for i in order]
    data = sorted((tuple(_norm(r[i]) for i in order) for r in rows),
                  key=lambda t: tuple((x is None, x or "") for x in t))
    return names, data


def duck(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def compare(spark, sf_dir: str, keys=None, verbose=True):
    import __spark_entry__ as entry

    qs, sqls = entry.queries(), entry.oracle_sql()
    con = duck(sf_dir)
    report = {}
    for key in keys or list(qs):
        t0 = time.time()
        df = qs[key](spark, sf_dir)
        s_cols, s_rows = df.columns, [tuple(r) for r in df.collect()]
        t1 = time.time()
        if key not in sqls:
            report[key] = {"rows": len(s_rows), "oracle": None}
            continue
        rel = con.sql(sqls[key])
        d_cols, d_rows = rel.columns, rel.fetchall()
        sc, sd = _canon(s_cols, s_rows)
        dc, dd = _canon(d_cols, d_rows)
        ok = sc == dc and sd == dd
        report[key] = {"ok": ok, "spark_rows": len(s_rows), "oracle_rows": len(d_rows),
                       "sec": round(t1 - t0, 2)}
        if verbose:
            print(f"{'OK ' if ok else 'BAD'} {key}: spark={len(s_rows)} oracle={len(d_rows)} "
                  f"({t1 - t0:.2f}s) {sd[:2] if len(sd) <= 3 else ''}", flush=True)
            if not ok:
                print("   spark cols", sc, "oracle cols", dc)
                print("   spark-only", [r for r in sd if r not in dd][:5])
                print("   oracle-only", [r for r in dd if r not in sd][:5])
    return report


if __name__ == "__main__":
    from tarmac.session import local_session

    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    rep = compare(local_session(8), sf, sys.argv[2:] or None)
    bad = [k for k, v in rep.items() if v.get("ok") is False]
    print("BAD:", bad)
    sys.exit(1 if bad else 0)
