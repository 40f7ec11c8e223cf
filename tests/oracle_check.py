"""Compare every registered Spark query with its DuckDB oracle.

Usage: python tests/oracle_check.py [sf_dir] [query ...]

Row count, column names and order-insensitive values must all agree.
Also imported by the test-suite (at sf0.001).
"""

from __future__ import annotations

import datetime as dt
import decimal
import math
import os
import sys
import time

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        return None if math.isnan(v) else repr(float(v))
    if isinstance(v, decimal.Decimal):
        return repr(float(v))
    if isinstance(v, bool):
        return str(v)
    if isinstance(v, int):
        return str(v)
    if isinstance(v, dt.datetime):
        return v.isoformat(sep=" ")
    if isinstance(v, dt.date):
        return v.isoformat()
    return str(v)


def canon(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    out = [tuple(_norm(r[i]) for i in order) for r in rows]
    return sorted(out, key=lambda t: tuple("" if x is None else x for x in t))


def duck(sf_dir: str):
    import duckdb
    con = duckdb.connect()
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def compare(spark, sf_dir: str, names=None, verbose=True) -> dict[str, str]:
    from __spark_entry__ import oracle_sql, queries
    qs, sqls = queries(), oracle_sql()
    con = duck(sf_dir)
    results = {}
    for name, q in qs.items():
        if names and name not in names:
            continue
        if name not in sqls:
            results[name] = "no-oracle"
            continue
        t0 = time.time()
        df = q(spark, sf_dir)
        s_cols = df.columns
        s_rows = [tuple(r) for r in df.collect()]
        t1 = time.time()
        rel = con.sql(sqls[name])
        d_cols = rel.columns
        d_rows = rel.fetchall()
        t2 = time.time()
        status = "ok"
        if sorted(s_cols) != sorted(d_cols):
            status = f"columns differ: spark-only {sorted(set(s_cols) - set(d_cols))} " \
                     f"duck-only {sorted(set(d_cols) - set(s_cols))}"
        elif len(s_rows) != len(d_rows):
            status = f"rows differ: spark {len(s_rows)} duck {len(d_rows)}"
        else:
            a, b = canon(s_cols, s_rows), canon(d_cols, d_rows)
            if a != b:
                diff = [(x, y) for x, y in zip(a, b) if x != y]
                status = f"values differ in {len(diff)} rows; first: spark {diff[0][0]} duck {diff[0][1]}"
        results[name] = status
        if verbose:
            print(f"{name:28s} rows={len(s_rows):7d} spark={t1 - t0:5.1f}s duck={t2 - t1:5.1f}s {status}",
                  flush=True)
    return results


if __name__ == "__main__":
    from stratum.session import local_session
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = local_session(8)
    res = compare(spark, sf, sys.argv[2:] or None)
    bad = {k: v for k, v in res.items() if v not in ("ok", "no-oracle")}
    print(f"{len(res) - len(bad)}/{len(res)} ok")
    sys.exit(1 if bad else 0)
