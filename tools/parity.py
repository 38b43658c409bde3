"""Run registered queries in Spark and their oracle SQL in DuckDB; compare results.

    python tools/parity.py [sf_dir] [name ...]

Comparison mirrors the driver's gate: same column names, same row count, same
multiset of rows (columns sorted by name, floats compared after rounding to 9
significant digits, which only absorbs last-bit noise).
"""

from __future__ import annotations

import datetime as dt
import decimal
import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def duck(sf_dir):
    import duckdb
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return repr(float(f"{v:.9g}"))
    if isinstance(v, decimal.Decimal):
        return repr(float(f"{float(v):.9g}"))
    if isinstance(v, bool):
        return int(v)
    if isinstance(v, (dt.datetime, dt.date)):
        return v.isoformat()
    if hasattr(v, "tolist"):
        return tuple(_norm(x) for x in v.tolist())
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    if isinstance(v, dict):
        return tuple(sorted((k, _norm(x)) for k, x in v.items()))
    return v


def rows_of(columns, records):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    out = [tuple(_norm(r[i]) for i in order) for r in records]
    return sorted(out, key=lambda r: tuple((x is None, str(x)) for x in r))


def compare(name, spark, con, sf_dir, fn, oracle):
    t0 = time.time()
    sdf = fn(spark, sf_dir)
    s_cols = sdf.columns
    s_rows = [tuple(r) for r in sdf.collect()]
    ts = time.time() - t0
    res = {"name": name, "spark_rows": len(s_rows), "spark_sec": round(ts, 2)}
    if oracle is None:
        res["status"] = "rows-only"
        return res
    t0 = time.time()
    cur = con.execute(oracle)
    d_cols = [c[0] for c in cur.description]
    d_rows = cur.fetchall()
    res["duck_sec"] = round(time.time() - t0, 2)
    res["duck_rows"] = len(d_rows)
    if sorted(s_cols) != sorted(d_cols):
        res["status"] = f"COLUMNS spark={sorted(s_cols)} duck={sorted(d_cols)}"
        return res
    a, b = rows_of(s_cols, s_rows), rows_of(d_cols, d_rows)
    if len(a) != len(b):
        res["status"] = "ROWCOUNT"
        return res
    bad = [(x, y) for x, y in zip(a, b) if x != y]
    res["status"] = "OK" if not bad else f"VALUES {len(bad)} differ"
    if bad:
        res["example"] = bad[:2]
        res["columns"] = sorted(s_cols)
    return res


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 and os.path.isdir(argv[1]) else "/root/testdata/sf0.01"
    names = [a for a in argv[1:] if not os.path.isdir(a)]
    from aerolith.session import build_session
    from aerolith.plans.registry import load_all
    tz = os.environ.get("PARITY_TZ")  # e.g. America/Los_Angeles: results must not depend on it
    spark = build_session(extra={"spark.sql.session.timeZone": tz} if tz else None)
    con = duck(sf_dir)
    reg = load_all()
    bad = 0
    for name, (fn, oracle) in reg.items():
        if names and name not in names:
            continue
        try:
            r = compare(name, spark, con, sf_dir, fn, oracle)
        except Exception as e:  # report and continue
            r = {"name": name, "status": f"ERROR {type(e).__name__}: {str(e)[:400]}"}
        if r["status"] not in ("OK", "rows-only"):
            bad += 1
        print(r, flush=True)
    print(f"FAILED {bad}" if bad else "ALL OK")
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv) else 0)
