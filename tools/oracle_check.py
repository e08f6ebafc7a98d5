"""Run catalogue queries in Spark and their SQL oracle in DuckDB; compare results.

usage: python tools/oracle_check.py [sf_dir] [name ...]
"""

from __future__ import annotations

import datetime as dt
import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402

from inboxlens.plans.catalog import queries  # noqa: E402
from inboxlens.plans.oracle import oracle_sql  # noqa: E402
from inboxlens.session import build_session  # noqa: E402

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def norm(v):
    if isinstance(v, float):
        return None if math.isnan(v) else (v if os.environ.get("EXACT_FLOATS") else round(v, 9))
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None)
    if isinstance(v, (list, tuple)):
        return tuple(norm(x) for x in v)
    return v


def canon(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = [tuple(norm(r[i]) for i in order) for r in rows]
    return [cols[i] for i in order], sorted(out, key=repr)


def main():
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or list(queries())
    if os.environ.get("PLAIN_SESSION"):
        from pyspark.sql import SparkSession
        spark = SparkSession.builder.master("local[8]").getOrCreate()
    else:
        spark = build_session("local[8]")
    con = duckdb.connect()
    for t in TABLES:
        p = os.path.join(sf, f"{t}.parquet")
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    sqls = oracle_sql()
    bad = 0
    for name in names:
        t0 = time.time()
        df = queries()[name](spark, sf)
        rows = [tuple(r) for r in df.collect()]
        el = time.time() - t0
        scols, srows = canon(df.columns, rows)
        if name not in sqls:
            print(f"{name:28s} rows={len(rows):7d} (no oracle) {el:.2f}s")
            continue
        res = con.execute(sqls[name])
        ocols = [d[0] for d in res.description]
        ocols, orows = canon(ocols, res.fetchall())
        ok = scols == ocols and srows == orows
        bad += not ok
        print(f"{name:28s} rows={len(rows):7d}/{len(orows):7d} {'OK ' if ok else 'BAD'} {el:.2f}s")
        if not ok:
            print("   spark cols", scols, "\n   duck  cols", ocols)
            diff_s = [r for r in srows if r not in set(orows)][:3]
            diff_o = [r for r in orows if r not in set(srows)][:3]
            print("   only spark", diff_s, "\n   only duck ", diff_o)
    print("mismatches:", bad)


if __name__ == "__main__":
    main()
