"""Compare every registered query with its DuckDB oracle (like the driver's gate).

usage: python tests/oracle_check.py [sf_dir] [name ...]
"""

from __future__ import annotations

import hashlib
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import __spark_entry__ as E  # noqa: E402
from daycast.session import local_session  # noqa: E402

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def norm(v):
    if v is None:
        return "∅"
    if isinstance(v, float):
        return repr(round(v, 6) + 0.0)
    if hasattr(v, "isoformat"):
        return v.isoformat()
    if isinstance(v, bool):
        return str(int(v))
    return str(v)


def digest(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    lines = sorted("|".join(norm(r[i]) for i in order) for r in rows)
    return hashlib.sha1("\n".join(lines).encode()).hexdigest(), lines


def main():
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:]
    spark = local_session(8)
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    qs, sqls = E.queries(), E.oracle_sql()
    bad = 0
    for name, fn in qs.items():
        if names and name not in names:
            continue
        t0 = time.time()
        df = fn(spark, sf_dir)
        rows = [tuple(r) for r in df.collect()]
        ts = time.time() - t0
        if name not in sqls:
            print(f"{name:32s} rows-only  rows={len(rows)} {ts:.1f}s")
            continue
        res = con.execute(sqls[name])
        ocols = [d[0] for d in res.description]
        orows = res.fetchall()
        h1, l1 = digest(df.columns, rows)
        h2, l2 = digest(ocols, orows)
        ok = h1 == h2 and sorted(df.columns) == sorted(ocols)
        bad += not ok
        print(f"{name:32s} {'OK ' if ok else 'BAD'} rows={len(rows)}/{len(orows)} {ts:.1f}s")
        if not ok:
            if sorted(df.columns) != sorted(ocols):
                print("   cols spark:", sorted(df.columns))
                print("   cols duck :", sorted(ocols))
            else:
                s1, s2 = set(l1), set(l2)
                for x in list(s1 - s2)[:3]:
                    print("   spark:", x)
                for x in list(s2 - s1)[:3]:
                    print("   duck :", x)
    print("mismatches:", bad)


if __name__ == "__main__":
    main()
