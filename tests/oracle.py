"""Side-by-side check of every registered query against its DuckDB SQL.

    python tests/oracle.py [sf_dir] [name ...]

Compares row count, column names and an order-insensitive hash of the
values (doubles rounded to 9 significant digits, timestamps as naive UTC).
"""

from __future__ import annotations

import datetime as dt
import hashlib
import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402

from moodstream.sources.tables import TABLES  # noqa: E402


def _norm(v):
    if v is None:
        return "∅"
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return f"{v:.9g}"
    if isinstance(v, dt.datetime):
        if v.tzinfo is not None:
            v = v.astimezone(dt.timezone.utc).replace(tzinfo=None)
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return "[" + ",".join(_norm(x) for x in v) + "]"
    if isinstance(v, dict):
        return "{" + ",".join(f"{k}:{_norm(x)}" for k, x in sorted(v.items())) + "}"
    return str(v)


def digest(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    lines = sorted("|".join(_norm(r[i]) for i in order) for r in rows)
    return hashlib.sha256("\n".join(lines).encode()).hexdigest(), lines


def duck(sf_dir: str):
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def compare(spark, sf_dir: str, names=None, verbose=True):
    import __spark_entry__ as E

    qs, sqls = E.queries(), E.oracle_sql()
    con = duck(sf_dir)
    results = {}
    for name in names or sorted(qs):
        t0 = time.time()
        df = qs[name](spark, sf_dir)
        cols = df.columns
        rows = [tuple(r) for r in df.collect()]
        t1 = time.time()
        if name not in sqls:
            results[name] = ("rows-only", len(rows))
            if verbose:
                print(f"{name:28s} rows-only  n={len(rows)}  {t1 - t0:.1f}s", flush=True)
            continue
        cur = con.execute(sqls[name])
        dcols = [d[0] for d in cur.description]
        drows = cur.fetchall()
        h1, l1 = digest(cols, rows)
        h2, l2 = digest(dcols, drows)
        ok = sorted(cols) == sorted(dcols) and len(rows) == len(drows) and h1 == h2
        results[name] = ("ok" if ok else "MISMATCH", len(rows), len(drows))
        if verbose:
            print(f"{name:28s} {'ok' if ok else 'MISMATCH'}  spark={len(rows)} duck={len(drows)} "
                  f"{t1 - t0:.1f}s", flush=True)
            if not ok:
                if sorted(cols) != sorted(dcols):
                    print("   cols spark", sorted(cols), "\n   cols duck ", sorted(dcols))
                s1, s2 = set(l1), set(l2)
                for x in sorted(s1 - s2)[:3]:
                    print("   spark only:", x[:300])
                for x in sorted(s2 - s1)[:3]:
                    print("   duck only: ", x[:300])
    return results


if __name__ == "__main__":
    from moodstream.session import get_spark

    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or None
    spark = get_spark("local[8]", conf={"spark.sql.shuffle.partitions": "8"})
    spark.sparkContext.setLogLevel("ERROR")
    res = compare(spark, sf, names)
    bad = [k for k, v in res.items() if v[0] == "MISMATCH"]
    print("mismatches:", bad)
