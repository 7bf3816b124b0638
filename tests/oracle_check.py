"""Run registered queries against their DuckDB oracle (same check as the driver's gate).

    python tests/oracle_check.py [sf_dir] [name ...]

Columns are compared by name, rows as an unordered multiset.  Doubles are compared rounded
to 9 digits, or to the bit with ``ORACLE_EXACT=1``.
"""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


EXACT = os.environ.get("ORACLE_EXACT") == "1"


def norm(v):
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return v.hex() if EXACT else round(v, 9)
    if hasattr(v, "isoformat"):
        return v.isoformat()
    return v


def rows_of(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted((tuple(norm(r[i]) for i in order) for r in rows), key=repr)


def duck(sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        if os.path.exists(p):
            con.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def check(spark, sf_dir, names=None, verbose=True):
    import __spark_entry__ as se
    qs, sqls = se.queries(), se.oracle_sql()
    con = duck(sf_dir)
    results = {}
    for name in names or sorted(qs):
        t0 = time.time()
        df = qs[name](spark, sf_dir)
        cols = df.columns
        srows = [tuple(r) for r in df.collect()]
        t1 = time.time()
        if name not in sqls:
            results[name] = ("rows-only", len(srows))
            if verbose:
                print(f"{name:40s} rows-only {len(srows)} rows  spark {t1-t0:.1f}s", flush=True)
            continue
        rel = con.sql(sqls[name])
        ocols = rel.columns
        orows = rel.fetchall()
        ok_cols = sorted(cols) == sorted(ocols)
        ok_n = len(srows) == len(orows)
        ok_v = ok_cols and rows_of(cols, srows) == rows_of(ocols, orows)
        results[name] = (ok_cols and ok_n and ok_v, len(srows), len(orows))
        if verbose:
            print(f"{name:40s} cols={ok_cols} n={len(srows)}/{len(orows)} values={ok_v}  spark {t1-t0:.1f}s",
                  flush=True)
            if ok_cols and not ok_v:
                a, b = rows_of(cols, srows), rows_of(ocols, orows)
                sa, sb = set(a), set(b)
                print("   spark-only:", sorted(sa - sb, key=repr)[:3])
                print("   oracle-only:", sorted(sb - sa, key=repr)[:3])
            if not ok_cols:
                print("   spark cols:", cols, "\n   oracle cols:", ocols)
    return results


if __name__ == "__main__":
    from pyspark.sql import SparkSession
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = (SparkSession.builder.master("local[8]").config("spark.sql.shuffle.partitions", "8")
             .config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false").config("spark.sql.session.timeZone", "UTC")
             .config("spark.driver.memory", "8g").getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    res = check(spark, sf, sys.argv[2:] or None)
    bad = [k for k, v in res.items() if v[0] is False]
    print("FAILED:", bad if bad else "none")
